"""URL filter: host and path rules, and a tree of path templates for what no rule fits.

Every host has a tree whose levels are the segments of its paths. Segments
that vary become wildcards: by their form (runs of digits, hexadecimal names)
before the tree is grown, and by their numbers while it grows, level by level.
A segment stays literal in its parent if it has ``MIN_URLS`` urls and the share
``MIN_SHARE`` of them at least, so a parent has no more than 1 / ``MIN_SHARE``
literal branches; all other segments are its wildcard branch, however many
they are. Literal branches of a parent that are statistically alike (what
follows, and how many urls are labelled good, bad and not at all, differ by
less than Hoeffding's bound) are merged and go on as one, with their evidence
together. A branch's urls end in templates; a template is rejected if its
labelled purity, (bad + strength x prior) / (labelled + strength), reaches the
threshold. A template without labels has the purity of the prior and is kept.

The labels are the urls that a rule fits: blocked ones are bad, allowed ones
good. A url that repeats counts once. The tree has ``LEVELS`` levels; the last
one takes all that is left of a path as one segment, so whole paths count.

Defined results: a null url, or one without ``://``, has an empty host and an
empty path and no rule, and all of them share one template; a null page_id is a row like any other; repeated rows
are judged alike; of rules of equal length the one with the longer host wins;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from pricerisk.llm.common import pick, written

ALLOW, BLOCK = "allow", "block"
MIN_URLS, MIN_SHARE = 5, 0.05
#: Confidence of the test whether two branches differ.
ALPHA = 0.05
PRIOR, STRENGTH, THRESHOLD = 0.5, 4.0, 0.9
LEVELS = 16

#: Forms of what follows a segment: nothing, an empty segment, a number, a hexadecimal name, digits and others, no digit.
FORMS = ("end", "empty", "number", "hex", "mixed", "word")
_A_TO_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

CHILDREN = T.StructType(
    [
        T.StructField("node", T.StringType(), False),
        T.StructField("token", T.StringType(), False),
        T.StructField("child", T.StringType(), False),
    ]
)


def with_host_and_path(pages: DataFrame) -> DataFrame:
    """Adds host (A to Z lower-cased) and path of ``url``."""
    at = F.instr("url", "://")
    rest = F.coalesce(F.when(at > 0, F.col("url").substr(at + 3, F.length("url"))), F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest.substr(F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return pages.withColumn("path", path).withColumn("host", F.translate(host, _A_TO_Z, _A_TO_Z.lower()))


def rule_columns(rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule (verdict, host, path) that fits ``host`` and ``path``, as text, and its verdict; else null."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, host, path in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), len(r[1]))):
        if says not in (ALLOW, BLOCK):
            raise ValueError(f"a rule says {ALLOW} or {BLOCK}, not {says!r}")
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule = F.when(fits, F.lit(host + path)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def shape_of(path: Column) -> Column:
    """``path`` with what varies by its form written alike: ``#`` for digits, ``#x`` for a hexadecimal name.

    A segment that has one of the signs of templates (``* # { | }``) keeps it as a percent code.
    """
    for sign in "*#{|}":
        path = F.regexp_replace(path, "\\" + sign, f"%{ord(sign):02X}")
    # 8 hexadecimal digits or more, with dashes, at least one of them a digit and one a letter or dash
    path = F.regexp_replace(path, r"(?<=/)(?=[^/]*[0-9])(?=[^/]*[a-fA-F-])[0-9a-fA-F-]{8,}(?=/|$)", "#x")
    return F.regexp_replace(path, r"[0-9]+", "#")


def _segments(shape: Column) -> Column:
    """Segments of a shape, ``LEVELS`` at most: the last one takes the rest."""
    return F.when(shape == "", F.array().cast("array<string>")).otherwise(F.slice(F.split(shape, "/", LEVELS + 1), 2, LEVELS + 1))


def _form(token: Column) -> Column:
    """Number in ``FORMS`` of the form of the segment that follows."""
    return (
        F.when(token.isNull(), 0)
        .when(token == "", 1)
        .when(token == "#", 2)
        .when(token == "#x", 3)
        .when(token.contains("#"), 4)
        .otherwise(5)
    )


def alike(a: Sequence[int], b: Sequence[int], alpha: float = ALPHA) -> bool:
    """Whether two branches, each (urls, counts of its features), may be of one kind: Hoeffding's bound on every share."""
    bound = math.sqrt(math.log(2 / alpha) / 2) * (1 / math.sqrt(a[0]) + 1 / math.sqrt(b[0]))
    return all(abs(x / a[0] - y / b[0]) < bound for x, y in zip(a[1:], b[1:]))


def merged(branches: list[tuple[str, list[int]]]) -> list[list[str]]:
    """Groups of alike branches (token, (urls, counts)): the largest branches lead, others join the first they are like."""
    groups: list[tuple[list[int], list[str]]] = []
    for token, counts in sorted(branches, key=lambda x: (-x[1][0], x[0])):
        for leader, tokens in groups:
            if alike(leader, counts):
                tokens.append(token)
                break
        else:
            groups.append((counts, [token]))
    return [tokens for _, tokens in groups]


def _children(nodes: DataFrame) -> DataFrame:
    """node, token, child template of every literal branch of ``nodes`` (node, branches: token and counts)."""

    def run(batches):
        for batch in batches:
            out: list[tuple[str, str, str]] = []
            for node, branches in zip(*(c.to_pylist() for c in batch.columns)):
                for tokens in merged([(b["token"], b["counts"]) for b in branches]):
                    name = tokens[0] if len(tokens) == 1 else "{" + "|".join(sorted(tokens)) + "}"
                    out.extend((node, t, f"{node}/{name}") for t in tokens)
            columns = [list(x) for x in zip(*out)] if out else [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=CHILDREN.fieldNames())

    return nodes.mapInArrow(run, CHILDREN)


def _grow(rows: DataFrame, level: int) -> DataFrame:
    """``rows`` one level further down: ``node`` becomes the branch of each row's segment at ``level``."""
    rows = rows.withColumn("token", F.get("segments", F.lit(level)))
    live = rows.where(F.col("token").isNotNull()).withColumn("form", _form(F.get("segments", F.lit(level + 1))))
    counts = [F.sum(F.when(F.col("form") == k, F.col("n")).otherwise(0)).alias(f) for k, f in enumerate(FORMS)]
    stats = live.groupBy("node", "token").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.sum("good").alias("good"), *counts)
    total = stats.groupBy(F.col("node").alias("_node")).agg(F.sum("n").alias("total"))
    # branches of enough urls, the largest of each node; no others can have the share
    largest = Window.partitionBy("node").orderBy(F.desc("n"), "token")
    top = stats.where(F.col("n") >= MIN_URLS).withColumn("_r", F.row_number().over(largest)).where(F.col("_r") <= int(1 / MIN_SHARE))
    top = top.join(total, F.col("node") == F.col("_node")).where(F.col("n") >= MIN_SHARE * F.col("total"))
    kinds = F.array("n", "bad", "good", (F.col("n") - F.col("bad") - F.col("good")), *FORMS)
    nodes = top.groupBy("node").agg(F.collect_list(F.struct("token", kinds.alias("counts"))).alias("branches"))
    children = _children(nodes).toDF("_n", "_t", "child")
    joined = rows.join(children, (F.col("node") == F.col("_n")) & (F.col("token") == F.col("_t")), "left")
    down = F.when(F.col("token").isNull(), F.col("node")).otherwise(F.coalesce("child", F.concat("node", F.lit("/*"))))
    return joined.select("host", "shape", "segments", "n", "bad", "good", down.alias("node"))


def path_templates(urls: DataFrame) -> DataFrame:
    """host, shape, template, purity: the template of every shape of ``urls`` (url, host, shape, label: 1 bad, 0 good or null)."""
    single = urls.groupBy("url").agg(F.first("host").alias("host"), F.first("shape").alias("shape"), F.first("label").alias("label"))
    bad, good = (F.count(F.when(F.col("label") == v, 1)).alias(k) for v, k in ((1, "bad"), (0, "good")))
    rows = single.groupBy("host", "shape").agg(F.count(F.lit(1)).alias("n"), bad, good)
    rows = written(rows.withColumn("segments", _segments(F.col("shape"))).withColumn("node", F.col("host")), "url-shapes")
    levels = rows.agg(F.max(F.size("segments")).alias("n")).first()["n"] or 0
    for level in range(levels):
        rows = written(_grow(rows, level), "url-tree")
    labelled = F.sum("bad") + F.sum("good")
    purity = rows.groupBy(F.col("node").alias("template")).agg(
        ((F.sum("bad") + STRENGTH * PRIOR) / (labelled + STRENGTH)).alias("purity")
    )
    return rows.join(purity, F.col("node") == F.col("template")).select("host", "shape", "template", "purity")


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """page_id, host, path, rule, verdict, template, purity of every row of ``pages`` (page_id, url).

    ``rules`` are (allow or block, host, path): a list of the caller's, which becomes part of the plan.
    """
    rule, says = rule_columns(rules)
    d = with_host_and_path(pick(pages, "page_id", "url"))
    d = d.withColumn("rule", rule).withColumn("says", says).withColumn("shape", shape_of(F.col("path")))
    label = F.when(F.col("says").isNotNull(), (F.col("says") == BLOCK).cast("int"))
    found = path_templates(d.select("url", "host", "shape", label.alias("label")))
    found = found.select(F.col("host").alias("_h"), F.col("shape").alias("_s"), "template", "purity")
    own = F.when(F.col("purity") >= THRESHOLD, F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    joined = d.join(found, (F.col("host") == F.col("_h")) & (F.col("shape") == F.col("_s")), "left")
    return joined.select("page_id", "host", "path", "rule", F.coalesce("says", own).alias("verdict"), "template", "purity")
