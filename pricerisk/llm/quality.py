"""Quality rules with risk-controlled thresholds. DataFrame functions only.

Base counts come from one pass over the whole texts. On top of a fixed base
rule, a few signals (shares of marks, capitals, repeated lines) each get a
cutoff per stratum, chosen on labelled documents:

* a cutoff is certified if the exact binomial (Clopper-Pearson) test rejects
  "more than ``alpha / rules`` of the good documents in this stratum exceed
  it" at level ``delta / (strata x rules)``. A rule's cutoffs are tested from
  the mildest on, and the first failure ends the sequence, so that the
  correction counts (stratum, rule) pairs only (fixed-sequence testing within,
  Bonferroni across);
* of the certified cutoffs the one that rejects most bad documents beyond the
  good ones counts; a rule that rejects no more bad than good stays off.

With probability ``1 - delta`` no stratum loses more than ``alpha`` of its
good documents to the rules. This certification, the one of op1's registered SQL,
needs hundreds of good labels in a stratum. The joint one (``joint``, used by the
pipeline) tests whole sets of cutoffs against ``alpha`` instead and keeps the
same promise with about a hundred; see ``select_joint_cutoffs``. The grid of cutoffs is fixed beforehand, so every
labelled document serves as holdout. All labelled documents that pass the base
rule count, at any size.

Defined results: null text has no words and fails the base rule; a null
stratum is the stratum ''; a stratum without enough good labels keeps
everything that passes the base rule; documents with several labels count as
bad if any label is; repeated rows are judged one by one and equally, and a
labelled doc_id counts once for the certificate however many rows it has (see
``labelled_once``); extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricerisk.llm.common import HAS_WORD, WHITE, WORD_BREAK, pick, written

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
ALPHA = 0.05
DELTA = 0.05
#: Rule -> cutoffs from the mildest to the strictest; a document exceeds a cutoff if its signal is larger.
GRID = {
    "symbol_share": (0.4, 0.3, 0.2, 0.15, 0.1, 0.07, 0.05, 0.03, 0.02),
    "capital_share": (0.9, 0.7, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1, 0.07),
    "dup_line_share": (0.9, 0.7, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1, 0.05),
    "shout_share": (0.5, 0.3, 0.2, 0.15, 0.1, 0.05, 0.03, 0.02, 0.01),
}


def _count_of(text: Column, marks: str) -> Column:
    return F.length(text) - F.length(F.translate(text, marks, ""))


def base_counts(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, ``more`` columns, base counts and signals of every row, row by row (no shuffle).

    Repeated windows: the hashes of a text's 3-word windows are compared as
    a set first; only texts with a repeat sort (hash, position) pairs, mark
    those with an equal neighbour, and add up the words that they cover.
    """
    d = pick(docs, "doc_id", "text", *more)
    text = F.coalesce(F.col("text"), F.lit(""))
    d = d.select("doc_id", *more, text.alias("_t"))
    d = d.select(
        "doc_id",
        *more,
        F.array_remove(F.split("_t", WORD_BREAK), "").alias("_w"),
        F.filter(F.split("_t", "\n"), lambda x: x.rlike(HAS_WORD)).alias("_lines"),
        F.length(F.translate("_t", WHITE, "")).cast("long").alias("word_chars"),
        _count_of(F.col("_t"), SYMBOLS).cast("long").alias("n_symbols"),
        F.regexp_count("_t", F.lit(r"\p{Lu}")).alias("_capitals"),
        _count_of(F.col("_t"), "!").alias("_shouts"),
    )
    n = F.size("_w")
    w = F.col("_w")
    d = d.withColumn(
        "_h",
        F.when(
            n >= 3,
            F.transform(F.slice(w, 1, F.greatest(n - 2, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))),
        ),
    )
    d = d.withColumn(
        "_sorted",
        F.when(
            F.size(F.array_distinct("_h")) < F.size("_h"),
            F.array_sort(F.transform("_h", lambda x, i: F.struct(x.alias("h"), i.alias("i")))),
        ),
    )
    s = F.col("_sorted")
    d = d.withColumn(
        "_at",
        F.array_sort(
            F.transform(
                F.filter(
                    s,
                    lambda x, i: F.coalesce(x["h"] == F.get(s, i - 1)["h"], F.lit(False))
                    | F.coalesce(x["h"] == F.get(s, i + 1)["h"], F.lit(False)),
                ),
                lambda x: x["i"],
            )
        ),
    )
    covered = F.aggregate(
        "_at",
        F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
        lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")),
        lambda a: a["n"],
    )
    n_lines = F.size("_lines")
    d = d.select(
        "doc_id",
        *more,
        n.cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        (n_lines - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        n_lines.alias("_n_lines"),
        "_capitals",
        "_shouts",
    )
    share = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    return d.select(
        "doc_id",
        *more,
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (
            (F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
        ).alias("base_failed"),
        share(F.col("n_symbols"), F.col("word_chars")).alias("symbol_share"),
        share(F.col("_capitals"), F.col("word_chars")).alias("capital_share"),
        share(F.col("n_dup_lines"), F.col("_n_lines")).alias("dup_line_share"),
        share(F.col("_shouts"), F.col("n_words")).alias("shout_share"),
    )


def _ln_factorial(x: Column) -> Column:
    """ln(x!) by Stirling's series from x + 10 on, then downwards; right to 1e-12 for x >= 0."""
    y = x + F.lit(10.0)
    series = (y + 0.5) * F.log(y) - y + F.lit(0.9189385332046727) + 1 / (12 * y) - 1 / (360 * F.pow(y, F.lit(3.0)))
    series = series + 1 / (1260 * F.pow(y, F.lit(5.0))) - 1 / (1680 * F.pow(y, F.lit(7.0)))
    steps = F.lit(0.0)
    for k in range(1, 11):
        steps = steps + F.log(x + F.lit(float(k)))
    return series - steps


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(Bin(n, p) <= k), for k below n * p (1 otherwise).

    The largest term comes from ``ln`` factorials, each smaller one from the
    one before. Terms more than 40 standard deviations away add nothing in
    double precision, so their number grows with the root of n only.
    """
    kd, nd = k.cast("double"), n.cast("double")
    top = _ln_factorial(nd) - _ln_factorial(kd) - _ln_factorial(nd - kd)
    top = top + kd * F.log(F.lit(p)) + (nd - kd) * F.log(F.lit(1 - p))
    terms = F.least(k, (40 * F.sqrt(nd * p * (1 - p)) + 100).cast("long"))
    total = F.aggregate(
        F.sequence(F.lit(0).cast("long"), terms),
        F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("sum")),
        lambda a, j: F.struct(
            (a["term"] * (kd - j) / (nd - kd + j + 1) * F.lit((1 - p) / p)).alias("term"),
            (a["sum"] + a["term"]).alias("sum"),
        ),
        lambda a: a["sum"],
    )
    return F.when(kd >= nd * p, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.exp(top) * total))


def labelled_once(counted: DataFrame, labels: DataFrame, rules: list[str]) -> DataFrame:
    """stratum, _quality and the signals of each labelled doc_id that passes the base rule, once.

    The binomial bounds need independent holdouts, and copies of a row are
    none: of the rows of a doc_id the one with the smallest (stratum, signals)
    counts, whatever their number.
    """
    truth = (
        pick(labels, "doc_id", "quality")
        .where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy(F.col("doc_id").alias("_label_id"))
        .agg(F.min("quality").alias("_quality"))
    )
    known = counted.where(~F.col("base_failed")).join(truth, F.col("doc_id") == F.col("_label_id"))
    one = known.groupBy("_label_id").agg(F.min(F.struct("stratum", *rules, "_quality")).alias("k"))
    return one.select("k.*")


def select_cutoffs(
    counted: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA, grid: dict | None = None
) -> DataFrame:
    """stratum, rule, cutoff, n_good, p_value: the certified cutoffs in force.

    ``counted`` has doc_id, stratum, base_failed and a column for each rule.
    Labelled rows are counted per (stratum, rule, grid place) before anything
    else, so what follows is as small as the grid times the strata.
    """
    grid = grid or GRID
    known = labelled_once(counted, labels, list(grid))
    # how many of a rule's cutoffs, mildest first, the signal exceeds: all from place `size - passed` on
    places = F.array(
        *[
            F.struct(
                F.lit(rule).alias("rule"),
                sum((F.col(rule) > c).cast("int") for c in cutoffs).alias("exceeded"),
            )
            for rule, cutoffs in grid.items()
        ]
    )
    tallies = (
        known.select("stratum", F.col("_quality"), F.explode(places).alias("p"))
        .groupBy("stratum", "p.rule", "p.exceeded")
        .agg(
            F.sum((F.col("_quality") > 0).cast("long")).alias("good"),
            F.sum((F.col("_quality") <= 0).cast("long")).alias("bad"),
        )
    )
    per_pair = tallies.groupBy("stratum", "rule").agg(
        F.sum("good").alias("n_good"),
        F.sum("bad").alias("n_bad"),
        F.collect_list(F.struct("exceeded", "good", "bad")).alias("t"),
    )
    # one row for each pair: an aggregate of counts
    n_pairs = per_pair.where(F.col("n_good") > 0).agg(F.greatest(F.count(F.lit(1)), F.lit(1)).alias("n_pairs"))
    cutoffs = F.create_map(
        *[x for rule, cs in grid.items() for x in (F.lit(rule), F.array(*[F.lit(float(c)) for c in cs]))]
    )
    tried = per_pair.select(
        "stratum", "rule", "n_good", "n_bad", "t", F.posexplode(cutoffs[F.col("rule")]).alias("place", "cutoff")
    )
    n_places = F.size(cutoffs[F.col("rule")])

    # exceeding the mildest cutoff means exceeding all: `exceeded` counts from the strict end
    def above(which: str) -> Column:
        return F.aggregate(
            F.filter("t", lambda x: x["exceeded"] >= n_places - F.col("place")),
            F.lit(0).cast("long"),
            lambda a, x: a + x[which],
        )

    tried = tried.select(
        "stratum", "rule", "place", "cutoff", "n_good", "n_bad", above("good").alias("k_good"), above("bad").alias("k_bad")
    )
    tried = tried.withColumn("p_value", binomial_tail(F.col("k_good"), F.col("n_good"), alpha / len(grid)))
    pair = Window.partitionBy("stratum", "rule")
    tried = tried.crossJoin(F.broadcast(n_pairs)).withColumn("passed", F.col("p_value") <= delta / F.col("n_pairs"))
    tried = tried.withColumn("unbroken", F.min("passed").over(pair.orderBy("place")))
    gain = F.col("k_bad") / F.greatest(F.col("n_bad"), F.lit(1)) - F.col("k_good") / F.greatest(F.col("n_good"), F.lit(1))
    best = (
        tried.where(F.col("unbroken") & (F.col("n_good") > 0))
        .withColumn("gain", gain)
        .where("gain > 0")
        .withColumn("_r", F.row_number().over(pair.orderBy(F.desc("gain"), "place")))
        .where("_r = 1")
    )
    return best.select("stratum", "rule", "cutoff", "n_good", "p_value")


def select_joint_cutoffs(
    counted: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA, grid: dict | None = None
) -> DataFrame:
    """stratum, rule, cutoff, n_good, p_value: cutoffs certified together, one set for a stratum.

    A path tightens a set of rules place by place from the mildest cutoffs on,
    so the documents that its steps reject are nested. Each step is tested as a
    whole: not more than ``alpha`` of the good documents rejected by any of its
    rules. Bad labels alone say which rules have a path and which of their
    places are steps, so the paths are fixed before a good label is looked at.
    The level of a stratum is ``delta`` divided by the strata whose good labels
    could certify anything; half of it goes to the path of all its rules, half
    to the paths of its smaller sets. Of all certified steps the one that
    rejects most bad documents beyond the good ones counts.
    """
    grid = grid or GRID
    rules, n_rules = list(grid), len(grid)
    known = labelled_once(counted, labels, list(grid))

    # the place of the mildest cutoff that the signal exceeds, null if none
    def first_place(rule: str) -> Column:
        exceeded = sum((F.col(rule) > c).cast("int") for c in grid[rule])
        return F.when(exceeded > 0, F.lit(len(grid[rule])) - exceeded)

    places = [f"_p{i}" for i in range(n_rules)]
    cells = (
        known.select("stratum", "_quality", *[first_place(r).alias(p) for r, p in zip(rules, places)])
        .groupBy("stratum", *places)
        .agg(
            F.sum((F.col("_quality") > 0).cast("long")).alias("good"),
            F.sum((F.col("_quality") <= 0).cast("long")).alias("bad"),
        )
    )
    cells = written(cells, "cells")  # as many as the grid has, for a stratum
    strata = cells.groupBy(F.col("stratum").alias("_s")).agg(
        F.sum("good").alias("n_good"),
        F.sum("bad").alias("n_bad"),
        *[F.collect_set(F.when(F.col("bad") > 0, F.col(p))).alias(f"_steps{i}") for i, p in enumerate(places)],
    )
    useful = sum(F.when(F.size(f"_steps{i}") > 0, 1 << i).otherwise(0) for i in range(n_rules))
    strata = strata.withColumn("_useful", useful).where(F.col("_useful") > 0)
    strata = strata.where(F.pow(F.lit(1 - alpha), F.col("n_good")) <= delta)
    n_strata = strata.agg(F.greatest(F.count(F.lit(1)), F.lit(1)).alias("n_strata"))
    n_paths = F.pow(F.lit(2.0), F.bit_count("_useful")) - 1

    # the step of a path at which a document is rejected: by place, and by rule within a place
    def rejected_at(i: int) -> Column:
        return F.array_min(F.filter(f"_steps{i}", lambda x: x >= F.col(places[i]))) * n_rules + i

    times = [rejected_at(i) for i in range(n_rules)]
    paths = []
    for path in range(1, 1 << n_rules):
        own = [t for i, t in enumerate(times) if path >> i & 1]
        paths.append(F.struct(F.lit(path).alias("path"), (F.least(*own) if len(own) > 1 else own[0]).alias("step")))
    tallies = (
        cells.join(strata, F.col("stratum") == F.col("_s"))
        .select("stratum", "n_good", "n_bad", "_useful", "good", "bad", F.explode(F.array(*paths)).alias("p"))
        .where((F.col("p.path").bitwiseAND(F.col("_useful")) == F.col("p.path")) & F.col("p.step").isNotNull())
        .groupBy("stratum", "n_good", "n_bad", "_useful", "p.path", "p.step")
        .agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    )
    upto = Window.partitionBy("stratum", "path").orderBy("step")
    tried = tallies.withColumn("k_good", F.sum("good").over(upto)).withColumn("k_bad", F.sum("bad").over(upto))
    share = F.when(n_paths == 1, 1.0).when(F.col("path") == F.col("_useful"), 0.5).otherwise(0.5 / (n_paths - 1))
    tried = tried.withColumn("p_value", binomial_tail(F.col("k_good"), F.col("n_good"), alpha))
    # along a path k_good, and with it the p-value, never falls: no step behind a failure passes
    tried = tried.crossJoin(F.broadcast(n_strata)).where(F.col("p_value") <= delta * share / F.col("n_strata"))
    gain = F.col("k_bad") / F.greatest(F.col("n_bad"), F.lit(1)) - F.col("k_good") / F.col("n_good")
    order = Window.partitionBy("stratum").orderBy(F.desc("gain"), F.bit_count("path"), "step", "path")
    best = tried.withColumn("gain", gain).where("gain > 0").withColumn("_r", F.row_number().over(order)).where("_r = 1")
    best = best.join(strata.select("_s", *[f"_steps{i}" for i in range(n_rules)]), F.col("stratum") == F.col("_s"))

    def cutoff_of(i: int) -> Column:
        reached = F.array_max(F.filter(f"_steps{i}", lambda x: x * n_rules + i <= F.col("step")))
        cutoffs = F.array(*[F.lit(float(c)) for c in grid[rules[i]]])
        return F.when(F.col("path").bitwiseAND(F.lit(1 << i)) > 0, F.get(cutoffs, reached))

    chosen = [F.struct(F.lit(rule).alias("rule"), cutoff_of(i).alias("cutoff")) for i, rule in enumerate(rules)]
    out = best.select("stratum", "n_good", "p_value", F.explode(F.array(*chosen)).alias("c")).where("c.cutoff is not null")
    return out.select("stratum", "c.rule", "c.cutoff", "n_good", "p_value")


def judge(
    docs: DataFrame,
    labels: DataFrame,
    stratum: str = "lang",
    alpha: float = ALPHA,
    delta: float = DELTA,
    grid: dict | None = None,
    more: tuple[str, ...] = (),
    joint: bool = False,
) -> DataFrame:
    """Base counts, stratum, ``more`` columns, failed_rules and kept for every row of ``docs``.

    ``joint``: cutoffs of a stratum are certified together. The narrow counts are written once; calibration and the verdict read them
    and never the texts again.
    """
    grid = grid or GRID
    counted = base_counts(docs, stratum, *more).withColumnRenamed(stratum, "stratum")
    counted = counted.withColumn("stratum", F.coalesce(F.col("stratum").cast("string"), F.lit("")))
    counted = written(counted, "quality")
    select = select_joint_cutoffs if joint else select_cutoffs
    chosen = written(select(counted, labels, alpha, delta, grid), "cutoffs")
    by_stratum = chosen.groupBy(F.col("stratum").alias("_s")).agg(
        F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("_cutoffs")
    )
    joined = counted.join(by_stratum, F.col("stratum") == F.col("_s"), "left")
    failed = F.filter(
        F.array(*[F.when(F.col(rule) > F.col("_cutoffs")[rule], F.lit(rule)) for rule in grid]), lambda x: x.isNotNull()
    )
    return joined.select(
        *[c for c in counted.columns],
        failed.alias("failed_rules"),
        (~F.col("base_failed") & (F.size(failed) == 0)).alias("kept"),
    )
