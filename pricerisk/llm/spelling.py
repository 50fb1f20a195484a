"""Spelling variants: exact neighbours at one edit, by a dictionary of trie-node pairs.

Words stand in two tries, one of the words and one of the reversed words. All
nodes of both are numbered. A word with code point i left out is then a pair
of integers: the node of what stands before i in the first trie, and the node
of what stands after i in the second. Two words of equal length differ in code
point i alone if they meet at such a pair. The pair of the nodes that meet
between two code points, with nothing left out, is the word itself with a
place to insert: a longer word whose skipped pair equals it has one code point
more. Of a run of equal code points only the first counts as left out here, so
two words meet once. No pair of words is made: at each integer pair the words
that meet (no more than there are letters, and one shorter word) are counted
and the two best are kept.

The tries are never in one place. Words are cut into ranges of their order;
within a range a node is new where a word stops agreeing with the word before
it, and nodes are numbered as they come. What the first word of a range shares
with the range before (one path of nodes) is carried over on the driver: one
word's path for each range.

A word's form is its most frequent neighbour, if that is at least ``factor``
times as frequent. Forms are followed to the end by pointer doubling; a form
is ten times as frequent as its word, so there are few rounds at any size.

Defined results: null and empty texts have no words; a null doc_id counts as
the empty string in the noise hash; repeated rows count again; words of any
length are whole; ties of frequency go to the word that is smaller in
code-point order; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricerisk.llm.common import pick, shuffle_partitions, written

MIN_LENGTH, MIN_COUNT = 7, 2
FACTOR = 10
#: One run in so many is disturbed by leaving out one of its code points.
NOISE = 31
#: Entries of a task's word counts that are handed on at once.
HELD_WORDS = 200_000

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {c: c + 32 for c in range(65, 91)}

COUNTED = T.StructType([T.StructField("word", T.StringType(), False), T.StructField("n", T.LongType(), False)])
SUMMARY = T.StructType(
    [
        T.StructField("part", T.IntegerType(), False),
        T.StructField("first", T.StringType(), False),
        T.StructField("last", T.StringType(), False),
        T.StructField("path", T.ArrayType(T.LongType(), False), False),
        T.StructField("n_words", T.LongType(), False),
        T.StructField("n_nodes", T.LongType(), False),
    ]
)
NUMBERED = T.StructType(
    [
        T.StructField("word", T.StringType(), False),
        T.StructField("place", T.LongType(), False),
        T.StructField("nodes", T.ArrayType(T.LongType(), False), False),
    ]
)


def disturbed(run: str, doc_id: str) -> str:
    """A lower-cased run as it is counted: where the hash says so, without one of its code points."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    if h % NOISE:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """word, n of the words of all whole texts."""

    def run(batches):
        counts: dict[str, int] = {}
        for batch in batches:
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                own: dict[str, int] = {}
                for x in _RUN.findall((text or "").translate(_LOWER)):
                    own[x] = own.get(x, 0) + 1
                for x, n in own.items():
                    w = disturbed(x, doc_id or "")
                    if len(w) >= min_length:
                        counts[w] = counts.get(w, 0) + n
                if len(counts) >= HELD_WORDS:
                    yield pa.RecordBatch.from_pydict({"word": list(counts), "n": list(counts.values())}, schema=arrow)
                    counts = {}
        yield pa.RecordBatch.from_pydict({"word": list(counts), "n": list(counts.values())}, schema=arrow)

    arrow = pa.schema([pa.field("word", pa.string(), False), pa.field("n", pa.int64(), False)])
    d = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    return d.mapInArrow(run, COUNTED).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _agreeing(a: str, b: str) -> int:
    """Length of the common beginning."""
    if b.startswith(a):
        return len(a)
    for k, (x, y) in enumerate(zip(a, b)):
        if x != y:
            return k
    return min(len(a), len(b))


def _ranges(batches):
    """(range, its words in order) of batches sorted by (part, word); words come as they are read."""
    held = None
    for batch in batches:
        for part, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if held is None or part != held:
                held = part
                yield part, word, True
            else:
                yield part, word, False


def number_trie(words: DataFrame) -> DataFrame:
    """word, place (rank in code-point order, from 0) and nodes of distinct, non-empty ``words``.

    ``nodes`` has the number of the trie node of every beginning, the empty
    one (the root, 0) first: equal numbers are equal beginnings.
    """
    spark = words.sparkSession
    n = shuffle_partitions(spark)
    ranged = words.select("word").repartitionByRange(n, "word").withColumn("part", F.spark_partition_id())
    ranged = written(ranged.select("part", "word"), "word-ranges")
    dealt = ranged.repartition(n, "part").sortWithinPartitions("part", "word")

    def summarise(batches):
        state = None
        for part, word, new in _ranges(batches):
            if new:
                if state:
                    yield state
                # nodes of the range's first word are all new, until the driver knows better
                state = [part, word, word, list(range(len(word))), 1, len(word)]
                continue
            same = _agreeing(state[2], word)
            fresh = len(word) - same
            state[3] = state[3][:same] + list(range(state[5], state[5] + fresh))
            state[2], state[4], state[5] = word, state[4] + 1, state[5] + fresh
        if state:
            yield state

    def summary(batches):
        for row in summarise(batches):
            yield pa.RecordBatch.from_pydict({k: [v] for k, v in zip(SUMMARY.fieldNames(), row)}, schema=arrow_summary)

    arrow_summary = pa.schema(
        [
            pa.field("part", pa.int32(), False),
            pa.field("first", pa.string(), False),
            pa.field("last", pa.string(), False),
            pa.field("path", pa.list_(pa.field("element", pa.int64(), False)), False),
            pa.field("n_words", pa.int64(), False),
            pa.field("n_nodes", pa.int64(), False),
        ]
    )
    # one row for each range; ranges number as many as shuffle partitions
    carried: dict[int, tuple[int, int, list[int]]] = {}
    last, path, words_before, nodes_before = "", [], 0, 1
    for r in sorted(dealt.mapInArrow(summary, SUMMARY).collect(), key=lambda r: r["part"]):
        same = path[: _agreeing(last, r["first"])]
        carried[r["part"]] = (words_before, nodes_before, same)
        shared = _agreeing(r["first"], r["last"])
        path = [same[k] if k < min(len(same), shared) else nodes_before + x for k, x in enumerate(r["path"])]
        last, words_before, nodes_before = r["last"], words_before + r["n_words"], nodes_before + r["n_nodes"]
    before = spark.sparkContext.broadcast(carried)

    def number(batches):
        out: list[tuple[str, int, list[int]]] = []
        size = 0
        last, path, place, free = "", [], 0, 0
        for part, word, new in _ranges(batches):
            if new:
                place, free, same = before.value[part]
                # numbers for the whole first word are set aside, as the summary did
                path = same + list(range(free + len(same), free + len(word)))
                free += len(word)
            else:
                same = _agreeing(last, word)
                path = path[:same] + list(range(free, free + len(word) - same))
                free += len(word) - same
                place += 1
            last = word
            out.append((word, place, [0, *path]))
            size += len(word)
            if size > 200_000:
                yield _numbered(out)
                out, size = [], 0
        yield _numbered(out)

    return dealt.mapInArrow(number, NUMBERED)


def _numbered(rows: list[tuple[str, int, list[int]]]) -> pa.RecordBatch:
    words, places, nodes = (list(x) for x in zip(*rows)) if rows else ([], [], [])
    schema = pa.schema(
        [
            pa.field("word", pa.string(), False),
            pa.field("place", pa.int64(), False),
            pa.field("nodes", pa.list_(pa.field("element", pa.int64(), False)), False),
        ]
    )
    return pa.RecordBatch.from_pydict({"word": words, "place": places, "nodes": nodes}, schema=schema)


def number_words(words: DataFrame) -> DataFrame:
    """word, n, place, nodes (of its beginnings) and back (of its ends, the empty one first) of ``words`` (word, n)."""
    forward = number_trie(words)
    backward = number_trie(words.select(F.reverse("word").alias("word")))
    back = backward.select(F.reverse("word").alias("word"), F.col("nodes").alias("back"))
    return forward.join(back, "word").join(words, "word").select("word", "n", "place", "nodes", "back")


def node_pairs(numbered: DataFrame) -> DataFrame:
    """before, after (node numbers), skipped, first, place, n: the pair dictionary of ``number_words``.

    ``skipped`` is true where a code point is left out between the two nodes
    and false where they meet; ``first`` is false for a code point that equals
    the one before it. ``place`` names the word.
    """
    size = F.size("nodes") - 1

    def pair(i, end, skipped, first):
        return F.struct(
            F.get("nodes", i).alias("before"),
            F.get("back", end).alias("after"),
            F.lit(skipped).alias("skipped"),
            first.alias("first"),
        )

    def repeated(i):
        return (i > 0) & (F.get("letters", i) == F.get("letters", F.greatest(i - 1, F.lit(0))))

    skips = F.transform(F.sequence(F.lit(0), size - 1), lambda i: pair(i, size - 1 - i, True, ~repeated(i)))
    meets = F.transform(F.sequence(F.lit(0), size), lambda i: pair(i, size - i, False, F.lit(True)))
    rows = numbered.withColumn("letters", F.split("word", ""))
    return rows.select("place", "n", F.explode(F.concat(skips, meets)).alias("p")).select("p.*", "place", "n")


def neighbours(pairs: DataFrame) -> DataFrame:
    """place, n_near, best (n and minus place of the most frequent neighbour) of words with a neighbour.

    The words that meet at a pair of nodes differ in one letter, so they are at
    most as many as there are letters, with one word without that letter.
    """
    who = F.struct("n", (-F.col("place")).alias("minus_place"))
    met = pairs.groupBy("before", "after").agg(
        F.collect_list(F.when(F.col("skipped"), F.struct(who.alias("who"), "first"))).alias("skips"),
        F.max(F.when(~F.col("skipped"), who)).alias("shorter"),
    )
    met = met.where((F.size("skips") > 1) | ((F.size("skips") > 0) & F.col("shorter").isNotNull()))
    ranked = F.sort_array(F.transform("skips", lambda s: s["who"]), asc=False)
    longer = F.filter("skips", lambda s: s["first"])
    met = met.select(
        "skips",
        "shorter",
        F.get(ranked, F.lit(0)).alias("top"),
        F.get(ranked, F.lit(1)).alias("second"),
        F.size(longer).alias("n_longer"),
        F.array_max(F.transform(longer, lambda s: s["who"])).alias("best_longer"),
    )
    of_skips = F.transform(
        "skips",
        lambda s: F.struct(
            s["who"].alias("who"),
            (F.size("skips") - 1 + F.when(s["first"] & F.col("shorter").isNotNull(), 1).otherwise(0)).alias("n_near"),
            F.greatest(
                F.when(s["who"] == F.col("top"), F.col("second")).otherwise(F.col("top")),
                F.when(s["first"], F.col("shorter")),
            ).alias("best"),
        ),
    )
    of_shorter = F.when(
        F.col("shorter").isNotNull() & (F.col("n_longer") > 0),
        F.array(F.struct(F.col("shorter").alias("who"), F.col("n_longer").alias("n_near"), F.col("best_longer").alias("best"))),
    ).otherwise(F.array().cast("array<struct<who:struct<n:bigint,minus_place:bigint>,n_near:int,best:struct<n:bigint,minus_place:bigint>>>"))
    each = met.select(F.explode(F.concat(of_skips, of_shorter)).alias("e")).where("e.best is not null or e.n_near > 0")
    return each.groupBy((-F.col("e.who.minus_place")).alias("place")).agg(F.sum("e.n_near").alias("n_near"), F.max("e.best").alias("best"))


def follow(forms: DataFrame) -> DataFrame:
    """place, root: where the links place -> form of ``forms`` end, for every word that has a form."""
    live = written(forms.select("place", F.col("form").alias("root")), "forms")
    while True:
        ahead = live.select(F.col("place").alias("root"), F.col("root").alias("next"))
        moved = live.join(ahead, "root", "left").select("place", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        moved = written(moved, "forms")
        live = moved.select("place", "root")
        if moved.where("moved").isEmpty():
            return live


def variant_groups(
    docs: DataFrame, factor: int = FACTOR, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT
) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``docs`` (doc_id, text)."""
    words = written(word_counts(docs, min_length, min_count), "words")
    numbered = written(number_words(words), "trie-words")
    near = neighbours(node_pairs(numbered))
    place = numbered.select("word", "n", "place")
    known = written(place.join(near, "place", "left"), "neighbours")
    linked = F.col("best.n") >= factor * F.col("n")
    known = known.withColumn("form", F.when(linked, -F.col("best.minus_place"))).withColumn("form_n", F.when(linked, F.col("best.n")))
    roots = follow(known.where(F.col("form").isNotNull()))
    name = place.select(F.col("place").alias("_p"), F.col("word").alias("_w"))
    full = known.join(roots, "place", "left")
    full = full.join(name.toDF("form", "form_word"), "form", "left").join(name.toDF("root", "root_word"), "root", "left")
    return full.select(
        "word",
        F.col("form_word").alias("form"),
        F.coalesce("root_word", "word").alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        "form_n",
    )
