"""Ranked lexical search for many items at once, by common-subexpression evaluation.

A score is a sum over an item's terms, so what two items share is summed once
for both. The terms of a block of items are mined for shared sets: terms that
occur in exactly the same items form one class, then the pair of nodes that
most items hold becomes a node of its own, and so on, pairs of pairs included,
while two items share a pair. Terms, classes and pairs are the nodes of a
sharing DAG; an item's score is the sum of the few nodes it is left with.

Documents stay where they are. One pass over the whole texts writes each
document's length and its occurrences of item terms; corpus counts come from
that table; a second pass over it holds the accumulators of some documents as
one array (a row for each DAG node), fills the rows of the terms, and adds
along the DAG, every partial accumulator once. A task hands on its best ``k``
documents of each item, and these are ranked in two steps (some tasks
together, then all), so no task sees more than its share.

Items are taken in blocks of bounded size (``block_terms`` terms, repeats
counted, on average), each by its own passes; a block's terms and DAG are what
is broadcast. A single item is never divided.

Defined results: null texts have no term, and such documents and items have no
result; documents without a term do not count; documents of equal doc_id are
separate, a null doc_id comes after all others; item rows that repeat item_id
and text count once, and different texts of one item_id are ranked each by
itself; empty tables give an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from pricerisk.llm.common import pick, written

K = 50
BLOCK_TERMS = 50_000
#: Numbers in the accumulators that a task holds at once (8 bytes each).
HELD_NUMBERS = 2_000_000
#: Tasks whose best documents are ranked together in the first step.
FAN_IN = 64
#: Nodes that a node is paired with in one round of mining: the next ones in order of sharing.
REACH = 24

#: ASCII characters that end a term (all but digits and letters) become spaces, A to Z become a to z.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))

POSTINGS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n", T.LongType(), False),
        T.StructField("terms", T.BinaryType(), False),
        T.StructField("tf", T.BinaryType(), False),
    ]
)
FOUND = T.StructType(
    [
        T.StructField("item", T.IntegerType(), False),
        T.StructField("item_id", T.LongType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("score", T.LongType(), False),
    ]
)


def terms_of(text: bytes) -> list[bytes]:
    """Terms of a UTF-8 text, in order."""
    return text.translate(_FOLD).split()


def shared_pairs(items: list[set[int]], first: int) -> dict[int, tuple[int, int]]:
    """Nodes, numbered from ``first``, each the sum of two nodes that some items share; ``items`` then use them.

    Greedy, in rounds: the pair that most items hold becomes a node in all of
    them, until no two items share two nodes that a round pairs. A round looks
    at each item's nodes in order of how shared they are, each with the next
    ``REACH``, so its work is linear in the items' size.
    """
    made: dict[int, tuple[int, int]] = {}
    while True:
        held_by: dict[int, list[int]] = {}
        for k, item in enumerate(items):
            for x in item:
                held_by.setdefault(x, []).append(k)
        counts: Counter = Counter()
        for item in items:
            order = sorted((x for x in item if len(held_by[x]) > 1), key=lambda x: (-len(held_by[x]), x))
            for j, a in enumerate(order):
                counts.update((a, b) for b in order[j + 1 : j + 1 + REACH])
        before = len(made)
        for (a, b), n in sorted(counts.items(), key=lambda c: (-c[1], c[0])):
            if n < 2:
                break
            both = [k for k in held_by[a] if a in items[k] and b in items[k]]
            if len(both) < 2:
                continue
            x = first + len(made)
            made[x] = (a, b)
            for k in both:
                items[k] -= {a, b}
                items[k].add(x)
        if len(made) == before:
            return made


class SharingDag:
    """Which partial sums a block of items shares.

    ``items`` are sets of term numbers below ``n_terms``. Rows of an
    accumulator: one for each term, then one for each class, then one for each
    shared pair, level by level, so that a pair comes after what it adds.
    """

    def __init__(self, items: list[set[int]], n_terms: int):
        owners: dict[int, list[int]] = {}
        for k, item in enumerate(items):
            for t in item:
                owners.setdefault(t, []).append(k)
        classes: dict[tuple[int, ...], list[int]] = {}
        for t in sorted(owners):
            classes.setdefault(tuple(owners[t]), []).append(t)
        self.n_terms, self.n_classes = n_terms, len(classes)
        members = list(classes.values())
        self.class_terms = np.array([t for m in members for t in m], dtype=np.int64)
        self.class_starts = np.cumsum([0, *[len(m) for m in members[:-1]]])[: len(members)]
        own: list[set[int]] = [set() for _ in items]
        for c, held_by in enumerate(classes):
            for k in held_by:
                own[k].add(n_terms + c)
        pairs = shared_pairs(own, n_terms + len(members))
        # numbered anew by level
        level: dict[int, int] = {}
        for x, (a, b) in pairs.items():
            level[x] = 1 + max(level.get(a, 0), level.get(b, 0))
        order = sorted(pairs, key=lambda x: (level[x], x))
        row = {x: n_terms + len(members) + j for j, x in enumerate(order)}
        self.levels = []
        for depth in range(1, max(level.values(), default=0) + 1):
            part = [x for x in order if level[x] == depth]
            left, right = ([row.get(pairs[x][side], pairs[x][side]) for x in part] for side in (0, 1))
            self.levels.append((row[part[0]], row[part[-1]] + 1, np.array(left), np.array(right)))
        self.item_rows = np.array([row.get(x, x) for item in own for x in sorted(item)], dtype=np.int64)
        self.item_starts = np.cumsum([0, *[len(item) for item in own[:-1]]])
        self.n_rows = n_terms + len(members) + len(pairs)
        #: Additions for a document: along the DAG, and if each item summed its own terms.
        self.additions = len(self.class_terms) - len(members) + len(pairs) + len(self.item_rows) - len(items)
        self.plain_additions = sum(len(i) - 1 for i in items)

    def combine(self, acc: np.ndarray) -> np.ndarray:
        """Scores (items x documents) from ``acc``, whose term rows are filled and whose other rows are free."""
        lo = self.n_terms
        acc[lo : lo + self.n_classes] = np.add.reduceat(acc[self.class_terms], self.class_starts, axis=0)
        for lo, hi, left, right in self.levels:
            np.add(acc[left], acc[right], out=acc[lo:hi])
        return np.add.reduceat(acc[self.item_rows], self.item_starts, axis=0)


class Best:
    """The best ``k`` documents of each item so far: highest score, then smallest doc_id, null last."""

    def __init__(self, n_items: int, k: int):
        self.k, self.floor = k, np.ones(n_items, dtype=np.int64)
        self.room = max(100_000, 4 * n_items * k)
        self.held = [np.zeros(0, dtype=np.int64) for _ in range(4)]
        self.new: list[tuple[np.ndarray, ...]] = []
        self.n_new = 0

    def add(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        item, doc = np.nonzero(scores >= self.floor[:, None])
        self.new.append((item, scores[item, doc], nulls[doc], ids[doc]))
        self.n_new += len(item)
        if self.n_new > self.room:
            self.settle()

    def settle(self) -> list[np.ndarray]:
        """Item numbers, scores, null marks and ids of the best, in order of item and rank."""
        item, score, null, doc = (np.concatenate(x) for x in zip(self.held, *self.new))
        order = np.lexsort((doc, null, -score, item))
        item = item[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        order, item, place = order[place < self.k], item[place < self.k], place[place < self.k]
        self.held = [item, score[order], null[order], doc[order]]
        full = place == self.k - 1
        self.floor[item[full]] = self.held[1][full]
        self.new, self.n_new = [], 0
        return self.held


def postings(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """doc_id, n and the occurrences of ``terms`` (uint32 numbers and counts) of every document with a term."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches):
        number = {t: k for k, t in enumerate(vocabulary.value)}
        for batch in batches:
            ids, sizes, found, counts = [], [], [], []
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                words = terms_of(text.as_py() or b"")
                if not words:
                    continue
                seen = Counter(words)
                both = sorted((number[t], seen[t]) for t in seen.keys() & number.keys())
                ids.append(doc_id.as_py())
                sizes.append(len(words))
                found.append(np.array([t for t, _ in both], dtype="<u4").tobytes())
                counts.append(np.array([c for _, c in both], dtype="<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(found, pa.binary()), pa.array(counts, pa.binary())],
                names=POSTINGS.fieldNames(),
            )

    d = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return d.mapInArrow(run, POSTINGS)


def document_frequencies(posted: DataFrame, n_terms: int) -> np.ndarray:
    """The number of documents that hold each term."""

    def run(batches):
        total = np.zeros(n_terms, dtype=np.int64)
        for batch in batches:
            held = np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype="<u4")
            total += np.bincount(held, minlength=n_terms)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["term", "df"])

    rows = posted.select("terms").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect()
    out = np.zeros(n_terms, dtype=np.int64)
    for r in rows:
        out[r["term"]] = r["df"]
    return out


def _search_block(docs: DataFrame, items: list[tuple[int | None, list[bytes]]], k: int) -> DataFrame:
    """item_id, rank, doc_id, score for a block of items given as (item_id, distinct terms)."""
    spark = docs.sparkSession
    terms = sorted({t for _, own in items for t in own})
    number = {t: j for j, t in enumerate(terms)}
    dag = SharingDag([{number[t] for t in own} for _, own in items], len(terms))
    posted = written(postings(docs, terms), "postings")
    size = posted.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("l")).first()
    n_docs, length = size["n"], size["l"]
    df = document_frequencies(posted, len(terms)) if n_docs else np.zeros(len(terms), dtype=np.int64)
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], dtype=np.int64)
    shared = spark.sparkContext.broadcast((dag, weight, [i for i, _ in items]))

    def run(batches):
        dag, weight, item_ids = shared.value
        best = Best(len(item_ids), k)
        at_once = max(1, HELD_NUMBERS // dag.n_rows)
        acc = np.empty((dag.n_rows, at_once), dtype=np.int64)
        for batch in batches:
            ids = batch.column(0)
            nulls = np.asarray(ids.is_null()).astype(np.int64)
            ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
            norm = np.array([50 + 50 * n * n_docs // length for n in batch.column(1).to_pylist()], dtype=np.int64)
            for lo in range(0, len(ids), at_once):
                part = batch.slice(lo, at_once)
                own = part.column(2).to_pylist()
                term = np.frombuffer(b"".join(own), dtype="<u4").astype(np.int64)
                tf = np.frombuffer(b"".join(part.column(3).to_pylist()), dtype="<u4").astype(np.int64)
                doc = np.repeat(np.arange(len(own)), [len(x) // 4 for x in own])
                now = acc[:, : len(own)]
                now[: dag.n_terms] = 0
                now[term, doc] = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * norm[lo + doc]))
                best.add(dag.combine(now), ids[lo : lo + at_once], nulls[lo : lo + at_once])
        item, score, null, doc = best.settle()
        for lo in range(0, len(item), 10_000):
            p = slice(lo, lo + 10_000)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(item[p].astype(np.int32)),
                    pa.array([item_ids[j] for j in item[p]], pa.int64()),
                    pa.array(doc[p], pa.int64(), mask=null[p] > 0),
                    pa.array(score[p]),
                ],
                names=FOUND.fieldNames(),
            )

    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    found = posted.mapInArrow(run, FOUND).withColumn("_some", F.expr(f"spark_partition_id() div {FAN_IN}"))
    some = Window.partitionBy("item", "_some").orderBy(*order)
    whole = Window.partitionBy("item").orderBy(*order)
    found = found.withColumn("_r", F.row_number().over(some)).where(F.col("_r") <= k)
    found = found.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= k)
    return found.select("item_id", "rank", "doc_id", "score")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = K, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank (from 1), doc_id, score of each item's ``k`` best documents.

    ``docs`` has doc_id and text, ``items`` has item_id and text.
    """
    spark = docs.sparkSession
    rows = pick(items, "item_id", "text").where(F.col("text").isNotNull())
    rows = rows.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    # an upper bound of the terms of all items: every second character may be one
    size = rows.agg(F.sum(F.size(F.split("text", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))).alias("n")).first()["n"]
    blocks = -(-(size or 0) // block_terms)
    rows = written(rows.withColumn("_block", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(blocks, 1)))), "items")
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for b in range(blocks):
        # one block's items: bounded by block_terms, in order, so that every run numbers them alike
        texts = rows.where(F.col("_block") == b).select("item_id", "text").orderBy("item_id", "text").collect()
        block = [(r["item_id"], sorted(set(terms_of(r["text"].encode())))) for r in texts]
        block = [x for x in block if x[1]]
        if block:
            out = out.union(_search_block(docs, block, k))
    return out
