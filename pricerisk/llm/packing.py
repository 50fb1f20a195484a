"""Best-fit packing by minimum bin slack.

Every document becomes its token ids and an end id; only documents longer than
a sequence are cut, into full pieces after a first piece that may be shorter.
Sequences are then filled one pattern at a time: the longest piece left opens
a sequence, and a bitset subset-sum over the lengths still available finds the
combination that leaves the least slack beside it. That combination is removed
as many times as the remaining counts allow.

The search needs only the histogram of lengths, at most ``capacity`` numbers
whatever the table's size, so it runs on the driver. The pieces themselves
never leave Spark: each gets a number within its length, and a small table of
(length, range of numbers) rows says which sequence and place that number has.

Defined results: a null or empty text is a piece of the end id alone; repeated
rows are packed one by one; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricerisk.llm.common import numbered, pick, tidy
from pricerisk.llm.tokens import encoder, in_slices

CAPACITY = 1024
END_ID = 2

PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
)

PLAN = T.StructType([T.StructField(n, T.LongType()) for n in ("p_length", "lo", "hi", "uses", "first_bin", "base")])


def cut_points(n: int, capacity: int) -> list[int]:
    """Starts of the pieces of ``n`` ids: full pieces, the first may be shorter."""
    first = n - capacity * (-(-n // capacity) - 1)
    return [0, *range(first, n, capacity)]


def pieces_of(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, crc of its ids (little-endian uint32)."""

    def run(batches):
        enc = encoder(tokenizer_path)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in in_slices(texts):
                rows = ([], [], [], [], [])
                for doc, raw in zip(ids[a:b], enc.encode(texts[a:b])):
                    tokens = np.append(np.frombuffer(raw, dtype=enc.dtype), end_id).astype("<u4")
                    starts = cut_points(len(tokens), capacity)
                    for k, lo in enumerate(starts):
                        part = tokens[lo : starts[k + 1] if k + 1 < len(starts) else len(tokens)]
                        for column, value in zip(rows, (doc, k, lo, len(part), zlib.crc32(part.tobytes()))):
                            column.append(value)
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=t) for c, t in zip(rows, types)], names=PIECES.fieldNames()
                )

    return pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text").mapInArrow(tidy(run), PIECES)


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of available lengths with the largest sum up to ``room``.

    Bit s of ``reach`` is set if some multiset sums to s. Lengths join from the
    longest, each at most as often as it is there; the search ends as soon as
    ``room`` itself is reached.
    """
    full = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in sorted((x for x in counts if x <= room and counts[x] > 0), reverse=True):
        steps.append((length, reach))
        for _ in range(min(counts[length], room // length)):
            wider = reach | (reach << length) & full
            if wider == reach:
                break
            reach = wider
        if reach >> room & 1:
            break
    at, chosen = reach.bit_length() - 1, {}
    for length, before in reversed(steps):
        # as few of this length as lead to a sum that the longer ones reach
        k = 0
        while not before >> at & 1:
            at -= length
            k += 1
        if k:
            chosen[length] = k
    return chosen


def minimum_bin_slack(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Patterns (length -> uses) and how many sequences have each; together they use every piece."""
    left = {x: n for x, n in histogram.items() if n > 0}
    if any(x > capacity or x < 1 for x in left):
        raise ValueError("a piece must be from 1 to capacity ids long")
    out = []
    while left:
        longest = max(left)
        left[longest] -= 1
        pattern = fullest(left, capacity - longest)
        left[longest] += 1
        pattern[longest] = pattern.get(longest, 0) + 1
        times = min(left[x] // k for x, k in pattern.items())
        out.append((pattern, times))
        for x, k in pattern.items():
            left[x] -= k * times
            if not left[x]:
                del left[x]
    return out


def placements(patterns: list[tuple[dict[int, int], int]]) -> list[tuple[int, ...]]:
    """PLAN rows: pieces of a length numbered lo to hi - 1 go to sequences from first_bin, ``uses`` to each, from ``base``."""
    used: dict[int, int] = {}
    rows, first = [], 0
    for pattern, times in patterns:
        base = 0
        for length in sorted(pattern, reverse=True):
            k = pattern[length]
            lo = used.get(length, 0)
            used[length] = lo + k * times
            rows.append((length, lo, lo + k * times, k, first, base))
            base += k * length
        first += times
    return rows


def pack_documents(
    docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: the place of every piece.

    The plan that is broadcast has a bound of its own: every pattern uses up
    or nearly uses up one of at most ``capacity`` lengths, so it holds some
    thousands of rows at any input size.
    """
    spark = docs.sparkSession
    ranked = numbered(
        pieces_of(docs, tokenizer_path, capacity, end_id), "length", ["doc_id", "piece", "start", "ids_crc32"], "_rank", "pieces"
    )
    # the numbered pieces' own file, not the texts, is read for the histogram
    histogram = {r["length"]: r["n"] for r in ranked.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = spark.createDataFrame(placements(minimum_bin_slack(histogram, capacity)), PLAN)
    placed = ranked.join(
        F.broadcast(plan),
        (F.col("length") == F.col("p_length")) & (F.col("_rank") >= F.col("lo")) & (F.col("_rank") < F.col("hi")),
    )
    inside = F.col("_rank") - F.col("lo")
    return placed.select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("first_bin") + F.expr("(_rank - lo) div uses")).alias("sequence_id"),
        (F.col("base") + (inside % F.col("uses")) * F.col("length")).alias("offset"),
    )
