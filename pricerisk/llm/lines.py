"""Line dedup by overlapping windows of three lines. DataFrame functions only.

Lines that hold a word are numbered within their document, and every run of
three consecutive ones is a window. A window that occurs more than once in the
whole corpus stays at its first occurrence (by doc_id, then text hash, then
position); every line covered by a later occurrence goes. Overlapping
occurrences merge because lines, not windows, are removed.

Every removed line has an equal line earlier in that order, so the earliest
copy of each line survives: nothing leaves the corpus entirely. Lines without
a word stay where they are.

Defined results: a document with fewer than three such lines, an empty or a
null text stays as it is; a null doc_id sorts last; rows with equal doc_id and
text are one document and get the same result; extra columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricerisk.llm.common import HAS_WORD, pick, written

WINDOW = 3


def _keyed(docs: DataFrame, *more: str) -> DataFrame:
    d = pick(docs, "doc_id", "text", *more)
    return d.withColumn("_h1", F.xxhash64("text")).withColumn("_h2", F.crc32("text"))


def line_windows(docs: DataFrame) -> DataFrame:
    """doc_id, _h1, _h2 (the text's hashes), lines (places of the window's lines), h, g (the window's two hashes)."""
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.struct(x.alias("x"), i.alias("i")))
    d = _keyed(docs).select("doc_id", "_h1", "_h2", F.filter(lines, lambda s: s["x"].rlike(HAS_WORD)).alias("_l"))
    d = d.where(F.size("_l") >= WINDOW)
    ls = F.col("_l")

    def window(s, j):
        following = [F.get(ls, j + k) for k in range(1, WINDOW)]
        texts = [s["x"], *[f["x"] for f in following]]
        return F.struct(
            F.xxhash64(*texts).alias("h"),
            F.xxhash64(F.lit(WINDOW), *texts).alias("g"),
            F.array(s["i"], *[f["i"] for f in following]).alias("lines"),
        )

    # only hashes and places leave the row
    windows = F.transform(F.slice(ls, 1, F.greatest(F.size(ls) - (WINDOW - 1), F.lit(0))), window)
    return d.select("doc_id", "_h1", "_h2", F.explode(windows).alias("w")).select(
        "doc_id", "_h1", "_h2", "w.h", "w.g", "w.lines"
    )


def later_windows(windows: DataFrame) -> DataFrame:
    """Windows that have an equal one earlier in the corpus.

    A window's occurrences are reduced to the earliest one before they meet
    (partial aggregation), and only repeated hashes are joined back; a hash
    with very many occurrences is split by the adaptive skew join.
    """
    place = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "_h1", "_h2", F.col("lines")[0].alias("at"))
    first = (
        windows.groupBy(F.col("h").alias("_h"), F.col("g").alias("_g"))
        .agg(F.min(place).alias("_first"), F.count(F.lit(1)).alias("_n"), F.max(place).alias("_last"))
        .where((F.col("_n") > 1) & (F.col("_first") != F.col("_last")))
        .select("_h", "_g", "_first")
    )
    same = (F.col("h") == F.col("_h")) & (F.col("g") == F.col("_g"))
    return windows.join(first, same).where(place != F.col("_first")).select("doc_id", "_h1", "_h2", "lines")


def dedup_lines(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, ``more``, text without repeated lines, n_lines (with a word), n_removed.

    The narrow windows are written once; the texts are read again and joined
    with the places to remove, which only documents with a repeat have.
    """
    windows = written(line_windows(docs), "windows")
    covered = (
        later_windows(windows)
        .select("doc_id", "_h1", "_h2", F.explode("lines").alias("line"))
        .groupBy("doc_id", "_h1", "_h2")
        .agg(F.collect_set("line").alias("_gone"))
        .select(F.col("doc_id").alias("_d"), F.col("_h1").alias("_a"), F.col("_h2").alias("_b"), "_gone")
    )
    d = _keyed(docs, *more).join(
        covered,
        F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_h1") == F.col("_a")) & (F.col("_h2") == F.col("_b")),
        "left",
    )
    d = d.select("doc_id", *more, "text", "_gone", F.split("text", "\n").alias("_l"))
    ls = F.col("_l")
    left = F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), F.col("_gone"))
    return d.select(
        "doc_id",
        *more,
        F.when(F.col("_gone").isNull(), F.col("text"))
        .otherwise(F.array_join(F.transform(left, lambda i: F.get(ls, i)), "\n"))
        .alias("text"),
        F.coalesce(F.size(F.filter(ls, lambda x: x.rlike(HAS_WORD))), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_removed"),
    )
