"""Skew-safe ordered scans: per-key ``lag`` and running ``max``.

A plain ``Window.partitionBy(key).orderBy(...)`` sends every row of a key to
one task, so a symbol holding a third of all ticks becomes one task holding a
third of the data, and a burst of ticks defeats any cut by time. The scan here
is a segmented prefix scan over ranges of rows:

1. All rows have one total order: (key, order columns, hash of the whole row).
   The order is cut into ranges of about equal numbers of rows by border rows,
   quantiles of a sample. A row is in the sample if its hash is below a
   threshold set by the row count, so the sample has a bounded expected size,
   copies of a row count once, and the borders are a function of the rows
   alone: every branch of the plan, and every retry, agrees on them. Count,
   sample and borders are scalar subqueries of the one plan; planning runs no
   job and the plan is the same at all sizes.
2. A row's range is found by binary search among the borders. Ranges cut keys
   by rank, not by time: a hot or bursty key has as many ranges as its share
   of the rows asks for, and many thin keys lie within one range.
3. Inside each ``(key, range)`` group an ordinary window computes the lag and
   running max.
4. Only a key that a border falls into is in more than one range. For those
   keys alone, each ``(key, range)`` group is summarised by a partial aggregate
   (last value, maximum), and a window over the summary, at most two rows for
   each border, carries the last value and the running maximum across borders.
5. The carry is joined back on the ``(key, range)`` struct the window is
   partitioned by: a broadcast when it is small, otherwise a sort-merge join
   that reuses the window's partitioning, so the rows are shuffled once.
   Struct equality also matches NULL keys.

Rows that tie on ``order`` are ordered by the hash of the whole row, so results
do not depend on input order. Rows identical in every column are
interchangeable, so their mutual order cannot change any output value; they
stay in one range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_TIE = "_scan_tie"
_AT = "_scan_at"
_KC = "_scan_kc"

# Sampled rows for each range; the share of rows in a range then varies by about
# 1 / sqrt(SAMPLE_PER_RANGE).
SAMPLE_PER_RANGE = 64


def _place(key: str, order: list[str]) -> Column:
    """A row's place in the total order, as one comparable struct (NULLs first)."""
    return F.struct(
        F.col(key).alias("k"), *[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], F.col(_TIE).alias("t")
    )


def with_tie(df: DataFrame) -> DataFrame:
    return df.withColumn(_TIE, F.xxhash64(*[F.col(c) for c in df.columns]))


def range_borders(tied: DataFrame, key: str, order: list[str], ranges: int) -> Column:
    """Scalar subquery: the sorted array of places at which a new range begins, ``ranges - 1`` at most."""
    n = tied.agg(F.count(F.lit(1)).alias("n")).scalar()
    # the hash once more, so that the order of ties does not decide who is sampled
    chance = F.shiftrightunsigned(F.xxhash64(F.col(_TIE)), 11) / F.lit(float(1 << 53))
    sample = tied.filter(chance * n < F.lit(float(ranges * SAMPLE_PER_RANGE)))
    # a set: copies of a row are dropped where they are read
    sample = sample.agg(F.sort_array(F.collect_set(_place(key, order))).alias("s"))
    at = F.transform(
        F.sequence(F.lit(1), F.lit(max(1, ranges - 1))),
        lambda i: F.get("s", F.floor(i * F.size("s") / F.lit(ranges)).cast("int")),
    )
    known = F.filter(F.array_distinct(at), lambda p: p.isNotNull()) if ranges > 1 else F.slice("s", 1, 0)
    return sample.select(known).scalar()


def _search(borders: Column, place: Column, ranges: int) -> Column:
    """How many borders are at or before ``place``: binary search in steps of falling powers of two."""
    steps = [1 << b for b in reversed(range(max(1, ranges - 1).bit_length()))]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda i, step: F.when(F.get(borders, i + step - 1) <= place, i + step).otherwise(i),
    )


def with_ranges(df: DataFrame, key: str, order: list[str], ranges: int) -> DataFrame:
    """``df`` with its tie hash, its range number, ``(key, range)`` and whether a border falls into the key beside it.

    ``_scan_from`` is true where the key may have rows in the range before,
    ``_scan_to`` where it has rows in the range after.
    """
    tied = with_tie(df)
    at = tied.withColumn(_AT, range_borders(tied, key, order, ranges))
    borders = F.col(_AT)

    def found(r: Column) -> Column:
        before = F.when(r > 0, F.get(borders, F.greatest(r - 1, F.lit(0))))
        after = F.get(borders, r)
        return F.struct(
            F.struct(F.col(key).alias("k"), r.alias("c")).alias(_KC),
            (before.isNotNull() & before["k"].eqNullSafe(F.col(key))).alias("_scan_from"),
            (after.isNotNull() & after["k"].eqNullSafe(F.col(key))).alias("_scan_to"),
        )

    # a generator, so that the search runs once a row however often its result is used
    return at.select("*", F.inline(F.transform(F.array(_search(borders, _place(key, order), ranges)), found))).drop(_AT)


def ordered_scan(
    df: DataFrame,
    key: str,
    order: list[str] | tuple[str, ...],
    value: str,
    *,
    lag_as: str | None = None,
    running_max_as: str | None = None,
    first_as: str | None = None,
    last_known_as: str | None = None,
    running_sum_as: str | None = None,
    total_as: str | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Add ``lag(value, 1)``, running aggregates or the total of ``value`` per ``key``.

    Rows are ordered by the ``order`` columns (of any orderable type).
    ``lag_as`` names the previous row's ``value`` within the key (NULL for the
    key's first row). ``last_known_as`` names the last non-NULL ``value`` before
    the row. ``running_max_as`` names ``max(value)`` over the key's rows up to
    and including the current one (``ROWS BETWEEN UNBOUNDED PRECEDING AND
    CURRENT ROW``), ``running_sum_as`` the sum over the same rows and ``total_as``
    the sum over all the key's rows. ``first_as`` names a flag that is true on the key's first
    row. Every input row and column is kept. ``ranges`` is the number of ranges
    that all rows are cut into, by default the session's shuffle partitions.
    """
    if not (lag_as or running_max_as or first_as or last_known_as or running_sum_as or total_as):
        raise ValueError("ordered_scan needs the name of a column to add")
    order = list(order)
    cols = df.columns
    ranges = int(ranges or df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = with_ranges(df, key, order, ranges)

    w = Window.partitionBy(_KC).orderBy(*order, _TIE)
    up_to_last = w.rowsBetween(Window.unboundedPreceding, -1)
    inner = d
    if lag_as or first_as:
        inner = inner.withColumn("_in_lag", F.lag(value).over(w)).withColumn(
            "_first", F.lag(F.lit(True)).over(w).isNull()
        )
    if last_known_as:
        inner = inner.withColumn("_in_known", F.last(value, ignorenulls=True).over(up_to_last))
    up_to_now = w.rowsBetween(Window.unboundedPreceding, 0)
    if running_max_as:
        inner = inner.withColumn("_in_max", F.max(value).over(up_to_now))
    if running_sum_as:
        inner = inner.withColumn("_in_sum", F.sum(value).over(up_to_now))
    if total_as:
        inner = inner.withColumn("_in_total", F.sum(value).over(Window.partitionBy(_KC)))

    # Summary of the keys that borders fall into, as a partial aggregate over
    # the unshuffled rows: one row per (key, range) of those keys is shuffled.
    place = F.struct(*[F.col(c) for c in order], F.col(_TIE))
    at_borders = d.filter(F.col("_scan_from") | F.col("_scan_to"))
    wanted = {
        "_last": (lag_as, F.max_by(F.col(value), place)),
        "_known": (last_known_as, F.max_by(F.col(value), F.when(F.col(value).isNotNull(), place))),
        "_cmax": (running_max_as, F.max(value)),
        "_csum": (running_sum_as or total_as, F.sum(value)),
    }
    aggs = [agg.alias(name) for name, (asked, agg) in wanted.items() if asked]
    summary = at_borders.groupBy(_KC).agg(F.count(F.lit(1)).alias("_n"), *aggs)
    ws = Window.partitionBy(F.col(f"{_KC}.k")).orderBy(F.col(f"{_KC}.c"))
    earlier = ws.rowsBetween(Window.unboundedPreceding, -1)
    carries = {
        "_last": lambda: F.lag("_last").over(ws).alias("_carry_last"),
        "_known": lambda: F.last("_known", ignorenulls=True).over(earlier).alias("_carry_known"),
        "_cmax": lambda: F.max("_cmax").over(earlier).alias("_carry_max"),
        "_csum": lambda: F.sum("_csum").over(earlier).alias("_carry_sum"),
    }
    carry = summary.select(
        _KC,
        F.lag(F.lit(True)).over(ws).isNotNull().alias("_has_prev"),
        *[carries[name]() for name, (asked, _) in wanted.items() if asked],
        *([F.sum("_csum").over(Window.partitionBy(F.col(f"{_KC}.k"))).alias("_carry_total")] if total_as else []),
    )
    if not total_as:
        carry = carry.filter(F.col("_has_prev"))

    out = inner.join(carry, _KC, "left")
    sel: list[Column] = [F.col(c) for c in cols]
    if lag_as:
        sel.append(F.when(F.col("_first"), F.col("_carry_last")).otherwise(F.col("_in_lag")).alias(lag_as))
    if last_known_as:
        sel.append(F.coalesce("_in_known", "_carry_known").alias(last_known_as))
    if running_max_as:
        sel.append(F.greatest(F.col("_in_max"), F.col("_carry_max")).alias(running_max_as))
    if running_sum_as:
        both = F.coalesce(F.col("_in_sum") + F.col("_carry_sum"), "_in_sum", "_carry_sum")
        sel.append(both.alias(running_sum_as))
    if total_as:
        sel.append(F.coalesce("_carry_total", "_in_total").alias(total_as))
    if first_as:
        sel.append((F.col("_first") & ~F.coalesce("_has_prev", F.lit(False))).alias(first_as))
    return out.select(*sel)
