"""Exact percentiles per key by distributed rank selection (A8, W3, R4).

``percentile()`` keeps a map of all of a key's values in one buffer, which for
a hot key is one task's memory. Here values are counted first (a hash
aggregate by key and value, combined map-side, so equal values travel once),
the counts are summed up in order of the values by :func:`ordered_scan` (a hot
key is cut into ranges), and the two values whose ranks enclose the percentile
are picked by their running counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricerisk.operators.scan import ordered_scan


def exact_percentile(df: DataFrame, key: str, value: str, p: float, out: str, *, ranges: int | None = None) -> DataFrame:
    """``(key, out)``: the linearly interpolated ``p`` percentile of each key's non-NULL values.

    The value at rank ``p * (n - 1)`` (from 0) of the ``n`` sorted values, as
    ``PERCENTILE_CONT`` has it. Keys without a value have no row; a NULL key is
    a key of its own.
    """
    if not 0.0 <= p <= 1.0:
        raise ValueError(f"a percentile needs p from 0 to 1, not {p}")
    counts = df.filter(F.col(value).isNotNull()).groupBy(key, F.col(value).alias("_x")).agg(F.count(F.lit(1)).alias("_c"))
    s = ordered_scan(counts, key, ["_x"], "_c", running_sum_as="_upto", total_as="_n", ranges=ranges)
    rank = F.lit(float(p)) * (F.col("_n") - 1)

    def at(r):
        """The value that holds rank ``r``: ranks ``_upto - _c`` to ``_upto - 1`` are its own."""
        return F.max(F.when((r >= F.col("_upto") - F.col("_c")) & (r < F.col("_upto")), F.col("_x")))

    near = s.filter((F.ceil(rank) >= F.col("_upto") - F.col("_c")) & (F.floor(rank) < F.col("_upto")))
    found = near.groupBy(key).agg(at(F.floor(rank)).alias("_lo"), at(F.ceil(rank)).alias("_hi"), F.max(rank).alias("_r"))
    part = F.col("_r") - F.floor("_r")
    between = (F.lit(1.0) - part) * F.col("_lo") + part * F.col("_hi")
    return found.select(key, F.when(part == 0, F.col("_lo").cast("double")).otherwise(between).alias(out))
