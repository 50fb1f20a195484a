"""OHLCV daily bars from ticks (extension E2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def daily_bars(
    ticks: DataFrame,
    *,
    symbol: str = "symbol",
    ts: str = "timestamp",
    price: str = "price",
    tiebreak: str | None = None,
    volume: str | None = None,
) -> DataFrame:
    """One bar per ``(symbol, date)``: first/last price by time, high, low, volume.

    ``open``/``close`` are the prices of the earliest/latest tick of the day,
    ordered by ``(ts, tiebreak)``; ``volume`` sums ``volume`` when given, else
    counts ticks. Every aggregate here is declarative (``min_by``/``max_by``/
    ``min``/``max``/``sum``/``count``), so Spark combines partial aggregates
    map-side and a hot symbol never lands in one task as raw rows.
    """
    # a bare timestamp keeps hash aggregation; the tie-break struct needs a sort-based one
    order = F.struct(F.col(ts), F.col(tiebreak)) if tiebreak else F.col(ts)
    vol = F.sum(F.col(volume)).cast("long") if volume else F.count(F.lit(1))
    return (
        ticks.withColumn("date", F.col(ts).cast("date"))
        .groupBy(F.col(symbol).alias("symbol"), "date")
        .agg(
            F.min_by(F.col(price), order).alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max_by(F.col(price), order).alias("close"),
            vol.alias("volume"),
        )
        .select("date", "symbol", "open", "high", "low", "close", "volume")
    )
