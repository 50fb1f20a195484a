"""Tick operators: body parsing (P7, F2), tick change (R12), latest tick (A14)
and per-batch price statistics (A13)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricerisk.functions.expressions import tick_direction
from pricerisk.operators.scan import ordered_scan
from pricerisk.schemas import TICK

CHANGE_DECIMALS = 4


def parse_ticks(raw: DataFrame, body_col: str = "body", schema: T.StructType = TICK) -> DataFrame:
    """Message bytes -> string -> JSON struct -> top-level fields; drop rows without a symbol.

    Malformed bodies parse to all-NULL fields and are dropped with them.
    ``timestamp`` is declared TIMESTAMP, so ISO-8601 strings parse to instants.
    """
    data = F.from_json(F.col(body_col).cast("string"), schema).alias("data")
    return raw.select(data).select("data.*").filter(F.col("symbol").isNotNull())


def _order(ticks: DataFrame, ts: str, tiebreak: str | None) -> Column:
    """Ordering key for latest-by-time: ``(ts, tiebreak)``, or bare ``ts``.

    A bare column keeps ``max_by`` a hash aggregate; the struct needed for an
    exact tie-break makes Spark fall back to a sort-based aggregate.
    """
    if tiebreak and tiebreak in ticks.columns:
        return F.struct(F.col(ts), F.col(tiebreak))
    return F.col(ts)


def tick_change(
    ticks: DataFrame,
    *,
    key: str = "symbol",
    ts: str = "timestamp",
    tiebreak: str | None = "event_id",
    base: DataFrame | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Previous price and percentage change of each tick within its symbol.

    ``prev_price`` is the symbol's last known price before the tick by
    ``(ts, tiebreak)``: ticks without a price (NULL) do not change it, as they
    do not change the state of the streams. ``change_pct = round((price - prev)
    / prev * 100, 4)``, or 0.0 when there is no previous price or it is 0. An
    optional ``base`` frame ``(symbol, base_price)`` seeds it. ``direction`` is
    ``↑`` / ``↓`` / ``-``. The scan is the skew-safe :func:`ordered_scan`.
    """
    order = [ts] + ([tiebreak] if tiebreak and tiebreak in ticks.columns else [])
    s = ordered_scan(ticks, key, order, "price", last_known_as="prev_price", ranges=ranges)
    if base is not None:
        seed = base.select(F.col(key).alias("_seed_key"), F.col("base_price").alias("_seed"))
        s = s.join(seed, F.col(key).eqNullSafe(F.col("_seed_key")), "left")
        s = s.withColumn("prev_price", F.coalesce("prev_price", "_seed")).drop("_seed_key", "_seed")
    return with_change(s)


def with_change(df: DataFrame) -> DataFrame:
    """Add ``change_pct`` (0.0 without a non-zero previous price) and ``direction`` from price/prev_price."""
    prev = F.col("prev_price")
    has_prev = prev.isNotNull() & (prev != F.lit(0.0))
    change = F.when(
        has_prev & F.col("price").isNotNull(), F.round((F.col("price") - prev) / prev * F.lit(100.0), CHANGE_DECIMALS)
    ).otherwise(F.lit(0.0))
    return df.withColumn("change_pct", change).withColumn("direction", tick_direction("price", "prev_price"))


def latest_tick(
    ticks: DataFrame, group: Sequence[str] = ("symbol",), *, ts: str = "timestamp", tiebreak: str | None = "event_id"
) -> DataFrame:
    """Latest price per group by ``(ts, tiebreak)``: one ``max_by`` pass, no per-symbol jobs."""
    o = _order(ticks, ts, tiebreak)
    return (
        ticks.filter(F.col("price").isNotNull())
        .groupBy(*group)
        .agg(F.max_by(F.struct(F.col("price"), F.col(ts)), o).alias("_l"))
        .select(*group, F.col("_l.price").alias("latest_price"), F.col(f"_l.{ts}").alias("latest_ts"))
    )


def price_stats(
    ticks: DataFrame, group: Sequence[str | Column], *, ts: str = "timestamp", tiebreak: str | None = "event_id"
) -> DataFrame:
    """Per group: volatility (sample stddev), avg/max/min price, current price, tick count.

    ``current_price`` is the price of the group's latest tick. Ticks with a
    NULL price are ignored (the aggregates skip them anyway, and a NULL latest
    price would make the drop rule undefined).
    """
    o = _order(ticks, ts, tiebreak)
    return (
        ticks.filter(F.col("price").isNotNull())
        .groupBy(*group)
        .agg(
            F.stddev_samp("price").alias("volatility"),
            F.avg("price").alias("avg_price"),
            F.max("price").alias("max_price"),
            F.min("price").alias("min_price"),
            F.max_by(F.col("price"), o).alias("current_price"),
            F.count(F.lit(1)).alias("n_ticks"),
        )
    )


def batch_metrics(ticks: DataFrame, batch_col: str = "batch", **kw) -> DataFrame:
    """:func:`price_stats` per ``(batch, symbol)``; a batch is one micro-batch (or its batch twin)."""
    return price_stats(ticks, [batch_col, "symbol"], **kw)
