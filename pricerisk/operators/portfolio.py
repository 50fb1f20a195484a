"""Latest prices (R8), portfolio mart (R9), per-symbol last price (E5) and base prices (A15)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricerisk.functions.expressions import REPORT_DECIMALS
from pricerisk.operators.returns import clean_returns

# Fixed value: price used when a symbol has no recent close.
FALLBACK_BASE_PRICE = 100.0
BASE_PRICE_LOOKBACK_DAYS = 5


def latest_prices(core: DataFrame) -> DataFrame:
    """Rows dated on the GLOBAL latest date: symbol, latest_close, latest_date.

    The latest date is an uncorrelated scalar subquery (evaluated once); a
    symbol that did not trade on that day has no row here.
    """
    max_date = core.agg(F.max("date")).scalar()
    return core.filter(F.col("date") == max_date).select(
        "symbol", F.col("close").alias("latest_close"), F.col("date").alias("latest_date")
    )


def _int_avg(col: str) -> Column:
    """Integer (truncating) average of a BIGINT column: ``sum div count``."""
    return F.call_function("div", F.sum(col), F.nullif(F.count(col), F.lit(0)))


def portfolio_summary(core: DataFrame) -> DataFrame:
    """Portfolio mart, one row per symbol (and per distinct latest price), by symbol.

    Columns: symbol, trading_days, avg_close, min_close, max_close (4 dp),
    avg_volume (integer average), latest_close, latest_date. Statistics use
    non-NULL-return rows; symbols missing on the global latest date drop out.

    The statistics are aggregated per symbol first and the latest-price rows
    per (symbol, latest_close, latest_date) with their multiplicity; joining
    the two small results then equals joining every return row with the
    latest rows and grouping, including the case of repeated latest rows
    (counts scale by the multiplicity, averages and extremes do not).
    """
    stats = clean_returns(core).groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg("close"), REPORT_DECIMALS).alias("avg_close"),
        F.round(F.min("close"), REPORT_DECIMALS).alias("min_close"),
        F.round(F.max("close"), REPORT_DECIMALS).alias("max_close"),
        _int_avg("volume").alias("avg_volume"),
    )
    latest = latest_prices(core).groupBy("symbol", "latest_close", "latest_date").agg(
        F.count(F.lit(1)).alias("mult")
    )
    return (
        stats.join(latest, "symbol")
        .select(
            "symbol",
            (F.col("n") * F.col("mult")).alias("trading_days"),
            "avg_close",
            "min_close",
            "max_close",
            "avg_volume",
            "latest_close",
            "latest_date",
        )
        .orderBy("symbol")
    )


def latest_price_per_symbol(core: DataFrame) -> DataFrame:
    """Each symbol's own last close and date (not the global latest date).

    ``max_by`` over ``(date, close)`` is a declarative aggregate, combined
    map-side; ties on date resolve to the larger close.
    """
    last = F.max(F.struct(F.col("date"), F.col("close")))
    return core.groupBy("symbol").agg(last.alias("_l")).select(
        "symbol", F.col("_l.close").alias("latest_close"), F.col("_l.date").alias("latest_date")
    )


def base_prices(
    prices: DataFrame,
    universe: DataFrame,
    as_of: dt.date | str | None = None,
    *,
    lookback_days: int = BASE_PRICE_LOOKBACK_DAYS,
    trading_days: bool = False,
    fallback: float = FALLBACK_BASE_PRICE,
) -> DataFrame:
    """Starting price per universe symbol: last close within the lookback window.

    The window is ``(as_of - lookback_days, as_of]``; ``as_of`` defaults to the
    latest date in ``prices``. With ``trading_days`` the window is the last
    ``lookback_days`` dates up to ``as_of`` on which any symbol traded, so
    weekends and holidays do not use it up. Symbols without a close in the
    window get ``fallback`` and ``is_fallback = true``.
    """
    as_of_col = F.lit(as_of).cast("date") if as_of is not None else prices.agg(F.max("date")).scalar()
    recent = prices.filter(F.col("date") <= as_of_col)
    if trading_days:
        # the calendar: as many rows as are asked for, found by a bounded sort
        calendar = recent.select("date").distinct().orderBy(F.desc("date")).limit(lookback_days)
        recent = recent.filter(F.col("date") >= calendar.agg(F.min("date")).scalar())
    else:
        recent = recent.filter(F.col("date") > F.date_sub(as_of_col, lookback_days))
    last = recent.groupBy("symbol").agg(F.max(F.struct(F.col("date"), F.col("close"))).alias("_l"))
    return universe.select("symbol").join(last, "symbol", "left").select(
        "symbol",
        F.coalesce(F.col("_l.close"), F.lit(fallback)).alias("base_price"),
        F.col("_l.close").isNull().alias("is_fallback"),
    )
