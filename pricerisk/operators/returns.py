"""Core daily table (R1), the returns filter (F1) and the drawdown series (R2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricerisk.functions.expressions import simple_return
from pricerisk.operators.scan import ordered_scan

CORE_COLUMNS = ["date", "symbol", "close", "prev_close", "daily_return", "open", "high", "low", "volume"]


def daily_returns(prices: DataFrame, *, ranges: int | None = None) -> DataFrame:
    """Core table: previous close and simple daily return per symbol.

    ``prev_close = lag(close)`` per symbol ordered by date and
    ``daily_return = round((close - prev_close) / nullif(prev_close, 0), 6)``.
    The rounding happens here, before any downstream statistic. The lag runs
    through :func:`ordered_scan`, so long or hot symbols are split across
    tasks.
    """
    p = prices.select("date", "symbol", "close", "open", "high", "low", "volume")
    s = ordered_scan(p, "symbol", ["date"], "close", lag_as="prev_close", ranges=ranges)
    return s.select(
        "date",
        "symbol",
        "close",
        "prev_close",
        simple_return("close", "prev_close").alias("daily_return"),
        "open",
        "high",
        "low",
        "volume",
    )


def clean_returns(core: DataFrame) -> DataFrame:
    """Rows with a non-NULL ``daily_return``.

    This drops each symbol's first day, and with it that day's close and
    volume, from every statistic built on top.
    """
    return core.filter(F.col("daily_return").isNotNull())


def drawdown_series(core: DataFrame, *, ranges: int | None = None) -> DataFrame:
    """Running peak close and drawdown from that peak, per symbol by date.

    Computed on :func:`clean_returns` rows only, so the first day is outside
    the running max as well.
    ``drawdown = (rolling_max - close) / nullif(rolling_max, 0)``.
    """
    r = clean_returns(core).select("symbol", "date", "close", "daily_return")
    s = ordered_scan(r, "symbol", ["date"], "close", running_max_as="rolling_max", ranges=ranges)
    return s.select(
        "symbol",
        "date",
        "close",
        "daily_return",
        "rolling_max",
        ((F.col("rolling_max") - F.col("close")) / F.nullif(F.col("rolling_max"), F.lit(0.0))).alias(
            "drawdown"
        ),
    )
