"""Risk mart (R3-R7) and its single-metric views.

All metrics are built on :func:`clean_returns` rows. Count/avg/stddev/min/max/
max-drawdown come out of one ``groupBy(symbol)`` of declarative aggregates,
which Spark pre-aggregates map-side in a hash aggregate. The exact percentile
is a rank selection over counted values (:mod:`pricerisk.operators.percentile`)
that joins it with one row per symbol.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricerisk.functions.expressions import ANNUALISATION_DAYS, REPORT_DECIMALS, pct
from pricerisk.operators.percentile import exact_percentile
from pricerisk.operators.returns import clean_returns, drawdown_series

VAR_PROBABILITY = 0.05  # historical VaR 95 = 5th percentile of daily returns
_SQRT_DAYS = math.sqrt(ANNUALISATION_DAYS)

R = "daily_return"


def _aggs(names: list[str]) -> list[Column]:
    defs = {
        "trading_days": F.count(F.lit(1)),
        "avg_r": F.avg(R),
        "std_r": F.stddev_samp(R),
        "min_r": F.min(R),
        "max_r": F.max(R),
        "mdd": F.max("drawdown"),
    }
    return [defs[n].alias(n) for n in names]


def _sharpe() -> Column:
    return F.round(F.col("avg_r") / F.nullif(F.col("std_r"), F.lit(0.0)) * F.lit(_SQRT_DAYS), REPORT_DECIMALS)


def volatility(core: DataFrame, periods: int = ANNUALISATION_DAYS) -> DataFrame:
    """Daily volatility (sample stddev of returns, NULL for one return) and its annualised form, in percent."""
    g = clean_returns(core).groupBy("symbol").agg(*_aggs(["std_r"]))
    return g.select(
        "symbol",
        pct("std_r").alias("daily_volatility_pct"),
        pct(F.col("std_r") * F.lit(math.sqrt(periods))).alias("annual_volatility_pct"),
    )


def sharpe_ratio(core: DataFrame) -> DataFrame:
    """``avg / nullif(stddev, 0) * sqrt(252)`` with no risk-free rate, 4 dp."""
    g = clean_returns(core).groupBy("symbol").agg(*_aggs(["avg_r", "std_r"]))
    return g.select("symbol", _sharpe().alias("sharpe_ratio"))


def _with_percentile(rows: DataFrame, core: DataFrame, p: float, out: str, ranges: int | None = None) -> DataFrame:
    """``rows`` with their symbol's percentile of returns as ``out``; a NULL symbol is a symbol too."""
    found = exact_percentile(clean_returns(core), "symbol", R, p, out, ranges=ranges)
    found = found.withColumnRenamed("symbol", "_symbol")
    return rows.join(found, F.col("symbol").eqNullSafe(F.col("_symbol"))).drop("_symbol")


def value_at_risk(core: DataFrame, p: float = VAR_PROBABILITY, *, ranges: int | None = None) -> DataFrame:
    """Historical VaR: exact linear-interpolated ``p`` percentile of returns, signed, in percent."""
    g = exact_percentile(clean_returns(core), "symbol", R, p, "var_r", ranges=ranges)
    return g.select("symbol", pct("var_r").alias("var_95_pct"))


def var_95_window(core: DataFrame, p: float = VAR_PROBABILITY) -> DataFrame:
    """Window form of VaR: every return row carries its symbol's percentile.

    Same value as ``PERCENTILE_CONT(p) WITHIN GROUP (ORDER BY daily_return)
    OVER (PARTITION BY symbol)``. Instead of buffering a whole symbol in one
    window task, the percentile is selected by rank (one row per symbol) and
    joined back to the rows on ``symbol``.
    """
    r = clean_returns(core).select("symbol", "date", "daily_return")
    return _with_percentile(r, core, p, "var_95")


def max_drawdown(core: DataFrame, *, ranges: int | None = None) -> DataFrame:
    """Largest fall from the running peak close, in percent (4 dp)."""
    g = drawdown_series(core, ranges=ranges).groupBy("symbol").agg(*_aggs(["mdd"]))
    return g.select("symbol", pct("mdd").alias("max_drawdown_pct"))


def risk_metrics(core: DataFrame, *, ranges: int | None = None) -> DataFrame:
    """Full risk mart, one row per symbol, ordered by annual volatility desc.

    Columns: symbol, trading_days, avg_daily_return_pct, daily_volatility_pct,
    annual_volatility_pct, max_daily_loss_pct, max_daily_gain_pct, var_95_pct,
    sharpe_ratio, max_drawdown_pct. One scan (for the running peak) and one
    grouped aggregate give all of them but the percentile, which joins them
    with one row per symbol.
    """
    g = drawdown_series(core, ranges=ranges).groupBy("symbol").agg(
        *_aggs(["trading_days", "avg_r", "std_r", "min_r", "max_r", "mdd"])
    )
    g = _with_percentile(g, core, VAR_PROBABILITY, "var_r", ranges)
    return g.select(
        "symbol",
        "trading_days",
        pct("avg_r").alias("avg_daily_return_pct"),
        pct("std_r").alias("daily_volatility_pct"),
        pct(F.col("std_r") * F.lit(_SQRT_DAYS)).alias("annual_volatility_pct"),
        pct("min_r").alias("max_daily_loss_pct"),
        pct("max_r").alias("max_daily_gain_pct"),
        pct("var_r").alias("var_95_pct"),
        _sharpe().alias("sharpe_ratio"),
        pct("mdd").alias("max_drawdown_pct"),
    ).orderBy(F.col("annual_volatility_pct").desc_nulls_last())
