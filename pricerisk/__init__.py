"""pricerisk: equity price and risk analytics on Spark DataFrames.

Daily OHLCV bars -> per-symbol daily returns -> risk, portfolio and
correlation marts; the same alert rules over batch tables and tick streams.
Parsing, optimisation and execution are Spark's.
"""

__version__ = "0.1.0"

from pricerisk.operators.alerts import alerts, batch_alerts, windowed_alerts  # noqa: E402
from pricerisk.operators.bars import daily_bars  # noqa: E402
from pricerisk.operators.correlation import correlation_matrix, return_pairs  # noqa: E402
from pricerisk.operators.dedup import dedup_prices  # noqa: E402
from pricerisk.operators.portfolio import (  # noqa: E402
    base_prices,
    latest_price_per_symbol,
    latest_prices,
    portfolio_summary,
)
from pricerisk.operators.returns import clean_returns, daily_returns, drawdown_series  # noqa: E402
from pricerisk.operators.risk import (  # noqa: E402
    max_drawdown,
    risk_metrics,
    sharpe_ratio,
    value_at_risk,
    var_95_window,
    volatility,
)
from pricerisk.operators.scan import ordered_scan  # noqa: E402
from pricerisk.operators.ticks import batch_metrics, latest_tick, parse_ticks, tick_change  # noqa: E402
from pricerisk.plans.marts import build_marts  # noqa: E402
from pricerisk.session import get_session  # noqa: E402

__all__ = [
    "alerts",
    "base_prices",
    "batch_alerts",
    "batch_metrics",
    "build_marts",
    "clean_returns",
    "correlation_matrix",
    "daily_bars",
    "daily_returns",
    "dedup_prices",
    "drawdown_series",
    "get_session",
    "latest_price_per_symbol",
    "latest_prices",
    "latest_tick",
    "max_drawdown",
    "ordered_scan",
    "parse_ticks",
    "portfolio_summary",
    "return_pairs",
    "risk_metrics",
    "sharpe_ratio",
    "tick_change",
    "value_at_risk",
    "var_95_window",
    "volatility",
    "windowed_alerts",
]
