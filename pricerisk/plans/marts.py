"""Layered batch build: staged bars -> CORE daily table -> three MARTS.

The core table is written once and read back; the three marts then scan the
written Parquet instead of recomputing the window plan three times, and
``daily_return IS NOT NULL`` reaches that scan as a pushed filter. Writing
through the shared checkpoint folder also cuts the lineage, so losing an
executor while the marts run costs a re-read of core, not a rebuild.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame

from pricerisk.operators.correlation import correlation_matrix
from pricerisk.operators.portfolio import portfolio_summary
from pricerisk.operators.returns import daily_returns
from pricerisk.operators.risk import risk_metrics
from pricerisk.sinks.writers import open_table, publish_table

CORE_TABLE = "int_stock_daily"
MART_TABLES = ("mart_risk_metrics", "mart_portfolio_summary", "mart_correlation")


@dataclass
class Marts:
    core: DataFrame
    risk_metrics: DataFrame
    portfolio_summary: DataFrame
    correlation: DataFrame


def build_core(prices: DataFrame, *, base: str | None = None, key: str | None = None, name: str = CORE_TABLE) -> DataFrame:
    """Compute and publish the core daily table (layer ``core``).

    ``key`` names what ``prices`` were read from (see
    :func:`pricerisk.session.fingerprint`): a core table published under the
    same key is found and not built again, in this session or a later one.
    """
    if key is not None:
        found = open_table(prices.sparkSession, "core", name, base=base, key=key)
        if found is not None:
            return found
    return publish_table(daily_returns(prices), "core", name, base=base, key=key or "")


def build_marts(
    prices: DataFrame, *, base: str | None = None, concurrent: bool = True, key: str | None = None
) -> Marts:
    """Build core, then the risk, portfolio and correlation marts; return the published tables.

    Each table is a durable one (:func:`pricerisk.sinks.writers.publish_table`):
    it is swapped in when it is whole, and a later session finds it. ``key``
    lets a core table that was built from the same prices be used again.

    The three marts only read core, so with ``concurrent`` their jobs are
    submitted together from a small thread pool and share the cluster's
    task slots instead of waiting for one another.
    """
    core = build_core(prices, base=base, key=key)
    plans = {
        MART_TABLES[0]: risk_metrics(core),
        MART_TABLES[1]: portfolio_summary(core),
        MART_TABLES[2]: correlation_matrix(core),
    }
    if concurrent:
        with ThreadPoolExecutor(max_workers=len(plans)) as pool:
            futures = {n: pool.submit(publish_table, df, "marts", n, base=base) for n, df in plans.items()}
            out = {n: f.result() for n, f in futures.items()}
    else:
        out = {n: publish_table(df, "marts", n, base=base) for n, df in plans.items()}
    return Marts(core, out[MART_TABLES[0]], out[MART_TABLES[1]], out[MART_TABLES[2]])
