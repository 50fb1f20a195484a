"""Layered build: core is written once; the marts read it and equal the direct computation."""

from pricerisk.operators import correlation as corr
from pricerisk.operators import portfolio as pf
from pricerisk.operators import returns as ret
from pricerisk.operators import risk
from pricerisk.plans.marts import build_marts
from pricerisk.sources import fixtures as fx
from tests.conftest import SF_SMALL


def test_build_marts_matches_direct(spark, tmp_dir):
    bars = fx.lineitem_bars(spark, SF_SMALL)
    m = build_marts(bars, base=tmp_dir)
    core = ret.daily_returns(bars)
    assert sorted(m.core.collect()) == sorted(core.collect())
    assert sorted(m.risk_metrics.collect()) == sorted(risk.risk_metrics(core).collect())
    assert sorted(m.portfolio_summary.collect()) == sorted(pf.portfolio_summary(core).collect())
    assert sorted(m.correlation.collect()) == sorted(corr.correlation_matrix(core).collect())
    # tables are registered as views for SQL users
    assert spark.table("marts_mart_risk_metrics").count() == m.risk_metrics.count()
    n = spark.sql("SELECT count(*) FROM core_int_stock_daily WHERE daily_return IS NOT NULL").first()[0]
    assert n == ret.clean_returns(core).count()


def test_core_scan_pushes_return_filter(spark, tmp_dir):
    bars = fx.lineitem_bars(spark, SF_SMALL)
    core = build_marts(bars, base=tmp_dir).core
    plan = ret.clean_returns(core)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(daily_return)]" in plan
