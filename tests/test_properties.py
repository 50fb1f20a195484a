"""Properties that hold on any input, checked on the fixtures and on random data."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as E
from pricerisk.operators.scan import ordered_scan
from tests.conftest import SF_SMALL

Q = E.queries()


def test_var_between_worst_and_best_day(spark):
    for r in Q["risk_metrics"](spark, SF_SMALL).collect():
        assert r.max_daily_loss_pct <= r.var_95_pct <= r.max_daily_gain_pct
        assert 0.0 <= r.max_drawdown_pct < 100.0  # positive closes


def test_correlations_bounded_and_all_pairs_present(spark):
    rows = Q["correlation_matrix_events"](spark, SF_SMALL).collect()
    assert len(rows) == 8 * 7 // 2  # every pair of the 8 event symbols shares a date
    assert all(r.symbol_1 < r.symbol_2 for r in rows)
    assert all(r.correlation is None or -1.0 <= r.correlation <= 1.0 for r in rows)


def test_at_most_three_alerts_per_symbol_and_batch(spark):
    a = Q["alerts"](spark, SF_SMALL)
    worst = a.groupBy("batch", "symbol").count().agg(F.max("count")).first()[0]
    assert worst is None or worst <= 3
    assert a.select("alert_id").distinct().count() == a.count()


def test_portfolio_counts_agree_with_risk(spark):
    risk = {r.symbol: r.trading_days for r in Q["risk_metrics"](spark, SF_SMALL).collect()}
    for r in Q["portfolio_summary"](spark, SF_SMALL).collect():
        assert r.trading_days == risk[r.symbol]


rows_strategy = st.lists(
    st.tuples(
        st.sampled_from(["h", "h", "h", "a", "b"]),
        st.integers(min_value=0, max_value=40),
        st.one_of(st.none(), st.floats(min_value=-50, max_value=50, allow_nan=False)),
    ),
    min_size=1,
    max_size=80,
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=rows_strategy, ranges=st.sampled_from([1, 3, 17, None]))
def test_scan_equals_window_on_random_data(spark, rows, ranges):
    df = spark.createDataFrame([(k, d, i, p) for i, (k, d, p) in enumerate(rows)], "k string, d int, id long, p double")
    w = Window.partitionBy("k").orderBy("d", "id")
    exp = df.select(
        "k", "d", "id", "p",
        F.lag("p").over(w).alias("prev"),
        F.max("p").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("runmax"),
    )
    got = ordered_scan(df, "k", ["d", "id"], "p", lag_as="prev", running_max_as="runmax", ranges=ranges)
    assert sorted(got.collect(), key=str) == sorted(exp.collect(), key=str)


corr_rows = st.lists(
    st.tuples(
        st.sampled_from(["A", "B", "C", "D", "E"]),
        st.integers(min_value=0, max_value=12),
        st.floats(min_value=-0.2, max_value=0.2, allow_nan=False).map(lambda x: round(x, 6)),
    ),
    min_size=2,
    max_size=60,
)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=corr_rows, block_days=st.sampled_from([1, 4, 1024]), tile=st.sampled_from([1, 2, 256]))
def test_blocked_correlation_equals_self_join(spark, rows, block_days, tile):
    import datetime as dt

    from pricerisk.operators.correlation import pair_statistics

    core = spark.createDataFrame(
        [(dt.date(2024, 1, 1) + dt.timedelta(days=d), s, x) for s, d, x in rows],
        "date date, symbol string, daily_return double",
    )
    a, b = core.alias("a"), core.alias("b")
    p = a.join(b, (F.col("a.date") == F.col("b.date")) & (F.col("a.symbol") < F.col("b.symbol"))).select(
        F.col("a.symbol").alias("symbol_1"), F.col("b.symbol").alias("symbol_2"),
        F.col("a.daily_return").alias("x"), F.col("b.daily_return").alias("y"),
    )
    ref = p.groupBy("symbol_1", "symbol_2").agg(
        F.count(F.lit(1)).alias("n"), F.sum("x").alias("sx"), F.sum("y").alias("sy"),
        F.sum(F.col("x") * F.col("y")).alias("sxy"), F.sum(F.col("x") * F.col("x")).alias("sx2"),
        F.sum(F.col("y") * F.col("y")).alias("sy2"),
    )
    exp = {(r.symbol_1, r.symbol_2): (r.n, r.sx, r.sy, r.sxy, r.sx2, r.sy2) for r in ref.collect()}
    got = {
        (r.symbol_1, r.symbol_2): (r.n, r.sum_x, r.sum_y, r.sum_xy, r.sum_x2, r.sum_y2)
        for r in pair_statistics(core, block_days=block_days, tile_size=tile).collect()
    }
    assert set(got) == set(exp)
    for k, (n, *sums) in exp.items():
        assert got[k][0] == n
        assert all(abs(g - e) <= 1e-12 for g, e in zip(got[k][1:], sums)), (k, got[k], exp[k])
