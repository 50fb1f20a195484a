"""Physical-plan properties the scale design relies on."""

import re

from pricerisk.operators import correlation as corr
from pricerisk.operators import returns as ret
from pricerisk.operators import risk
from pricerisk.operators import ticks as tk
from pricerisk.sinks.writers import materialize
from pricerisk.sources import fixtures as fx
from pricerisk.sources import prices as src
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _core(spark):
    return materialize(ret.daily_returns(fx.lineitem_bars(spark, SF_SMALL)), "core", "plan_test", view=False)


def _window_partitions(plan: str) -> list[str]:
    return re.findall(r"windowspecdefinition\(([^)]*?)(?:,\s*\w+#\d+\s+ASC|\))", plan)


def test_scans_never_window_rows_by_symbol_alone(spark):
    t = fx.event_ticks(spark, SF_SMALL)
    cases = (
        (ret.daily_returns(fx.lineitem_bars(spark, SF_SMALL)), r"lag\(close#\d+, -1, null\)"),
        (tk.tick_change(t), r"last\(price#\d+, true\)"),
    )
    for df, function in cases:
        plan = _plan(df)
        scans = re.findall(function + r" windowspecdefinition\(([^,]*),", plan)
        assert scans, plan
        # the row-level scan is partitioned by the (symbol, range) struct, never by symbol alone
        assert all(k.startswith("_scan_kc#") for k in scans), scans


def test_correlation_has_no_date_self_join(spark):
    plan = _plan(corr.correlation_matrix(_core(spark)))
    assert "FlatMapGroupsInPandas" in plan
    assert not re.search(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin) \[date#", plan)


def test_history_window_reaches_the_scan(spark):
    df = src.load_history(fx.lineitem_bars(spark, SF_SMALL), None, "1998-01-01", "1999-01-01")
    plan = _plan(df)
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(l_shipdate", plan)
    assert re.search(r"PushedFilters: \[[^\]]*LessThan\(l_shipdate", plan)


def test_risk_mart_aggregates_by_hash_and_joins_one_row_per_symbol(spark):
    plan = _plan(risk.risk_metrics(_core(spark)))
    # no percentile buffer: nothing that is grouped by symbol is an object aggregate
    # (the only ones left collect the bounded samples behind the scans' borders)
    assert "percentile(" not in plan
    assert all(k == "" for k in re.findall(r"ObjectHashAggregate\(keys=\[([^\]]*)\]", plan))
    assert re.search(r"HashAggregate\(keys=\[symbol#\d+\][^\n]*stddev_samp", plan)


def test_scan_reads_only_needed_columns(spark):
    core = _core(spark)
    plan = _plan(risk.volatility(core))
    scans = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    assert scans and all("open" not in s and "volume" not in s for s in scans), scans


def test_scan_join_reuses_window_partitioning_without_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        # many ranges, so most inherit a carry and the join is real
        df = tk.tick_change(fx.event_ticks(spark, SF_SMALL), ranges=100)
        df.collect()
        final = _plan(df).split("== Initial Plan ==")[0]
        lines = final.splitlines()
        i = next(n for n, line in enumerate(lines) if "SortMergeJoin" in line)
        col = lines[i].index("+-") + 3  # children's tree markers start here
        left = []
        for line in lines[i + 1 :]:
            if line[col : col + 2] == "+-":
                break
            left.append(line)
        # the row side reaches the join through the window's own exchange only:
        # the rows are shuffled once; the small carry side is shuffled to meet them
        assert sum("Exchange hashpartitioning(_scan_kc" in line for line in left) == 1, final
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_latest_by_time_without_tiebreak_is_a_hash_aggregate(spark):
    from pricerisk.operators.bars import daily_bars

    t = fx.event_ticks(spark, SF_SMALL)
    plan = _plan(daily_bars(t, tiebreak=None))
    assert "SortAggregate" not in plan and "HashAggregate" in plan
    plan = _plan(tk.price_stats(t, ["batch", "symbol"], tiebreak=None))
    assert "SortAggregate" not in plan
