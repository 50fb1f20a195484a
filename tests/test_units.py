"""Hand-computed cases for each operator, plus mirrors of the reference's own tests."""

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from pricerisk.functions.expressions import epoch_ns_to_date
from pricerisk.operators import alerts as al
from pricerisk.operators import correlation as corr
from pricerisk.operators import portfolio as pf
from pricerisk.operators import returns as ret
from pricerisk.operators import risk
from pricerisk.operators import ticks as tk
from pricerisk.operators.dedup import dedup_prices
from pricerisk.sinks import writers as sk
from pricerisk.sources import prices as src

D = dt.date


def bars(spark, rows):
    return spark.createDataFrame(
        [(D(2024, 1, d), s, c, c, c, c, v) for s, d, c, v in rows],
        "date date, symbol string, open double, high double, low double, close double, volume long",
    )


def core(spark, rows):
    return spark.createDataFrame(
        [(D(2024, 1, t[1]), t[0], float(t[2]), t[3], t[4] if len(t) > 4 else 1) for t in rows],
        "date date, symbol string, close double, daily_return double, volume long",
    )


def test_daily_returns_lag_round_and_zero_prev(spark):
    b = bars(spark, [("A", 1, 100.0, 1), ("A", 2, 110.0, 1), ("A", 3, 0.0, 1), ("A", 4, 50.0, 1), ("B", 2, 3.0, 1)])
    got = {(r.symbol, r.date.day): (r.prev_close, r.daily_return) for r in ret.daily_returns(b).collect()}
    assert got[("A", 1)] == (None, None)
    assert got[("A", 2)] == (100.0, 0.1)
    assert got[("A", 3)] == (110.0, -1.0)
    assert got[("A", 4)] == (0.0, None)  # nullif(prev, 0)
    assert got[("B", 2)] == (None, None)


def test_return_rounded_to_six_places(spark):
    b = bars(spark, [("A", 1, 3.0, 1), ("A", 2, 4.0, 1)])
    r = ret.daily_returns(b).filter("daily_return is not null").first()
    assert r.daily_return == 0.333333


def test_drawdown_excludes_first_day(spark):
    # the first day's close (20) must not enter the running peak
    b = bars(spark, [("A", 1, 20.0, 1), ("A", 2, 12.0, 1), ("A", 3, 6.0, 1), ("A", 4, 15.0, 1)])
    c = ret.daily_returns(b)
    dd = {r.date.day: (r.rolling_max, r.drawdown) for r in ret.drawdown_series(c).collect()}
    assert dd == {2: (12.0, 0.0), 3: (12.0, 0.5), 4: (15.0, 0.0)}
    assert risk.max_drawdown(c).first().max_drawdown_pct == 50.0


def test_risk_metrics_single_return_and_constant(spark):
    c = core(spark, [("A", 1, 10.0, None), ("A", 2, 11.0, 0.1), ("B", 1, 5, 0.01), ("B", 2, 5, 0.01), ("B", 3, 5, 0.01)])
    m = {r.symbol: r for r in risk.risk_metrics(c).collect()}
    assert m["A"].trading_days == 1
    assert m["A"].daily_volatility_pct is None and m["A"].sharpe_ratio is None
    assert m["A"].var_95_pct == 10.0
    assert m["B"].daily_volatility_pct == 0.0 and m["B"].sharpe_ratio is None  # nullif(std, 0)


def test_var_is_interpolated_percentile(spark):
    c = core(spark, [("A", d, 1.0, x) for d, x in [(1, 0.01), (2, 0.02), (3, 0.04), (4, 0.08)]])
    assert risk.value_at_risk(c).first().var_95_pct == 1.15
    w = risk.var_95_window(c).collect()
    assert len(w) == 4 and {round(r.var_95, 6) for r in w} == {0.0115}


def test_portfolio_drops_symbol_missing_on_latest_date(spark):
    c = core(spark, [("A", 1, 1.0, None, 1), ("A", 2, 2.0, 0.5, 1), ("A", 3, 3.0, 0.5, 2), ("B", 1, 5.0, None, 1), ("B", 2, 6.0, 0.2, 1)])
    rows = pf.portfolio_summary(c).collect()
    assert [r.symbol for r in rows] == ["A"]
    r = rows[0]
    assert (r.trading_days, r.avg_close, r.min_close, r.max_close, r.avg_volume) == (2, 2.5, 2.0, 3.0, 1)
    assert (r.latest_close, r.latest_date) == (3.0, D(2024, 1, 3))
    per = {x.symbol: x.latest_date.day for x in pf.latest_price_per_symbol(c).collect()}
    assert per == {"A": 3, "B": 2}


def test_base_prices_fallback(spark):
    b = bars(spark, [("A", 1, 10.0, 1), ("A", 20, 12.0, 1), ("B", 1, 3.0, 1)])
    u = src.universe(spark, ["A", "B", "C"])
    got = {r.symbol: (r.base_price, r.is_fallback) for r in pf.base_prices(b, u).collect()}
    assert got == {"A": (12.0, False), "B": (100.0, True), "C": (100.0, True)}


def _pairs_reference(c):
    r = ret.clean_returns(c).select("symbol", "date", F.col("daily_return").alias("x"))
    a, b = r.alias("a"), r.alias("b")
    p = a.join(b, (F.col("a.date") == F.col("b.date")) & (F.col("a.symbol") < F.col("b.symbol"))).select(
        F.col("a.symbol").alias("symbol_1"), F.col("b.symbol").alias("symbol_2"), F.col("a.x").alias("x"), F.col("b.x").alias("y")
    )
    g = p.groupBy("symbol_1", "symbol_2").agg(
        F.count(F.lit(1)).alias("n"), F.sum("x").alias("sx"), F.sum("y").alias("sy"),
        F.sum(F.col("x") * F.col("y")).alias("sxy"), F.sum(F.col("x") * F.col("x")).alias("sx2"),
        F.sum(F.col("y") * F.col("y")).alias("sy2"),
    )
    from pricerisk.functions.expressions import pearson

    return {(r.symbol_1, r.symbol_2): r.c for r in g.select("symbol_1", "symbol_2", pearson("n", "sx", "sy", "sxy", "sx2", "sy2").alias("c")).collect()}


def test_correlation_signs_and_zero_variance(spark):
    xs = [0.01, -0.02, 0.03, 0.00, 0.05]
    rows = []
    for d, x in enumerate(xs, start=1):
        rows += [("A", d, 1.0, x, 1), ("B", d, 1.0, 2 * x + 0.001, 1), ("C", d, 1.0, -x, 1), ("Z", d, 1.0, 0.01, 1)]
    c = core(spark, rows)
    got = {(r.symbol_1, r.symbol_2): r.correlation for r in corr.correlation_matrix(c).collect()}
    assert len(got) == 6
    assert got[("A", "B")] == 1.0 and got[("A", "C")] == -1.0
    assert got[("A", "Z")] is None  # zero variance -> NULL, not an error
    assert all(v is None or -1.0 <= v <= 1.0 for v in got.values())


def test_correlation_blocks_and_tiles_match_self_join(spark):
    import random

    rnd = random.Random(3)
    rows = [(s, d, 1.0, round(rnd.uniform(-0.1, 0.1), 6), 1) for s in "ABCDEFG" for d in range(1, 29) if rnd.random() < 0.8]
    c = core(spark, rows)
    exp = _pairs_reference(c)
    for block_days, tile in [(1024, 256), (3, 2), (1, 1)]:
        got = {(r.symbol_1, r.symbol_2): r.correlation for r in corr.correlation_matrix(c, block_days=block_days, tile_size=tile).collect()}
        assert got == exp, (block_days, tile)


def _random_returns(spark, symbols, days, seed):
    import random

    rnd = random.Random(seed)
    return core(spark, [(s, d, 1.0, round(rnd.uniform(-0.1, 0.1), 6), 1) for s in symbols for d in range(1, days + 1) if rnd.random() < 0.8])


def test_correlation_groups_are_bounded(spark):
    names = [f"T{k:02d}" for k in range(23)]
    c = _random_returns(spark, [*names, None], 28, 4)
    for block_days, tile in [(7, 5), (3, 4), (28, 1)]:
        rows = corr.tiled_returns(c, block_days=block_days, tile_size=tile)
        sizes = rows.groupBy("block", "tile_a", "tile_b").count().agg(F.max("count")).first()[0]
        assert sizes <= block_days * 2 * tile
        numbers = sorted(r.number for r in rows.select("symbol", "number").distinct().collect())
        assert numbers == list(range(23))
        per_tile = rows.select("tile", "symbol").distinct().groupBy("tile").count().collect()
        assert all(r["count"] <= tile for r in per_tile)


def test_only_asked_pairs_are_made(spark):
    names = [f"T{k:02d}" for k in range(12)]
    c = _random_returns(spark, [*names, None], 20, 6)
    wanted = [("T03", "T01"), ("T01", "T03"), ("T04", "T11"), ("T05", "T05"), ("T02", None), (None, "T02"), ("T09", "nobody"), ("T10", "T11")]
    pairs = spark.createDataFrame(wanted, "symbol_1 string, symbol_2 string")
    full = {(r.symbol_1, r.symbol_2): r.correlation for r in corr.correlation_matrix(c).collect()}
    exp = {p: full[p] for p in [("T01", "T03"), ("T04", "T11"), ("T10", "T11")]}
    for tile in (1, 3, 256):
        got = corr.correlation_matrix(c, pairs=pairs, tile_size=tile).collect()
        assert len(got) == 3 and {(r.symbol_1, r.symbol_2): r.correlation for r in got} == exp
    tiles = corr.tiled_returns(c, pairs=pairs, tile_size=2).select("tile_a", "tile_b").distinct().collect()
    assert len(tiles) <= 4  # of the 21 tile pairs of 6 tiles
    every = corr.return_pairs(c).filter(F.concat("symbol_1", "symbol_2").isin("T01T03", "T04T11", "T10T11"))
    key = lambda r: tuple(r)
    assert sorted(corr.return_pairs(c, pairs).collect(), key=key) == sorted(every.select(*corr.return_pairs(c).columns).collect(), key=key)


def test_return_pairs_counts_duplicate_combinations(spark):
    c = core(spark, [("A", 1, 1.0, 0.1, 1), ("A", 1, 1.0, 0.1, 1), ("B", 1, 1.0, 0.2, 1), ("C", 2, 1.0, 0.3, 1)])
    rows = corr.return_pairs(c).collect()
    assert [(r.symbol_1, r.symbol_2, r.x, r.y, r.n_pairs) for r in rows] == [("A", "B", 0.1, 0.2, 2)]


def _ticks(spark, rows):
    return spark.createDataFrame(
        [(s, p, dt.datetime(2024, 1, 1, 0, 0, i), i, b) for i, (s, p, b) in enumerate(rows)],
        "symbol string, price double, timestamp timestamp, event_id long, batch long",
    )


def test_alert_thresholds_are_strict(spark):
    t = _ticks(spark, [("A", 100.0, 0), ("A", 97.0, 0), ("B", 100.0, 0), ("B", 96.9, 0)])
    got = {(r.symbol, r.alert_type) for r in al.batch_alerts(t, rules=[al.PRICE_DROP]).collect()}
    assert got == {("B", al.PRICE_DROP)}  # A's drop is exactly 0.03 -> no alert


def test_single_tick_gives_no_alert(spark):
    t = _ticks(spark, [("A", 10.0, 0)])
    assert al.batch_alerts(t).count() == 0


def test_alerts_volatility_and_anomaly(spark):
    prices = [10.0] * 20 + [20.0]
    t = _ticks(spark, [("A", p, 0) for p in prices])
    got = {r.alert_type: r for r in al.batch_alerts(t).collect()}
    assert set(got) == {al.HIGH_VOLATILITY, al.PRICE_ANOMALY}
    assert got[al.PRICE_ANOMALY].price_at_alert == 20.0
    assert len({r.alert_id for r in got.values()}) == 2
    again = {r.alert_id for r in al.batch_alerts(t).collect()}
    assert again == {r.alert_id for r in got.values()}  # ids are reproducible


def test_parse_ticks_drops_malformed(spark):
    raw = spark.createDataFrame(
        [('{"symbol":"A","price":1.5,"timestamp":"2024-01-01T00:00:01.5+00:00"}',), ("not json",), ('{"price":2}',)],
        "body string",
    )
    rows = tk.parse_ticks(raw).collect()
    assert len(rows) == 1 and rows[0].symbol == "A" and rows[0].timestamp == dt.datetime(2024, 1, 1, 0, 0, 1, 500000)


def test_tick_change_zero_prev_and_base(spark):
    t = _ticks(spark, [("A", 0.0, 0), ("A", 5.0, 0), ("A", 4.0, 0)])
    got = [(r.prev_price, r.change_pct, r.direction) for r in tk.tick_change(t).orderBy("event_id").collect()]
    assert got == [(None, 0.0, "-"), (0.0, 0.0, "↑"), (5.0, -20.0, "↓")]
    base = spark.createDataFrame([("A", 2.0)], "symbol string, base_price double")
    first = tk.tick_change(t, base=base).orderBy("event_id").first()
    assert (first.prev_price, first.change_pct) == (2.0, -100.0)


def test_epoch_ns_to_date(spark):
    df = spark.createDataFrame([(1704067207179575000,), (86_399_999_999_999,)], "n long")
    assert [r.d for r in df.select(epoch_ns_to_date("n").alias("d")).collect()] == [D(2024, 1, 1), D(1970, 1, 1)]


def test_dedup_keeps_latest_ingest(spark):
    df = spark.createDataFrame(
        [("A", D(2024, 1, 1), 1.0, "t1"), ("A", D(2024, 1, 1), 2.0, "t2"), ("B", D(2024, 1, 1), 3.0, "t1")],
        "symbol string, date date, close double, ingested_at string",
    )
    assert sorted((r.symbol, r.close) for r in dedup_prices(df).collect()) == [("A", 2.0), ("B", 3.0)]


def test_union_sources_skips_empty_and_raises_when_all_empty(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([], "id int, b string")
    c = spark.createDataFrame([(2, 1.5)], "id int, c double")
    u = src.union_sources([a, b, c])
    assert u.columns == ["id", "a", "c"] and u.count() == 2
    with pytest.raises(ValueError):
        src.union_sources([b])


def test_ingest_counts_rollup(spark):
    df = spark.createDataFrame([("A",), ("A",), ("B",)], "symbol string")
    assert {r.symbol: r.row_count for r in sk.ingest_counts(df).collect()} == {"A": 2, "B": 1, None: 3}


def test_load_history_window_end_exclusive(spark):
    b = bars(spark, [("A", 1, 1.0, 1), ("A", 2, 1.0, 1), ("A", 3, 1.0, 1), ("X", 2, 1.0, 1)])
    u = src.universe(spark, ["A"])
    got = src.load_history(b, u, "2024-01-01", "2024-01-03").collect()
    assert sorted((r.symbol, r.date.day) for r in got) == [("A", 1), ("A", 2)]


def test_records_to_prices_string_and_array(spark):
    js = '[{"date":"2024-01-02T00:00:00+00:00","symbol":"A","open":1.0,"close":2.0,"volume":3}]'
    df = spark.createDataFrame([(js,)], "payload string")
    r = src.records_to_prices(df).first()
    assert (r.symbol, r.close, r.volume, r.date) == ("A", 2.0, 3, dt.datetime(2024, 1, 2))
    parsed = df.select(F.from_json("payload", "array<struct<symbol:string,close:double>>").alias("payload"))
    assert src.records_to_prices(parsed).first().close == 2.0


# --- mirrors of the reference's tests ---------------------------------------


def test_universe_returns_symbols_in_order(spark):
    u = src.universe(spark, [{"symbol": "QQ1.L", "name": "First plc"}, {"symbol": "QQ2.L", "name": "Second plc"}])
    assert [r.symbol for r in u.orderBy("position").collect()] == ["QQ1.L", "QQ2.L"]


def test_normalize_adds_symbol_and_lowercases_columns(spark):
    df = spark.createDataFrame([(41.5, 43.25)], "Open double, Close double")
    out = src.normalize_columns(df, symbol="QQ1.L")
    assert {"symbol", "open", "close", "ingested_at"} <= set(out.columns)
    assert out.first().symbol == "QQ1.L"
    two_level = spark.createDataFrame([(1.0,)], "`('Close', 'QQ1.L')` double")
    assert src.normalize_columns(two_level).columns[0] == "close"


def test_write_raw_builds_dated_path_and_replaces_rerun(spark, tmp_dir):
    df = spark.createDataFrame([("QQ1.L", 100.0)], "symbol string, close double")
    path = sk.write_raw(df, tmp_dir, "2025-03-10")
    assert path.endswith("stock_prices/dt=2025-03-10")
    assert any(f.endswith(".parquet") for f in os.listdir(path))
    sk.write_raw(df, tmp_dir, "2025-03-11")
    sk.write_raw(df, tmp_dir, "2025-03-10")  # re-run replaces, does not append
    back = spark.read.parquet(f"{tmp_dir}/stock_prices")
    assert back.count() == 2


def test_load_history_defaults_to_last_365_days(spark):
    today = dt.datetime.now(dt.timezone.utc).date()
    days = [today - dt.timedelta(days=k) for k in (0, 1, 365, 366)]
    df = spark.createDataFrame([(d, "A", 1.0) for d in days], "date date, symbol string, close double")
    got = sorted(r.date for r in src.load_history(df, None).collect())
    assert got == sorted([today - dt.timedelta(days=1), today - dt.timedelta(days=365)])


def test_raw_scan_prunes_dt_folders(spark, tmp_dir):
    df = spark.createDataFrame(
        [(1704067207179575000, "A", 1.0, 1.0, 1.0, 1.0, 1, "t")],
        "date long, symbol string, open double, high double, low double, close double, volume long, ingested_at string",
    )
    for dt_ in ("2024-01-01", "2024-01-02", "2024-01-03"):
        sk.write_raw(df, tmp_dir, dt_)
    root = f"{tmp_dir}/{sk.RAW_PREFIX}"
    assert src.read_raw_prices(spark, root).count() == 3
    assert "dt" not in src.read_raw_prices(spark, root).columns
    pruned = src.read_raw_prices(spark, root, dt_from="2024-01-02", dt_to="2024-01-02")
    assert pruned.count() == 1
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan
    staged = src.stage_prices(pruned).first()
    assert staged.date == D(2024, 1, 1)


def test_scale_conf_sizes_partitions():
    from pricerisk.session import TARGET_PARTITION_BYTES, scale_conf

    c = scale_conf(100 * 1024**4, total_cores=8000)  # 100 TiB on 8000 cores
    assert int(c["spark.sql.shuffle.partitions"]) == 100 * 1024**4 // TARGET_PARTITION_BYTES
    assert scale_conf(1, total_cores=8)["spark.sql.shuffle.partitions"] == "16"


def test_null_close_breaks_the_return_chain(spark):
    b = spark.createDataFrame(
        [(D(2024, 1, d), "A", c) for d, c in [(1, 10.0), (2, None), (3, 12.0), (4, 6.0)]],
        "date date, symbol string, close double",
    ).selectExpr("date", "symbol", "close as open", "close as high", "close as low", "close", "1L as volume")
    got = {r.date.day: (r.prev_close, r.daily_return) for r in ret.daily_returns(b).collect()}
    assert got == {1: (None, None), 2: (10.0, None), 3: (None, None), 4: (12.0, -0.5)}
    # only day 4 has a return, so it is the only trading day of the marts
    assert risk.risk_metrics(ret.daily_returns(b)).first().trading_days == 1


def test_upload_requests_land_by_run_date(spark, tmp_dir):
    bodies = spark.createDataFrame(
        [
            ('{"data":[{"date":"2024-01-02T00:00:00+00:00","symbol":"A","close":1.0}],"date":"2024-01-03"}',),
            ('{"data":"[{\\"date\\":\\"2024-01-04T00:00:00+00:00\\",\\"symbol\\":\\"B\\",\\"close\\":2.0}]","date":"2024-01-05"}',),
            ('{"date":"2024-01-06"}',),
        ],
        "body string",
    )
    rows = src.upload_requests_to_prices(bodies)
    assert sorted((r.symbol, r.close, str(r.dt)) for r in rows.collect()) == [("A", 1.0, "2024-01-03"), ("B", 2.0, "2024-01-05")]
    sk.write_raw(rows.withColumn("date", F.unix_micros("date") * 1000), tmp_dir)
    landed = sorted(d for d in os.listdir(f"{tmp_dir}/{sk.RAW_PREFIX}") if d.startswith("dt="))
    assert landed == ["dt=2024-01-03", "dt=2024-01-05"]


def test_keyed_message_body(spark):
    import json

    t = _ticks(spark, [("A", 101.5, 0), ("A", 0.00005, 0)]).withColumn("volume", F.lit(7).cast("long"))
    msgs = sk.to_keyed_messages(tk.tick_change(t)).collect()
    bodies = sorted((json.loads(m.value) for m in msgs), key=lambda b: b["timestamp"])
    assert all(m.key == "A" for m in msgs)
    first, second = bodies
    assert list(first) == ["symbol", "price", "prev_price", "change_pct", "volume", "timestamp", "source"]
    assert first["prev_price"] is None and first["change_pct"] == 0.0 and first["source"] == "simulated"
    assert first["timestamp"] == "2024-01-01T00:00:00.000000+00:00"
    assert '"price":0.0001' in [m.value for m in msgs if "0.0001" in m.value][0]  # plain decimal text, 4 dp
    assert second["prev_price"] == 101.5


def test_normalize_default_ingest_time_is_iso_utc(spark):
    out = src.normalize_columns(spark.createDataFrame([(1.0,)], "Close double"), symbol="X").first()
    assert re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}\+00:00", out.ingested_at)


def test_universe_from_yaml_config_in_order(spark, tmp_dir):
    # mirror of the reference test: a temporary YAML with two tickers
    path = os.path.join(tmp_dir, "tickers.yaml")
    with open(path, "w") as f:
        f.write("tickers:\n    - symbol: QQ1.L\n      name: First plc\n    - symbol: QQ2.L\n      name: Second plc\n")
    u = src.universe(spark, path)
    assert [r.symbol for r in u.orderBy("position").collect()] == ["QQ1.L", "QQ2.L"]
    assert src.universe(spark).count() == 8


def test_outputs_follow_the_declared_schemas(spark):
    import json

    from pricerisk.schemas import ALERT, PRICE_BAR, TICK_MESSAGE

    raw = spark.createDataFrame(
        [(1704067207179575000, "A", 1.0, 2.0, 0.5, 1.5, 10, "t")],
        "date long, symbol string, open double, high double, low double, close double, volume long, ingested_at string",
    )
    staged = src.stage_prices(raw)
    assert [(f.name, f.dataType) for f in staged.schema] == [(f.name, f.dataType) for f in PRICE_BAR]

    t = _ticks(spark, [("A", 10.0, 0), ("A", 11.0, 0)]).withColumn("volume", F.lit(3).cast("long"))
    msgs = sk.to_keyed_messages(tk.tick_change(t))
    back = msgs.select(F.from_json("value", TICK_MESSAGE).alias("m")).select("m.*").orderBy("timestamp").collect()
    assert [(r.price, r.prev_price, r.change_pct, r.source) for r in back] == [(10.0, None, 0.0, "simulated"), (11.0, 10.0, 10.0, "simulated")]
    assert back[1].timestamp == dt.datetime(2024, 1, 1, 0, 0, 1)
    assert set(json.loads(msgs.first().value)) == {f.name for f in TICK_MESSAGE}

    a = al.batch_alerts(_ticks(spark, [("A", p, 0) for p in [10.0] * 20 + [20.0]]))
    assert set(ALERT.fieldNames()) <= set(a.columns)
    assert {c: str(t_) for c, t_ in a.dtypes if c in ALERT.fieldNames()} == {f.name: f.dataType.simpleString() for f in ALERT}


def test_unparsed_payloads_are_not_lost(spark):
    good = '[{"symbol":"A","close":1.0},{"symbol":"B","close":2.0}]'
    cut = good[:-20]
    df = spark.createDataFrame([(good,), (cut,), (None,), ("",), ("[]",)], "payload string")
    with pytest.raises(Exception, match="does not parse"):
        src.records_to_prices(df).collect()
    assert [r.symbol for r in src.records_to_prices(df, strict=False).collect()] == ["A", "B"]
    rejected = src.rejected_payloads(df)
    want = [(None, "no payload"), ("", "payload does not parse"), (cut, "payload does not parse")]
    assert sorted(((r.raw, r.reason) for r in rejected.collect()), key=str) == sorted(want, key=str)
    assert {r.reason: r.n for r in src.reject_counts(rejected).collect()} == {"no payload": 1, "payload does not parse": 2}


def test_unread_upload_requests_are_not_lost(spark):
    fine = '{"data":[{"symbol":"A","close":1.0}],"date":"2024-01-03"}'
    bad = {
        fine[:-5]: "body does not parse",
        '{"date":"2024-01-06","data":[{"symbol":"A"': "body does not parse",
        '{"data":"[{\\"symbol\\":","date":"2024-01-03"}': "data does not parse",
        '{"data":[{"symbol":"A"}],"date":"soon"}': "date does not parse",
        '{"date":"2024-01-06"}': "missing data or date",
        '{"data":[{"symbol":"A"}],"date":""}': "missing data or date",
    }
    df = spark.createDataFrame([(x,) for x in [fine, *bad]], "body string")
    assert {r.raw: r.reason for r in src.rejected_requests(df).collect()} == bad
    assert [r.symbol for r in src.upload_requests_to_prices(df, strict=False).collect()] == ["A"]
    for x, reason in bad.items():
        one = src.upload_requests_to_prices(spark.createDataFrame([(x,)], "body string"))
        if reason == "missing data or date":
            assert one.collect() == []
        else:
            with pytest.raises(Exception, match=reason):
                one.collect()
