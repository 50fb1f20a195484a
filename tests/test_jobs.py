"""End-to-end jobs over raw files as pandas writes them (INT64 TIMESTAMP(NANOS) dates)."""

import ast
import os

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq

from pricerisk.operators import returns as ret
from pricerisk.operators import risk
from pricerisk.plans.jobs import batch_job
from pricerisk.sources import fixtures as fx
from tests.conftest import SF_SMALL


def _land_like_pandas(spark, root):
    """Write event bars as the ingest service does: one file per run under dt=<run date>."""
    bars = fx.event_bars(spark, SF_SMALL).toPandas()
    bars["date"] = pd.to_datetime(bars["date"])  # datetime64[ns] -> INT64 TIMESTAMP(NANOS)
    runs = {"2024-01-15": bars[bars["date"] < "2024-01-15"], "2024-01-31": bars[bars["date"] >= "2024-01-15"]}
    for dt_, part in runs.items():
        d = os.path.join(root, f"dt={dt_}")
        os.makedirs(d, exist_ok=True)
        table = pa.Table.from_pandas(part.reset_index(drop=True), preserve_index=False)
        assert str(table.schema.field("date").type) == "timestamp[ns]"
        pq.write_table(table, os.path.join(d, "stock_prices.parquet"))
    return bars


def test_batch_job_from_nanosecond_raw_files(spark, tmp_dir):
    root = os.path.join(tmp_dir, "stock_prices")
    _land_like_pandas(spark, root)
    m = batch_job(spark, root, base=os.path.join(tmp_dir, "tables"))
    expected_core = ret.daily_returns(fx.event_bars(spark, SF_SMALL))
    cols = ["date", "symbol", "close", "prev_close", "daily_return"]
    assert sorted(m.core.select(*cols).collect()) == sorted(expected_core.select(*cols).collect())
    assert sorted(m.risk_metrics.collect()) == sorted(risk.risk_metrics(expected_core).collect())
    assert spark.table("staging_stg_stock_prices").count() == expected_core.count()


def test_batch_job_prunes_runs(spark, tmp_dir):
    root = os.path.join(tmp_dir, "stock_prices")
    bars = _land_like_pandas(spark, root)
    m = batch_job(spark, root, base=os.path.join(tmp_dir, "tables"), dt_from="2024-01-31")
    assert m.core.count() == int((bars["date"] >= "2024-01-15").sum())


def test_batch_cli(spark, tmp_dir, capsys):
    from pricerisk.plans.jobs import main

    root = os.path.join(tmp_dir, "stock_prices")
    _land_like_pandas(spark, root)
    out = os.path.join(tmp_dir, "tables")
    main(["batch", "--raw", root, "--out", out, "--dedup"])
    assert "annual_volatility_pct" in capsys.readouterr().out
    assert os.path.isdir(os.path.join(out, "marts", "mart_correlation"))


def test_ingest_job_to_marts(spark, tmp_dir, capsys):
    """Requests as lines of text -> raw layer -> marts, on the command line; a run again replaces itself."""
    from pricerisk.plans.jobs import main

    requests, root = os.path.join(tmp_dir, "requests"), os.path.join(tmp_dir, "root")
    fx.faulty_requests(spark, SF_SMALL).select("body").write.text(requests)
    for _ in range(2):
        main(["ingest", "--requests", requests, "--root", root, "--run", "r1"])
    said = [x for x in capsys.readouterr().out.splitlines() if "rows" in x]
    assert len(said) == 2 and said[0] == said[1]
    n = ast.literal_eval(said[0])
    raw = spark.read.parquet(os.path.join(root, "stock_prices"))
    assert raw.count() == n["rows"] > 500 and spark.read.parquet(os.path.join(root, "rejects")).count() == n["rejects"] > 1
    m = batch_job(spark, os.path.join(root, "stock_prices"), base=os.path.join(tmp_dir, "tables"))
    assert m.risk_metrics.count() == 8


def test_history_job_lands_the_window_of_the_universe(spark, tmp_dir):
    from pricerisk.plans.jobs import main
    from pricerisk.sources.prices import read_raw_prices

    bars, root, names = (os.path.join(tmp_dir, n) for n in ("bars", "root", "universe.json"))
    fx.vendor_frame(spark, SF_SMALL).write.parquet(bars)
    with open(names, "w") as f:
        f.write('{"symbol": "S2", "name": "two"}\n{"symbol": "S4", "name": "four"}\n')
    main(["history", "--bars", bars, "--root", root, "--start", "2024-01-10", "--end", "2024-01-15", "--universe", names])
    raw = read_raw_prices(spark, os.path.join(root, "stock_prices"), keep_dt=True)
    assert {(r.symbol, str(r.dt)) for r in raw.collect()} == {("S2", "2024-01-15"), ("S4", "2024-01-15")}
    m = batch_job(spark, os.path.join(root, "stock_prices"), base=os.path.join(tmp_dir, "tables"))
    days = sorted({str(r.date) for r in m.core.collect()})
    assert days[0] >= "2024-01-10" and days[-1] <= "2024-01-14"


def test_stream_commands(spark, tmp_dir):
    from pricerisk.plans.jobs import main

    ticks = os.path.join(tmp_dir, "ticks")
    fx.event_ticks(spark, SF_SMALL).select("symbol", "price", "timestamp").coalesce(1).write.json(ticks)
    for kind in ("tick-change", "windowed-alerts", "alerts"):
        sink = os.path.join(tmp_dir, kind)
        more = ["--window", "6 hours"] if kind == "windowed-alerts" else ["--trigger", "2 seconds"]
        main([kind, "--format", "json", "--path", ticks, "--sink", sink, "--checkpoint", sink + "-ck", "--available-now", *more])
        assert spark.read.parquet(sink).count() > 0
    assert spark.read.parquet(os.path.join(tmp_dir, "tick-change")).count() == fx.event_ticks(spark, SF_SMALL).count()
