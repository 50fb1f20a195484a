"""Runnable jobs: ingest into the raw layer, the batch build, and the streams.

``python -m pricerisk.plans.jobs ingest --requests <path> --root <root> --run <id>``
``python -m pricerisk.plans.jobs history --bars <path> --root <root> [--start D] [--end D] [--universe <file>]``
``python -m pricerisk.plans.jobs batch --raw <root> [--out <base>] [--dt-from D] [--dt-to D] [--dedup]``
``python -m pricerisk.plans.jobs alerts|windowed-alerts|tick-change --format json --path <dir> --sink <dir>``
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pricerisk.functions.expressions import utc_today
from pricerisk.operators.dedup import dedup_prices
from pricerisk.plans.marts import Marts, build_marts
from pricerisk.schemas import TICK
from pricerisk.sinks.writers import land_run, register_view, write_raw
from pricerisk.sources.prices import (
    ingest_requests,
    load_history,
    normalize_columns,
    read_raw_prices,
    stage_prices,
    to_raw,
    universe,
)
from pricerisk.streaming.alerts_stream import (
    DEFAULT_TRIGGER,
    parsed_ticks,
    read_tick_stream,
    start_alert_stream,
    start_windowed_alert_stream,
)
from pricerisk.streaming.tick_state import start_tick_change_stream

STREAMS = ("alerts", "windowed-alerts", "tick-change")
FILE_FORMATS = ("json", "csv", "text", "parquet", "orc")


def ingest_job(spark: SparkSession, requests: str, root: str, run: str) -> dict[str, int]:
    """Upload requests (text files, one JSON body a line) -> raw layer by run date, with the rejects of the run.

    Running it again under the same ``run`` replaces what that run landed.
    Returns the numbers of rows and rejects.
    """
    bodies = spark.read.text(requests).withColumnRenamed("value", "body").where("trim(body) <> ''")
    rows, rejects = ingest_requests(bodies)
    return land_run(rows, rejects, root, run)


def history_job(
    spark: SparkSession,
    vendor: DataFrame,
    root: str,
    *,
    tickers: DataFrame | None = None,
    start: str | None = None,
    end: str | None = None,
) -> str:
    """Vendor bars -> normalised columns -> the universe's window -> ``dt=<end>`` of the raw layer; returns that folder.

    ``vendor`` has the vendor's headers (any case, two levels); its ticker is
    in ``symbol`` or ``ticker``. ``end`` is exclusive and defaults to today (UTC).
    """
    bars = normalize_columns(vendor)
    if "symbol" not in bars.columns:
        bars = bars.withColumnRenamed("ticker", "symbol")
    day = end or str(spark.range(1).select(utc_today().cast("string").alias("d")).first()["d"])
    window = load_history(bars.withColumn("date", F.col("date").cast("date")), tickers, start, day)
    return write_raw(to_raw(window), root, day)


def batch_job(
    spark: SparkSession,
    raw_root: str,
    *,
    base: str | None = None,
    dt_from: str | None = None,
    dt_to: str | None = None,
    dedup: bool = False,
) -> Marts:
    """Raw landed bars -> staging view -> core table -> three marts.

    ``dt_from``/``dt_to`` prune landing folders. ``dedup`` keeps only the
    latest ingest of each (symbol, date); without it every landed copy is
    used, as the staging view does.
    """
    staged = stage_prices(read_raw_prices(spark, raw_root, dt_from=dt_from, dt_to=dt_to))
    if dedup:
        staged = dedup_prices(staged)
    register_view(staged, "staging_stg_stock_prices")
    return build_marts(staged, base=base)


def alert_job(
    spark: SparkSession,
    fmt: str,
    sink: str,
    *,
    path: str | None = None,
    options: dict | None = None,
    body_col: str | None = None,
    checkpoint: str | None = None,
    trigger: str = "10 seconds",
    available_now: bool = False,
    kind: str = "alerts",
    window: str = DEFAULT_TRIGGER,
) -> StreamingQuery:
    """Start the per-micro-batch alert stream, or with ``kind`` another of the tick streams.

    ``kind`` is ``alerts``, ``windowed-alerts`` (event-time windows of ``window``) or
    ``tick-change`` (previous price and change of every tick). With ``body_col`` the source delivers raw message bodies (a broker) that
    are parsed as JSON ticks; without it the source already has tick columns
    (e.g. JSON files read with the tick schema).
    """
    if body_col:
        # streaming file sources need a declared schema; broker sources bring their own
        schema = f"`{body_col}` string" if fmt in FILE_FORMATS else None
        ticks = parsed_ticks(read_tick_stream(spark, fmt, path, options=options, schema=schema), body_col)
    else:
        ticks = read_tick_stream(spark, fmt, path, options=options, schema=TICK)
    start = {"alerts": start_alert_stream, "windowed-alerts": start_windowed_alert_stream, "tick-change": start_tick_change_stream}
    more = {"window": window} if kind == "windowed-alerts" else {}
    return start[kind](ticks, sink, checkpoint=checkpoint, trigger=trigger, available_now=available_now, **more)


def main(argv: list[str] | None = None) -> None:
    from pricerisk.session import get_session

    ap = argparse.ArgumentParser(prog="pricerisk.plans.jobs")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("batch")
    b.add_argument("--raw", required=True)
    b.add_argument("--out")
    b.add_argument("--dt-from")
    b.add_argument("--dt-to")
    b.add_argument("--dedup", action="store_true")
    i = sub.add_parser("ingest")
    i.add_argument("--requests", required=True)
    i.add_argument("--root", required=True)
    i.add_argument("--run", required=True)
    h = sub.add_parser("history")
    h.add_argument("--bars", required=True, help="Parquet of vendor bars")
    h.add_argument("--root", required=True)
    h.add_argument("--start")
    h.add_argument("--end")
    h.add_argument("--universe", help="YAML or JSON-lines ticker list")
    for kind in STREAMS:
        a = sub.add_parser(kind)
        a.add_argument("--format", required=True)
        a.add_argument("--path")
        a.add_argument("--sink", required=True)
        a.add_argument("--body-col")
        a.add_argument("--option", action="append", default=[], help="key=value source option")
        a.add_argument("--checkpoint")
        a.add_argument("--trigger", default=DEFAULT_TRIGGER, help="processing-time interval")
        a.add_argument("--available-now", action="store_true")
        if kind == "windowed-alerts":
            a.add_argument("--window", default=DEFAULT_TRIGGER, help="length of the event-time windows")
    args = ap.parse_args(argv)

    spark = get_session()
    if args.cmd == "batch":
        m = batch_job(spark, args.raw, base=args.out, dt_from=args.dt_from, dt_to=args.dt_to, dedup=args.dedup)
        m.risk_metrics.show(truncate=False)
    elif args.cmd == "ingest":
        print(ingest_job(spark, args.requests, args.root, args.run))
    elif args.cmd == "history":
        tickers = universe(spark, args.universe) if args.universe else None
        print(history_job(spark, spark.read.parquet(args.bars), args.root, tickers=tickers, start=args.start, end=args.end))
    else:
        opts = dict(o.split("=", 1) for o in args.option)
        q = alert_job(
            spark,
            args.format,
            args.sink,
            path=args.path,
            options=opts,
            body_col=args.body_col,
            checkpoint=args.checkpoint,
            trigger=args.trigger,
            kind=args.cmd,
            window=getattr(args, "window", DEFAULT_TRIGGER),
            available_now=args.available_now,
        )
        q.awaitTermination()


if __name__ == "__main__":
    main()
