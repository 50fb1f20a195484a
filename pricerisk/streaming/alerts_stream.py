"""Structured Streaming jobs for tick alerts (ST1-ST9, E3, E4).

* :func:`read_tick_stream` opens the source (S5); the broker connector is a
  parameter, file/rate/memory sources serve tests.
* :func:`start_alert_stream` runs the per-micro-batch rules: ``foreachBatch``
  applies the same :func:`pricerisk.operators.alerts.batch_alerts` used in
  batch, with the micro-batch id as the batch column, and writes the result
  idempotently under ``batch_id=<id>`` (a replayed batch overwrites its own
  output; alert ids are content hashes).
* :func:`start_windowed_alert_stream` evaluates the rules per event-time
  window with a watermark (E3), so results no longer depend on arrival
  batching.
* :func:`start_state_stats_stream` keeps running per-(group, symbol) price
  statistics as streaming state and writes the groups that a trigger touched
  (update mode); :func:`read_stats` gives the newest statistics of each, and
  :func:`alerts_from_stats` applies the rules to them. The result equals the
  batch rules over the same groups, however the input is split into
  micro-batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pricerisk.operators.alerts import ALL_RULES, alerts, windowed_alerts
from pricerisk.operators.ticks import parse_ticks, price_stats
from pricerisk.schemas import TICK
from pricerisk.session import scratch_path
from pricerisk.sinks.writers import MANUAL_RUN, write_alerts

# Fixed value: the reference triggers a micro-batch every 10 seconds.
DEFAULT_TRIGGER = "10 seconds"


def read_tick_stream(
    spark: SparkSession,
    fmt: str,
    path: str | None = None,
    *,
    options: dict | None = None,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """Open a streaming source (``kafka``, ``json``, ``parquet``, ``rate``, ...)."""
    r = spark.readStream.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    if options:
        r = r.options(**options)
    return r.load(path) if path else r.load()


def parsed_ticks(raw: DataFrame, body_col: str = "body", schema: T.StructType = TICK) -> DataFrame:
    """Bytes/JSON body -> (symbol, price, timestamp, ...); rows without symbol dropped."""
    return parse_ticks(raw, body_col, schema)


def query_run_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a streaming query keeps in its checkpoint: the same after a restart, another for a fresh one."""
    return spark.read.json(f"{checkpoint.rstrip('/')}/metadata").first()["id"]


def alert_batch(
    batch_df: DataFrame, batch_id: int, sink: str, *, rules=ALL_RULES, fmt: str = "parquet", run_id: str = MANUAL_RUN
) -> int:
    """Process one micro-batch: statistics per symbol, rules, idempotent write.

    ``run_id`` names the query's life: it is part of the alert ids and of the
    output path, so batches with equal numbers of other runs are not touched.
    The micro-batch is kept while it is processed, so its source is read once.

    Returns the number of alerts written (0 for an empty batch, which is
    skipped without a write).
    """
    batch_df = batch_df.persist()
    try:
        if batch_df.isEmpty():
            return 0
        b = batch_df.withColumn("run", F.lit(run_id)).withColumn("batch", F.lit(int(batch_id)).cast("long"))
        tiebreak = "event_id" if "event_id" in b.columns else None
        stats = price_stats(b, ["run", "batch", "symbol"], tiebreak=tiebreak)
        out = alerts(stats, ["run", "batch"], rules=rules).drop("run", "batch").persist()
        try:
            n = out.count()
            if n:
                write_alerts(out, batch_id, sink, fmt, run_id)
        finally:
            out.unpersist()
        return n
    finally:
        batch_df.unpersist()


def start_alert_stream(
    ticks: DataFrame,
    sink: str,
    *,
    checkpoint: str | None = None,
    trigger: str | None = DEFAULT_TRIGGER,
    available_now: bool = False,
    rules=ALL_RULES,
    fmt: str = "parquet",
    query_name: str | None = None,
) -> StreamingQuery:
    """Start the per-micro-batch alert stream and return the running query.

    Offsets are checkpointed at ``checkpoint`` (default: a folder under the
    shared checkpoint directory), so a restarted query resumes where it left
    off; a batch that is re-run overwrites its own alert partition.
    """
    spark = ticks.sparkSession
    ckpt = checkpoint or scratch_path(spark, "streams", "alerts")
    run: dict[str, str] = {}

    def process(batch_df: DataFrame, batch_id: int) -> None:
        if "id" not in run:
            run["id"] = query_run_id(batch_df.sparkSession, ckpt)
        alert_batch(batch_df, batch_id, sink, rules=rules, fmt=fmt, run_id=run["id"])

    w = ticks.writeStream.foreachBatch(process).option("checkpointLocation", ckpt)
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()


def start_windowed_alert_stream(
    ticks: DataFrame,
    sink: str,
    *,
    window: str = DEFAULT_TRIGGER,
    watermark: str = "10 seconds",
    checkpoint: str | None = None,
    trigger: str | None = DEFAULT_TRIGGER,
    available_now: bool = False,
    ts: str = "timestamp",
    fmt: str = "parquet",
) -> StreamingQuery:
    """Event-time windowed alerts: watermark + tumbling window + the same rules.

    Each window is emitted once, when the watermark passes its end (append
    mode); state for older windows is dropped.
    """
    spark = ticks.sparkSession
    ckpt = checkpoint or scratch_path(spark, "streams", "windowed_alerts")
    tiebreak = "event_id" if "event_id" in ticks.columns else None
    out = windowed_alerts(ticks.withWatermark(ts, watermark), window, ts=ts, tiebreak=tiebreak)
    w = out.writeStream.outputMode("append").format(fmt).option("checkpointLocation", ckpt).option("path", sink)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()


def start_state_stats_stream(
    ticks: DataFrame,
    table_path: str,
    group: tuple[str, ...] = ("batch",),
    *,
    checkpoint: str | None = None,
    trigger: str | None = DEFAULT_TRIGGER,
    available_now: bool = False,
) -> StreamingQuery:
    """Running statistics per ``(*group, symbol)`` as streaming state.

    Every aggregate is combined incrementally in the state store (one row per
    group and symbol). Each trigger writes the statistics of the groups and
    symbols that its input touched, and no others, so what is written follows
    the trigger and not the history. They go to
    ``table_path/run_id=<query id>/batch_id=<n>``; a replayed trigger replaces
    its own folder. :func:`read_stats` picks each group's newest row, and
    :func:`compact_stats` folds the folders into one.
    """
    spark = ticks.sparkSession
    ckpt = checkpoint or scratch_path(spark, "streams", "state_stats")
    tiebreak = "event_id" if "event_id" in ticks.columns else None
    stats = price_stats(ticks, [*group, "symbol"], tiebreak=tiebreak)
    run: dict[str, str] = {}

    def write(batch_df: DataFrame, batch_id: int) -> None:
        if "id" not in run:
            run["id"] = query_run_id(batch_df.sparkSession, ckpt)
        batch_df.write.mode("overwrite").parquet(f"{table_path.rstrip('/')}/run_id={run['id']}/batch_id={int(batch_id)}")

    w = stats.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()


def read_stats(
    spark: SparkSession, table_path: str, group: tuple[str, ...] = ("batch",), *, run_id: str | None = None
) -> DataFrame:
    """The newest statistics of each ``(*group, symbol)`` that :func:`start_state_stats_stream` wrote.

    One partial aggregate over the written rows. Where several runs (queries
    with checkpoints of their own) wrote to the table, ``run_id`` names one.
    """
    rows = spark.read.option("basePath", table_path).parquet(table_path)
    if run_id is not None:
        rows = rows.filter(F.col("run_id") == run_id)
    else:
        # names of folders, not data: one row for each run
        runs = [r["run_id"] for r in rows.select("run_id").distinct().limit(2).collect()]
        if len(runs) > 1:
            raise ValueError(f"{table_path} has several runs; name one by run_id")
    keys = [*group, "symbol"]
    values = [c for c in rows.columns if c not in (*keys, "run_id", "batch_id")]
    newest = F.max_by(F.struct(*values), F.col("batch_id").cast("long")).alias("_s")
    return rows.groupBy(*keys).agg(newest).select(*keys, *[F.col(f"_s.{c}").alias(c) for c in values])


def compact_stats(
    spark: SparkSession, table_path: str, out_path: str, group: tuple[str, ...] = ("batch",), *, run_id: str
) -> None:
    """Write the newest statistics of a run as one folder of a new table at ``out_path``, which :func:`read_stats` reads.

    For a stopped run: its triggers' folders may then be dropped.
    """
    read_stats(spark, table_path, group, run_id=run_id).write.parquet(f"{out_path.rstrip('/')}/run_id={run_id}/batch_id=0")


def alerts_from_stats(
    spark: SparkSession, table_path: str, group: tuple[str, ...] = ("batch",), *, run_id: str | None = None, **kw
) -> DataFrame:
    """Apply the alert rules to the newest statistics that :func:`start_state_stats_stream` wrote."""
    return alerts(read_stats(spark, table_path, group, run_id=run_id), list(group), **kw)
