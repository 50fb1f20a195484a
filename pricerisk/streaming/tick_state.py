"""Streaming tick change (R12) with per-symbol carried state.

The producer keeps each symbol's last price between ticks. On a stream that
state has to survive micro-batches and restarts. Here every micro-batch runs
the batch operator :func:`pricerisk.operators.ticks.tick_change` (whose lag is
the skew-safe chunked scan, so a hot symbol is not one task), seeded with the
last price of each symbol from the previous batches. The state is a small
table, one row per symbol, versioned by batch id under ``state/batch_id=<n>``:

* batch ``n`` reads the newest version below ``n``;
* writes its ticks under ``out/batch_id=<n>`` and the new state under
  ``state/batch_id=<n>`` with partition overwrite, so a re-run batch replaces
  both and never double-applies;
* then drops state versions older than ``n - 1``: a replay of batch ``n``
  needs only version ``n - 1``, so the state folder stays two versions deep
  however long the stream runs.

Ticks that arrive later than newer ticks of the same symbol in an earlier
batch are compared with the newest known price (arrival order across
batches, event order within a batch).

:func:`tick_change_keyed` is the same operator on Spark's keyed state
(``applyInPandasWithState``): one state row per symbol, but each symbol's
ticks of a micro-batch form one group.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from pricerisk.operators.ticks import latest_tick, tick_change, with_change
from pricerisk.session import scratch_path, ship_code_to_workers


def _write_partition(df: DataFrame, path: str, batch_id: int) -> None:
    (
        df.withColumn("batch_id", F.lit(int(batch_id)).cast("long"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(path)
    )


def state_versions(spark: SparkSession, state_path: str) -> list[int]:
    """Batch ids with a state version, from the folder's names; none if there is no folder yet."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(state_path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(root) if st.isDirectory()]
    return sorted(int(n.split("=", 1)[1]) for n in names if re.fullmatch(r"batch_id=\d+", n))


def newest_version(spark: SparkSession, state_path: str, before_batch: int) -> int | None:
    """The newest version below ``before_batch``, whatever its number."""
    return max((v for v in state_versions(spark, state_path) if v < before_batch), default=None)


def read_state(spark: SparkSession, state_path: str, before_batch: int) -> DataFrame | None:
    """Newest state version with ``batch_id < before_batch`` (None if there is none).

    Only a missing folder or version means "no state yet"; a version that
    cannot be read raises.
    """
    last = newest_version(spark, state_path, before_batch)
    if last is None:
        return None
    return spark.read.parquet(f"{state_path.rstrip('/')}/batch_id={last}")


def tick_change_batch(batch_df: DataFrame, batch_id: int, out_path: str, state_path: str) -> None:
    """Process one micro-batch of ticks (symbol, price, timestamp[, event_id, ...]).

    The micro-batch is kept while it is processed, so its source is read once.
    """
    batch_df = batch_df.persist()
    try:
        _tick_change_batch(batch_df, batch_id, out_path, state_path)
    finally:
        batch_df.unpersist()


def _tick_change_batch(batch_df: DataFrame, batch_id: int, out_path: str, state_path: str) -> None:
    if batch_df.isEmpty():
        return
    spark = batch_df.sparkSession
    used = newest_version(spark, state_path, batch_id)
    state = read_state(spark, state_path, batch_id)
    base = state.select("symbol", F.col("last_price").alias("base_price")) if state is not None else None
    tiebreak = "event_id" if "event_id" in batch_df.columns else None
    _write_partition(tick_change(batch_df, tiebreak=tiebreak, base=base), out_path, batch_id)

    newest = latest_tick(batch_df, ["symbol"], tiebreak=tiebreak).select(
        "symbol", F.col("latest_price").alias("last_price"), F.col("latest_ts").alias("last_ts")
    )
    if state is not None:
        kept = state.join(newest.select("symbol"), "symbol", "left_anti")
        newest = kept.select(*newest.columns).unionByName(newest)
    _write_partition(newest, state_path, batch_id)
    # a replay of this batch needs the version it was computed from
    prune_state_versions(spark, state_path, keep_from=batch_id if used is None else used)


def prune_state_versions(spark: SparkSession, state_path: str, keep_from: int) -> int:
    """Delete ``state/batch_id=<k>`` folders with ``k < keep_from``; returns how many.

    Uses the Hadoop FileSystem of the path, so it works on any shared storage
    the cluster's checkpoint folder lives on.
    """
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(state_path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return 0
    removed = 0
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("batch_id="):
            try:
                k = int(name.split("=", 1)[1])
            except ValueError:
                continue
            if k < keep_from and fs.delete(st.getPath(), True):
                removed += 1
    return removed


def start_tick_change_stream(
    ticks: DataFrame,
    out_path: str,
    *,
    state_path: str | None = None,
    checkpoint: str | None = None,
    trigger: str = "10 seconds",
    available_now: bool = False,
) -> StreamingQuery:
    """Start the streaming tick-change job; returns the running query."""
    spark = ticks.sparkSession
    state = state_path or scratch_path(spark, "streams", "tick_state")
    ckpt = checkpoint or scratch_path(spark, "streams", "tick_change")

    def process(batch_df: DataFrame, batch_id: int) -> None:
        tick_change_batch(batch_df, batch_id, out_path, state)

    w = ticks.writeStream.foreachBatch(process).option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()


# --- keyed-state variant ------------------------------------------------------

_KEYED_OUT = "symbol string, timestamp timestamp, event_id long, price double, prev_price double"
_KEYED_STATE = "last_price double, has_price boolean"


def _carry_prev_price(key, pdfs, state):
    """Per symbol and micro-batch: the last known price before each tick, seeded from state."""
    frames = [f for f in pdfs if len(f)]
    if not frames:
        return
    pdf = frames[0] if len(frames) == 1 else pd.concat(frames, ignore_index=True)
    pdf = pdf.sort_values(["timestamp", "event_id"], kind="mergesort", ignore_index=True)
    known = pdf["price"].astype("float64").ffill()
    if state.exists and state.get[1]:
        known = known.fillna(state.get[0])
    pdf["prev_price"] = known.shift(1)
    if state.exists and state.get[1]:
        pdf.loc[0, "prev_price"] = state.get[0]
    last = known.iloc[-1]
    # a symbol without any price so far has no last price yet
    state.update((None, False) if pd.isna(last) else (float(last), True))
    yield pdf[["symbol", "timestamp", "event_id", "price", "prev_price"]]


def tick_change_keyed(ticks: DataFrame) -> DataFrame:
    """Streaming tick change with ``applyInPandasWithState`` keyed by symbol.

    The state is one row per symbol (its last known price; ticks without a
    price do not change it, as in the batch operator). Each micro-batch's ticks
    of a symbol arrive as one group, ordered by ``(timestamp, event_id)``
    there; ``change_pct`` and ``direction`` are the batch operator's Spark
    expressions. A symbol's group is bounded by the trigger size
    (``maxFilesPerTrigger``/``maxOffsetsPerTrigger``); when one symbol
    dominates a micro-batch, :func:`start_tick_change_stream` (chunked scan
    per batch) spreads it over many tasks instead.
    """
    ship_code_to_workers()
    out = ticks.select("symbol", "timestamp", "event_id", "price").groupBy("symbol").applyInPandasWithState(
        _carry_prev_price, _KEYED_OUT, _KEYED_STATE, "append", GroupStateTimeout.NoTimeout
    )
    return with_change(out)


def start_tick_change_keyed_stream(
    ticks: DataFrame,
    out_path: str,
    *,
    checkpoint: str | None = None,
    trigger: str = "10 seconds",
    available_now: bool = False,
) -> StreamingQuery:
    """Start :func:`tick_change_keyed` appending to Parquet at ``out_path``."""
    spark = ticks.sparkSession
    ckpt = checkpoint or scratch_path(spark, "streams", "tick_change_keyed")
    w = tick_change_keyed(ticks).writeStream.outputMode("append").format("parquet")
    w = w.option("checkpointLocation", ckpt).option("path", out_path)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()
