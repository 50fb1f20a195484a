"""Sinks: partitioned raw writes (K1), table materialisation (K2-K4),
alert writes (K5), keyed messages (K6) and ingest counts (K8)."""

from __future__ import annotations

import logging
import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pricerisk.functions.expressions import iso_utc_string
from pricerisk.session import ensure_checkpoint_dir, file_system

# Landing folder of raw price files, and the source tag every
# tick message carries.
RAW_PREFIX = "stock_prices"
MESSAGE_SOURCE = "simulated"
# Fixed value: producers round prices to four places.
MESSAGE_DECIMALS = 4

log = logging.getLogger(__name__)


def raw_partition_path(root: str, dt: str) -> str:
    """Folder holding one landing run: ``<root>/stock_prices/dt=<dt>``."""
    return f"{root.rstrip('/')}/{RAW_PREFIX}/dt={dt}"


def write_raw(df: DataFrame, root: str, dt: str | None = None) -> str:
    """Land a batch under ``<root>/stock_prices/dt=<dt>/`` and return that folder.

    With ``dt=None`` the frame's own ``dt`` column names the folders (several
    run dates in one write) and the layer root is returned. Dynamic partition
    overwrite replaces only the ``dt`` values being written, so re-running a
    date replaces its files and leaves other dates alone.
    Executors write their own partitions; nothing is buffered on the driver.
    The written row count is gathered during the write (an ``Observation``,
    no second pass) and logged.
    """
    obs = Observation(f"raw_{dt or 'dt'}")
    (
        df.observe(obs, F.count(F.lit(1)).alias("rows"))
        .withColumn("dt", F.lit(dt) if dt is not None else F.col("dt").cast("string"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dt")
        .parquet(f"{root.rstrip('/')}/{RAW_PREFIX}")
    )
    path = raw_partition_path(root, dt) if dt is not None else f"{root.rstrip('/')}/{RAW_PREFIX}"
    log.info("landed %s rows at %s", obs.get.get("rows"), path)
    return path


def land_run(rows: DataFrame, rejects: DataFrame, root: str, run: str) -> dict[str, int]:
    """Land one ingest run: its rows by their ``dt`` and its rejects, committed together.

    Both are written to ``<root>/_landing/<run>`` first. Only when both are
    whole are the folders renamed to ``stock_prices/dt=<dt>`` (in place of an
    older run's folder of that date) and ``rejects/run=<run>``; the mark
    ``_committed`` in the landing folder comes before the first rename, so a
    run that was cut off can be ended by calling :func:`commit_run` again, and
    one that failed while writing has changed nothing. Returns the numbers of
    rows and rejects, counted while they are written.
    """
    spark = rows.sparkSession
    base = root.rstrip("/")
    landing = f"{base}/_landing/{run}"
    seen = Observation(f"rows_{uuid.uuid4().hex}"), Observation(f"rejects_{uuid.uuid4().hex}")
    fs, p = file_system(spark, landing)
    fs.delete(p, True)
    counted = rows.observe(seen[0], F.count(F.lit(1)).alias("n"))
    counted.write.partitionBy("dt").parquet(f"{landing}/{RAW_PREFIX}")
    rejects.observe(seen[1], F.count(F.lit(1)).alias("n")).write.parquet(f"{landing}/rejects")
    fs.create(file_system(spark, f"{landing}/_committed")[1], True).close()
    commit_run(spark, root, run)
    n = {"rows": seen[0].get["n"], "rejects": seen[1].get["n"]}
    log.info("landed run %s at %s: %s", run, base, n)
    return n


def commit_run(spark: SparkSession, root: str, run: str) -> bool:
    """Rename what :func:`land_run` wrote to its places; False if that run has nothing (more) to commit."""
    base = root.rstrip("/")
    landing = f"{base}/_landing/{run}"
    fs, mark = file_system(spark, f"{landing}/_committed")
    if not fs.exists(mark):
        return False
    path = lambda *parts: file_system(spark, "/".join(parts))[1]
    moves = []
    staged = path(landing, RAW_PREFIX)
    if fs.exists(staged):
        names = [st.getPath().getName() for st in fs.listStatus(staged)]
        moves = [(path(landing, RAW_PREFIX, n), path(base, RAW_PREFIX, n)) for n in names if n.startswith("dt=")]
    if fs.exists(path(landing, "rejects")):
        moves.append((path(landing, "rejects"), path(base, "rejects", f"run={run}")))
    for source, target in moves:
        fs.mkdirs(target.getParent())
        if fs.exists(target):
            fs.delete(target, True)
        if not fs.rename(source, target):
            raise OSError(f"cannot rename {source} to {target}")
    fs.delete(path(landing), True)
    return True


def layer_path(spark: SparkSession, layer: str, name: str, base: str | None = None) -> str:
    """Location of a materialised table: ``<base or checkpoint dir>/<layer>/<name>``."""
    root = (base or f"{ensure_checkpoint_dir(spark).rstrip('/')}/pricerisk/tables").rstrip("/")
    return f"{root}/{layer.lower()}/{name}"


def materialize(df: DataFrame, layer: str, name: str, *, base: str | None = None, view: bool = True) -> DataFrame:
    """Write ``df`` as a Parquet table (replacing any previous one) and read it back.

    This is ``CREATE TABLE AS`` plus the drop-if-exists before it: overwrite
    mode removes the old files too. The returned DataFrame scans the written
    files, which cuts the lineage (a lost executor re-reads the table instead
    of recomputing the plan) and lets later filters push down to the scan. A
    temp view ``<layer>_<name>`` is registered when ``view`` is true.
    """
    spark = df.sparkSession
    path = layer_path(spark, layer, name, base)
    df.write.mode("overwrite").parquet(path)
    out = spark.read.parquet(path)
    if view:
        register_view(out, f"{layer.lower()}_{name}")
    return out


def _pointer(folder: str) -> str:
    return f"{folder}/_current"


def _read_pointer(spark: SparkSession, folder: str) -> tuple[str, str] | None:
    """Version folder and key that a table's pointer names; None if there is no such table."""
    fs, p = file_system(spark, _pointer(folder))
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        text = bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
    version, key = text.split("\n")
    return version, key


def open_table(spark: SparkSession, layer: str, name: str, *, base: str | None = None, key: str | None = None) -> DataFrame | None:
    """The published version of a table; None if there is none, or none that was published under ``key``.

    Needs the shared folder only, so any later session finds the table.
    """
    folder = layer_path(spark, layer, name, base)
    found = _read_pointer(spark, folder)
    if found is None or (key is not None and found[1] != key):
        return None
    return spark.read.parquet(f"{folder}/{found[0]}")


def publish_table(
    df: DataFrame, layer: str, name: str, *, base: str | None = None, key: str = "", keep: int = 2
) -> DataFrame:
    """Write ``df`` as the new version of a durable table, then swap it in; returns the new version.

    The version is written beside the present one, which readers go on using;
    a pointer file is then replaced by renaming, so a failed write leaves the
    table as it was and there is no time without one. The ``keep`` newest
    versions stay for readers that began with an older one; others are
    deleted. The table is also known to the session's catalog as
    ``<layer>_<name>``. ``key`` says what the version was made from.
    """
    if "\n" in key or keep < 1:
        raise ValueError("a key has no line breaks, and one version at least stays")
    spark = df.sparkSession
    folder = layer_path(spark, layer, name, base)
    version = f"v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(f"{folder}/{version}")
    fs, new = file_system(spark, f"{_pointer(folder)}-{uuid.uuid4().hex}")
    stream = fs.create(new, True)
    try:
        stream.write(f"{version}\n{key}".encode())
    finally:
        stream.close()
    context = spark.sparkContext._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        new.toUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    rename = spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    target = file_system(spark, _pointer(folder))[1]
    context.rename(fs.makeQualified(new), fs.makeQualified(target), options)
    _drop_old_versions(spark, folder, keep)
    out = spark.read.parquet(f"{folder}/{version}")
    register_table(spark, f"{layer.lower()}_{name}", f"{folder}/{version}")
    return out


def _drop_old_versions(spark: SparkSession, folder: str, keep: int) -> None:
    fs, p = file_system(spark, folder)
    versions = sorted(st.getPath().getName() for st in fs.listStatus(p) if st.getPath().getName().startswith("v-"))
    current = _read_pointer(spark, folder)
    for v in versions[:-keep]:
        if current is None or v != current[0]:
            fs.delete(file_system(spark, f"{folder}/{v}")[1], True)


def register_table(spark: SparkSession, name: str, path: str) -> None:
    """A table of the session catalog over the files at ``path``, in place of one (or a view) of that name."""
    spark.catalog.dropTempView(name)
    spark.sql(f"DROP TABLE IF EXISTS `{name}`")
    spark.sql(f"CREATE TABLE `{name}` USING parquet LOCATION '{path}'")


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Named view (``CREATE OR REPLACE TEMP VIEW``)."""
    df.createOrReplaceTempView(name)
    return df


#: Run of alerts that are written without a streaming query.
MANUAL_RUN = "manual"


def write_alerts(alerts: DataFrame, batch_id: int, path: str, fmt: str = "parquet", run_id: str = MANUAL_RUN) -> None:
    """Write one micro-batch of alerts idempotently.

    Rows are written under ``run_id=<run>/batch_id=<id>`` with dynamic
    partition overwrite, so a replayed batch replaces its own output instead
    of appending a second copy, and batches of other runs (another query on
    the same sink, or one that began again with a fresh checkpoint) stay. Rows
    are written by the tasks that produced them (AQE has already merged small
    partitions), so no single task gathers a batch.
    """
    (
        alerts.withColumn("run_id", F.lit(run_id))
        .withColumn("batch_id", F.lit(int(batch_id)).cast("long"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id", "batch_id")
        .format(fmt)
        .save(path)
    )


def read_alerts(spark: SparkSession, path: str, fmt: str = "parquet", view: str | None = "alerts") -> DataFrame:
    """Read the alert table back (and register it as a view for SQL)."""
    df = spark.read.format(fmt).load(path)
    if view:
        register_view(df, view)
    return df


def to_keyed_messages(ticks: DataFrame, source: str = MESSAGE_SOURCE, decimals: int | None = MESSAGE_DECIMALS) -> DataFrame:
    """Tick rows -> ``(key, value)`` messages: key = symbol, value = JSON body.

    The body carries symbol, price, prev_price, change_pct, volume, an ISO-8601
    UTC timestamp and the source tag. Numbers are written in plain notation with
    ``decimals`` places (producers round prices to four); with ``None`` as the
    shortest text that reads back as the same double, so no digit is lost. A broker sink partitions by the
    key, which keeps each symbol's messages in order; nothing is repartitioned
    here, so a hot symbol is not funnelled into one task.
    """
    kind = "double" if decimals is None else f"decimal(38,{int(decimals)})"
    num = lambda c: F.col(c).cast(kind).alias(c)
    body = F.struct(
        F.col("symbol"),
        num("price"),
        num("prev_price"),
        num("change_pct"),
        F.col("volume").cast("long").alias("volume"),
        iso_utc_string("timestamp").alias("timestamp"),
        F.lit(source).alias("source"),
    )
    return ticks.select(F.col("symbol").alias("key"), F.to_json(body, {"ignoreNullFields": "false"}).alias("value"))


def ingest_counts(df: DataFrame) -> DataFrame:
    """Rows per symbol plus the total, which ``is_total`` tells from rows without a symbol."""
    return df.rollup("symbol").agg(
        F.count(F.lit(1)).alias("row_count"), (F.grouping("symbol") == 1).alias("is_total")
    )
