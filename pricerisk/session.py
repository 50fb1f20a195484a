"""Session construction and the shared scratch location.

Everything the library materialises (core tables, marts, stream sinks and
checkpoints when no explicit path is given) lives under the directory the
cluster names in ``spark.checkpoint.dir``. That folder is shared storage on a
real cluster, so written tables survive the loss of any executor. A private
folder is created only when the setting is unset, which happens in local test
sessions.
"""

from __future__ import annotations

import hashlib
import os
import sys
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session built by this library carries. AQE re-plans joins
# and coalesces small shuffle partitions from runtime statistics, and splits
# skewed join partitions; the session time zone is pinned so DATE/TIMESTAMP
# arithmetic is reproducible.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


# Target bytes per task for scans and shuffle partitions.
TARGET_PARTITION_BYTES = 256 * 1024 * 1024


def scale_conf(input_bytes: int, *, total_cores: int | None = None) -> dict[str, str]:
    """Partition sizing for a job reading ``input_bytes``.

    Scan splits and AQE's advisory shuffle partition size are set to
    :data:`TARGET_PARTITION_BYTES`; the initial shuffle partition count is the
    input size over that target (at least 2x the cores), so no shuffle
    partition starts larger than a task can sort in memory and AQE only has
    to merge small ones. Skewed join partitions above 4x the target are split.
    """
    parts = max(1, -(-int(input_bytes) // TARGET_PARTITION_BYTES))
    if total_cores:
        parts = max(parts, 2 * int(total_cores))
    t = str(TARGET_PARTITION_BYTES)
    return {
        "spark.sql.files.maxPartitionBytes": t,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": t,
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * TARGET_PARTITION_BYTES),
    }


def get_session(
    master: str | None = None, app: str = "pricerisk", *, input_bytes: int | None = None, **conf
) -> SparkSession:
    """Return the active session or build one with :data:`DEFAULT_CONF`.

    ``input_bytes`` adds :func:`scale_conf` sizing; explicit ``conf`` wins.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    sizing = scale_conf(input_bytes) if input_bytes else {}
    for k, v in {**DEFAULT_CONF, **sizing, **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a private one only if unset.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is used
    as is. When it is unset (local tests) a fresh folder is made and recorded
    both in the SparkContext and in the session conf so later calls agree.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master or ""
        if not master.startswith("local"):
            raise ValueError(
                "spark.checkpoint.dir is unset; point it at shared storage on a cluster"
            )
        d = tempfile.mkdtemp(prefix="pricerisk-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
        spark.conf.set("spark.checkpoint.dir", d)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A path under the shared checkpoint folder (``<dir>/pricerisk/<parts>/<uuid>``)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    segs = [base, "pricerisk", *parts]
    if unique:
        segs.append(uuid.uuid4().hex)
    p = "/".join(segs)
    if p.startswith("/") or p.startswith("file:"):
        os.makedirs(p.replace("file:", "", 1), exist_ok=True)
    return p


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and the path in it: any storage that Spark itself can reach."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def fingerprint(spark: SparkSession, *paths: str) -> str:
    """A name for what files or folders hold now: their files' names, lengths and times of change."""
    seen = []
    for path in paths:
        fs, p = file_system(spark, path)
        files = fs.listFiles(p, True)
        while files.hasNext():
            st = files.next()
            seen.append((st.getPath().toString(), st.getLen(), st.getModificationTime()))
    return hashlib.sha256(repr(sorted(seen)).encode()).hexdigest()[:24]


def ship_code_to_workers() -> None:
    """Pickle this package's functions by value for Python workers.

    Grouped-map functions (``applyInPandas``/``applyInPandasWithState``) then
    reach executors with their code, so workers need not have the package
    installed or on their path.
    """
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules["pricerisk"])
