"""Helpers shared by the training-data operators."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricerisk.session import ensure_checkpoint_dir, ship_code_to_workers

#: A word is a run of characters other than these six (fixed by the task).
WHITE = " \t\n\x0b\x0c\r"
WORD_BREAK = r"[\x20\x09-\x0D]+"
HAS_WORD = r"[^\x20\x09-\x0D]"


def worker_cache() -> dict:
    """A dict that lives as long as the Python process.

    Spark reuses Python workers between tasks, so loaded tokenizers and memo
    tables kept here survive from one task to the next. It holds only values
    that can be rebuilt: a new worker starts empty and gives the same results.
    """
    name = "_pricerisk_worker_cache"
    module = sys.modules.get(name)
    if module is None:
        module = sys.modules.setdefault(name, types.ModuleType(name))
    return module.__dict__


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` of a mapInArrow, after which the worker gives back what Arrow holds free.

    Spark keeps a worker for later tasks, also of operators that need no
    Python; without this it keeps the largest buffers of its tasks as well.
    """

    def tidied(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()

    return tidied


# functions of this package reach workers with their code, so it need not be installed there
ship_code_to_workers()


def prepare(spark: SparkSession) -> None:
    """Checks the checkpoint folder, and keeps Arrow batches of whole texts small."""
    ensure_checkpoint_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``, which driver and executors share."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/pricerisk-llm/{name}-{uuid.uuid4().hex}"


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of the file system that Spark would use for it."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    full = fs.makeQualified(p).toString()
    if full.startswith("file:/") and not full.startswith("file:///"):
        full = "file://" + full[len("file:") :]
    return full


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again.

    Cuts the lineage: later steps read these files, also after executors are
    lost, and never re-run what made them. Rows, their partition numbers and
    the results of sampling stay the same for every reader.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Exactly the columns ``names``, whatever else ``df`` holds.

    Works by position, so extra columns whose names clash (other case, or the
    same name again: the first counts) do no harm.
    """
    have = df.columns
    missing = [n for n in names if n not in have]
    if missing:
        raise ValueError(f"missing columns {missing}; there are {have}")
    plain = df.toDF(*[f"_{i}" for i in range(len(have))])
    return plain.select(*[F.col(f"_{have.index(n)}").alias(n) for n in names])


def columns_of(df: DataFrame, names: tuple[str, ...]) -> tuple[str, ...]:
    return tuple(n for n in names if n in df.columns)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Hashes of a text; with doc_id they name a document where ids are null or repeat.
TEXT_KEY = ("_h1", "_h2")


def with_text_key(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.withColumn("_h1", F.xxhash64(F.col("text").isNull(), text)).withColumn("_h2", F.crc32(text))


def keep_rows(docs: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Rows of ``docs`` that ``verdicts`` names by doc_id and TEXT_KEY (both frames have them)."""
    named = verdicts.select(F.col("doc_id").alias("_d"), F.col("_h1").alias("_a"), F.col("_h2").alias("_b"))
    same = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_h1") == F.col("_a")) & (F.col("_h2") == F.col("_b"))
    return docs.join(named, same, "left_semi")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered(df: DataFrame, group: str, order: list[str], out: str, name: str) -> DataFrame:
    """Adds ``out``: a gapless number from 0 within each value of ``group``.

    ``df`` is written once with the number of the partition that each row was
    in. Rows are then numbered within (partition, group), and the counts of
    the partitions before are added. No task gathers a whole group: the
    largest unit is one partition's share of it. ``df`` should be narrow.
    """
    rows = written(df.withColumn("_pid", F.spark_partition_id()), name)
    counts = rows.groupBy(group, "_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        F.col(group).alias("_g"),
        F.col("_pid").alias("_p"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
    )
    inside = Window.partitionBy(group, "_pid").orderBy(*order)
    ranked = rows.withColumn("_rn", F.row_number().over(inside))
    joined = ranked.join(counts, (F.col(group) == F.col("_g")) & (F.col("_pid") == F.col("_p")))
    return joined.withColumn(out, F.col("_before") + F.col("_rn") - 1).drop("_pid", "_rn", "_g", "_p", "_before")
