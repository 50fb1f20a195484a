"""Length-delimited binary records of token ids with a separate offset index.

A record is a length (uint64), the masked checksum of those eight bytes, the
payload, and the payload's masked checksum; all numbers are little-endian. The
payload is a flag byte (1: the document has an id), the id (int64), the bytes
of one token id (2 or 4) and the ids. A masked checksum is the CRC-32 rotated
right by 15 bits plus a constant, so that checksums of data that itself holds
checksums stay useful.

Files come in ascending document order: rows are range-partitioned by document
id and sorted inside each partition, and a partition writes one file after
another of at most ``file_bytes`` (and one record). A task writes under a name
of its own attempt, and the index that Spark commits lists only files of
attempts that succeeded; what a lost executor leaves behind is never read.

Defined results: a null text is empty, an empty one is a record with the end
id alone; null document ids sort first; repeated rows are repeated records; an
empty table gives no record. Equal document ids with different texts stand in
the order of the texts' hashes. Extra columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from pricerisk.llm.common import pick, prepare, qualified, shared_path, shuffle_partitions
from pricerisk.llm.tokens import encoder, in_slices

END_ID = 2
#: Fixed value of the masking rule.
MASK_DELTA = 0xA282EAD8

INDEX = T.StructType(
    [
        T.StructField("part", T.IntegerType(), False),
        T.StructField("file_no", T.IntegerType(), False),
        T.StructField("file", T.StringType(), False),
        T.StructField("record_no", T.LongType(), False),
        T.StructField("doc_id", T.LongType()),
        T.StructField("byte_offset", T.LongType(), False),
        T.StructField("n_bytes", T.LongType(), False),
        T.StructField("n_tokens", T.LongType(), False),
    ]
)

RECORDS = T.StructType(
    [
        T.StructField("file", T.StringType(), False),
        T.StructField("record_no", T.LongType(), False),
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType(), False),
        T.StructField("n_tokens", T.LongType(), False),
        T.StructField("ids_crc32", T.LongType(), False),
        T.StructField("ids", T.BinaryType()),
    ]
)


class DamagedRecord(ValueError):
    """A checksum or a length in a record file is wrong."""


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: bytes, width: int) -> bytes:
    payload = struct.pack("<BqB", doc_id is not None, doc_id or 0, width) + ids
    length = struct.pack("<Q", len(payload))
    return length + struct.pack("<I", masked(length)) + payload + struct.pack("<I", masked(payload))


def read_frame(stream) -> tuple[int | None, np.ndarray, int] | None:
    """The next record's document id, ids as uint32, and size; None at the end."""
    head = stream.read(12)
    if not head:
        return None
    if len(head) < 12 or masked(head[:8]) != struct.unpack("<I", head[8:])[0]:
        raise DamagedRecord("length")
    n = struct.unpack("<Q", head[:8])[0]
    body = stream.read(n + 4)
    if len(body) < n + 4 or masked(body[:n]) != struct.unpack("<I", body[n:])[0]:
        raise DamagedRecord("payload")
    known, doc_id, width = struct.unpack("<BqB", body[:10])
    ids = np.frombuffer(body[10:n], dtype="<u2" if width == 2 else "<u4").astype("<u4")
    return (doc_id if known else None), ids, 12 + n + 4


def _store(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_records(
    docs: DataFrame,
    tokenizer_path: str,
    folder: str,
    end_id: int = END_ID,
    n_parts: int | None = None,
    file_bytes: int = 64 << 20,
) -> DataFrame:
    """Writes record files to ``folder``/data and the index as Parquet to ``folder``/index; returns the index."""
    spark = docs.sparkSession
    folder = qualified(spark, folder)
    n_parts = n_parts or shuffle_partitions(spark)

    def run(batches):
        enc = encoder(tokenizer_path)
        store, base = _store(f"{folder}/data")
        store.create_dir(base, recursive=True)
        attempt = uuid.uuid4().hex
        out, name, file_no, at, record_no, part = None, "", -1, 0, 0, -1
        tail = np.array([end_id], dtype=enc.dtype).tobytes()
        width = enc.dtype.itemsize
        try:
            for batch in batches:
                ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                texts = [t or "" for t in texts]
                if part < 0 and ids:
                    part = batch.column(2)[0].as_py()
                for a, b in in_slices(texts):
                    rows = []
                    for doc, raw in zip(ids[a:b], enc.encode(texts[a:b])):
                        if out is None or at >= file_bytes:
                            if out is not None:
                                out.close()
                            file_no, at = file_no + 1, 0
                            name = f"part-{part:06d}-{file_no:04d}-{attempt}.rec"
                            out = store.open_output_stream(f"{base}/{name}")
                        data = frame(doc, raw + tail, width)
                        out.write(data)
                        rows.append((part, file_no, name, record_no, doc, at, len(data), len(raw) // width + 1))
                        at += len(data)
                        record_no += 1
                    columns = list(zip(*rows))
                    types = (pa.int32(), pa.int32(), pa.string(), *[pa.int64()] * 5)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, type=t) for c, t in zip(columns, types)], names=INDEX.fieldNames()
                    )
        finally:
            if out is not None:
                out.close()

    d = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # equal ids with different texts may spread over partitions; the order among them is by this hash
    ordered = (
        d.withColumn("_h", F.xxhash64("text"))
        .repartitionByRange(n_parts, "doc_id", "_h")
        .sortWithinPartitions("doc_id", "_h")
        .select("doc_id", "text", F.spark_partition_id().alias("part"))
    )
    ordered.mapInArrow(run, INDEX).write.parquet(f"{folder}/index")
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


def record_files(spark: SparkSession, folder: str) -> DataFrame:
    """The files in order, with the ids in all files before each: file, n_records, before."""
    index = spark.read.schema(INDEX).parquet(f"{folder}/index")
    files = index.groupBy("part", "file_no", "file").agg(
        F.count(F.lit(1)).alias("n_records"), F.sum("n_tokens").alias("n")
    )
    # files are numbered within their part; only the parts, as many as shuffle partitions, have one order
    parts = files.groupBy(F.col("part").alias("_part")).agg(F.sum("n").alias("_n"))
    parts = parts.select("_part", F.coalesce(F.sum("_n").over(_rows_before().orderBy("_part")), F.lit(0)).alias("_before"))
    inside = F.coalesce(F.sum("n").over(_rows_before().partitionBy("part").orderBy("file_no")), F.lit(0))
    counted = files.withColumn("_inside", inside).join(parts, F.col("part") == F.col("_part"))
    return counted.select("file", "n_records", (F.col("_before") + F.col("_inside")).alias("before"))


def _rows_before():
    return Window.rowsBetween(Window.unboundedPreceding, -1)


def read_records(spark: SparkSession, folder: str, digest: bool = False) -> DataFrame:
    """Every record of ``folder``, read from the files and checked.

    Each task reads whole files from front to back. ``start`` counts the ids
    of all documents before. ``ids`` holds little-endian uint32 values, and
    ``ids_crc32`` their CRC-32; with ``digest`` the ids are left out.
    """
    folder = qualified(spark, folder)

    def run(batches):
        store, base = _store(f"{folder}/data")

        def batch_of(rows):
            types = (pa.string(), *[pa.int64()] * 5, pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(zip(*rows), types)], names=RECORDS.fieldNames()
            )

        for batch in batches:
            for f in batch.to_pylist():
                rows, held, start, seen = [], 0, f["before"], 0
                with store.open_input_stream(f"{base}/{f['file']}") as stream:
                    while (record := read_frame(stream)) is not None:
                        doc, ids, size = record
                        data = ids.tobytes()
                        rows.append((f["file"], seen, doc, start, len(ids), zlib.crc32(data), None if digest else data))
                        start, seen, held = start + len(ids), seen + 1, held + 64 + (0 if digest else len(data))
                        if held >= 8 << 20:
                            yield batch_of(rows)
                            rows, held = [], 0
                if seen != f["n_records"]:
                    raise DamagedRecord(f"{f['file']} has {seen} records; the index has {f['n_records']}")
                if rows:
                    yield batch_of(rows)

    files = record_files(spark, folder)
    return files.repartition(shuffle_partitions(spark), "file").mapInArrow(run, RECORDS)


def read_record(spark: SparkSession, folder: str, file: str, byte_offset: int) -> tuple[int | None, np.ndarray]:
    """One record by its place in the index, for reads in shuffled order."""
    store, base = _store(qualified(spark, folder) + "/data")
    with store.open_input_file(f"{base}/{file}") as f:
        f.seek(byte_offset)
        doc_id, ids, _ = read_frame(f)
    return doc_id, ids


def records_round_trip(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, folder: str | None = None) -> DataFrame:
    """Writes ``docs`` as records, reads the files back: doc_id, start, n_tokens, ids_crc32."""
    spark = docs.sparkSession
    prepare(spark)
    folder = folder or shared_path(spark, "records")
    write_records(docs, tokenizer_path, folder, end_id)
    return read_records(spark, folder, digest=True).select("doc_id", "start", "n_tokens", "ids_crc32")
