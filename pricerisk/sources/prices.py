"""Price sources: raw landed files, staging, universe, history window, JSON payloads.

Covers the scans and ingest-side projections: glob scan of the raw layer (S1),
epoch-ns -> DATE staging (P1), the ticker universe (S4) and its semi-join,
the history window (S2), JSON array-of-records payloads (S3, P5), vendor
column normalisation (P2, P3) and the union of per-symbol sources (U1, F6).
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricerisk.functions.expressions import epoch_ns_to_date, iso_utc_string, utc_today
from pricerisk.schemas import RAW_PRICE

# Schema of one record in a price payload (the ingest response body).
PRICE_RECORD = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("volume", T.LongType()),
        T.StructField("ingested_at", T.StringType()),
    ]
)


def read_raw_prices(
    spark: SparkSession,
    root: str,
    *,
    keep_dt: bool = False,
    dt_from: str | None = None,
    dt_to: str | None = None,
    schema=RAW_PRICE,
) -> DataFrame:
    """Scan every ``dt=`` folder of the raw price layer.

    With ``keep_dt=False`` the files are globbed (``root/*/*.parquet``) and the
    folder value is not surfaced, like the staging view. With ``keep_dt=True``
    (implied by ``dt_from``/``dt_to``) the root is read as a partitioned table:
    ``dt`` becomes a DATE column and the inclusive ``[dt_from, dt_to]`` range is
    a partition filter: files of folders outside it are pruned and not read.
    ``date`` is read as BIGINT epoch ns, which also accepts files whose
    physical type is INT64 TIMESTAMP(NANOS).
    """
    root = root.rstrip("/")
    if not (keep_dt or dt_from or dt_to):
        return spark.read.schema(schema).parquet(f"{root}/*/*.parquet")
    df = spark.read.schema(T.StructType(schema.fields + [T.StructField("dt", T.DateType())])).parquet(root)
    if dt_from:
        df = df.filter(F.col("dt") >= F.lit(dt_from).cast("date"))
    if dt_to:
        df = df.filter(F.col("dt") <= F.lit(dt_to).cast("date"))
    return df


def stage_prices(raw: DataFrame) -> DataFrame:
    """Staging projection: epoch-ns ``date`` -> DATE plus the bar columns."""
    return raw.select(
        epoch_ns_to_date("date").alias("date"),
        "symbol",
        "open",
        "high",
        "low",
        "close",
        "volume",
        "ingested_at",
    )


# The default universe, the eight tracked tickers in configured order.
DEFAULT_TICKERS = [
    ("NWG.L", "NatWest Group"),
    ("ABDN.L", "abrdn plc"),
    ("SMT.L", "Scottish Mortgage Investment Trust"),
    ("MNKS.L", "Monks Investment Trust"),
    ("AV.L", "Aviva"),
    ("HIK.L", "Hikma Pharmaceuticals"),
    ("SSE.L", "SSE plc"),
    ("WEIR.L", "Weir Group"),
]


def _yaml_tickers(path: str) -> list[dict]:
    """The ``tickers:`` list of a YAML config file (small; read on the driver)."""
    try:
        import yaml
    except ImportError as e:  # pragma: no cover - PyYAML is optional
        raise ImportError("reading a YAML ticker config needs PyYAML; pass a list or JSON lines") from e
    with open(path) as f:
        return list(yaml.safe_load(f)["tickers"])


def universe(spark: SparkSession, tickers: Sequence | str | None = None) -> DataFrame:
    """Ticker universe as ``(position, symbol, name)`` in configured order.

    ``tickers`` is a list of symbols, of ``(symbol, name)`` pairs or of
    ``{"symbol":..., "name":...}`` dicts; a path to a YAML config with a
    ``tickers:`` list; or a path to JSON-lines records (read by Spark, order
    follows the file). ``None`` gives :data:`DEFAULT_TICKERS`.
    """
    if tickers is None:
        tickers = DEFAULT_TICKERS
    elif isinstance(tickers, str) and tickers.endswith((".yaml", ".yml")):
        tickers = _yaml_tickers(tickers)
    if isinstance(tickers, str):
        df = spark.read.schema("symbol string, name string").json(tickers)
        return df.withColumn("position", F.monotonically_increasing_id()).select("position", "symbol", "name")
    rows = []
    for i, t in enumerate(tickers):
        if isinstance(t, str):
            rows.append((i, t, None))
        elif isinstance(t, dict):
            rows.append((i, t["symbol"], t.get("name")))
        else:
            rows.append((i, t[0], t[1] if len(t) > 1 else None))
    return spark.createDataFrame(rows, "position long, symbol string, name string")


def universe_filter(df: DataFrame, tickers: DataFrame) -> DataFrame:
    """Keep rows whose symbol is in the universe (left semi join).

    The planner measures the universe: a configured list is broadcast because
    its size is known to be small, a universe read from a large table is
    joined by shuffling. The universe also filters the scan at run time: where
    ``df`` is partitioned by symbol on storage, folders of other symbols are
    not read (dynamic partition pruning); with the session's Bloom filter
    join on, a large shuffled side is thinned out before its shuffle.
    """
    return df.join(tickers.select("symbol"), "symbol", "left_semi")


# Fixed value: default history window, in days, ending today.
DEFAULT_HISTORY_DAYS = 365


def load_history(
    prices: DataFrame,
    tickers: DataFrame | None,
    start=None,
    end=None,
) -> DataFrame:
    """Bars of the universe in ``[start, end)`` (end exclusive).

    ``end`` defaults to today (UTC) and ``start`` to ``end`` minus 365 days.
    The date predicate is a plain comparison, so it reaches the Parquet scan
    as a pushed filter (and prunes folders when ``date`` is a partition column).
    """
    end_c = F.lit(end).cast("date") if end is not None else utc_today()
    start_c = F.lit(start).cast("date") if start is not None else F.date_sub(end_c, DEFAULT_HISTORY_DAYS)
    out = prices.filter((F.col("date") >= start_c) & (F.col("date") < end_c))
    if tickers is not None:
        out = universe_filter(out, tickers)
    return out


def _or_raise(arr: Column, raw: Column) -> Column:
    """``arr``, or an error with the beginning of ``raw`` where that does not parse."""
    said = F.concat(F.lit("price payload does not parse: "), F.substring(raw, 1, 200))
    return F.coalesce(arr, F.when(raw.isNotNull(), F.raise_error(said)))


def _typed_records(rows: DataFrame) -> DataFrame:
    return rows.withColumn("date", F.to_timestamp("date")) if "date" in rows.columns else rows


def records_to_prices(
    df: DataFrame, payload_col: str = "payload", record_schema: T.StructType = PRICE_RECORD, *, strict: bool = True
) -> DataFrame:
    """Explode a JSON array-of-records payload into typed rows.

    The payload may be a JSON string or an already parsed ``array<struct>``.
    If the records carry a ``date`` field it is parsed to TIMESTAMP (ISO-8601).
    Each payload row is exploded where it lies; no payload is gathered.
    A text that does not parse is an error. With ``strict=False`` it gives no
    rows; ``rejected_payloads`` has it, and null payloads.
    """
    raw = F.col(payload_col)
    if not isinstance(df.schema[payload_col].dataType, T.StringType):
        return _typed_records(df.select(F.inline(raw)))
    arr = F.from_json(raw, T.ArrayType(record_schema))
    return _typed_records(df.select(F.inline(_or_raise(arr, raw) if strict else arr)))


def rejected_payloads(df: DataFrame, payload_col: str = "payload", record_schema: T.StructType = PRICE_RECORD) -> DataFrame:
    """(raw, reason) of every payload that gives ``records_to_prices`` no records to read."""
    raw = F.col(payload_col)
    text = isinstance(df.schema[payload_col].dataType, T.StringType)
    arr = F.from_json(raw, T.ArrayType(record_schema)) if text else raw
    reason = F.when(raw.isNull(), "no payload").when(arr.isNull(), "payload does not parse")
    return df.select(raw.cast("string").alias("raw"), reason.alias("reason")).where(F.col("reason").isNotNull())


def _upload_requests(df: DataFrame, body_col: str, record_schema: T.StructType) -> DataFrame:
    """raw, payload, dt, records and the reason for which a request is rejected (null: it is not)."""
    body = F.col(body_col).cast("string")
    req = df.select(
        body.alias("raw"),
        F.get_json_object(body, "$.data").alias("payload"),
        F.get_json_object(body, "$.date").alias("_date"),
    )
    req = req.withColumn("dt", F.try_to_timestamp("_date").cast("date"))
    req = req.withColumn("records", F.from_json("payload", T.ArrayType(record_schema)))
    missing = F.col("payload").isNull() | F.coalesce(F.col("_date") == "", F.lit(True))
    reason = (
        F.when(missing & F.from_json("raw", "map<string,string>").isNull(), "body does not parse")
        .when(missing, "missing data or date")
        .when(F.col("records").isNull(), "data does not parse")
        .when(F.col("dt").isNull(), "date does not parse")
    )
    return req.withColumn("reason", reason)


#: A request without these fields is answered as such; it holds nothing that could be lost.
_ANSWERED = "missing data or date"


def upload_requests_to_prices(
    df: DataFrame, body_col: str = "body", record_schema: T.StructType = PRICE_RECORD, *, strict: bool = True
) -> DataFrame:
    """Upload request bodies ``{"data": ..., "date": ...}`` -> typed price rows plus ``dt``.

    ``data`` may be the JSON array of records itself or that array serialised
    once more as a JSON string; ``get_json_object`` yields the array text in
    both cases. ``date`` is the run date that names the landing folder (``dt``).
    Requests without data or date yield no rows. A body, data or date that
    does not parse is an error; with ``strict=False`` it yields no rows either.
    ``rejected_requests`` has all of these.
    """
    req = _upload_requests(df, body_col, record_schema)
    records = F.when(F.col("reason").isNull(), F.col("records"))
    if strict:
        said = F.concat(F.lit("upload request: "), F.col("reason"), F.lit(": "), F.substring("raw", 1, 200))
        records = F.when(F.col("reason") != _ANSWERED, F.raise_error(said)).otherwise(records)
    rows = _typed_records(req.select("dt", F.inline(records)))
    return rows.select(*[c for c in rows.columns if c != "dt"], "dt")


def rejected_requests(df: DataFrame, body_col: str = "body", record_schema: T.StructType = PRICE_RECORD) -> DataFrame:
    """(raw, reason) of every upload request that yields no rows for what it lacks or cannot be read."""
    return _upload_requests(df, body_col, record_schema).where(F.col("reason").isNotNull()).select("raw", "reason")


def reject_counts(rejected: DataFrame) -> DataFrame:
    """reason, n of a reject output."""
    return rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def to_raw(rows: DataFrame, ingested_at: str | Column | None = None) -> DataFrame:
    """Price rows in the raw layer's schema, whatever they came from.

    ``date`` may be a TIMESTAMP, a DATE, ISO-8601 text or epoch nanoseconds
    already; it becomes epoch nanoseconds, in UTC whatever the session's zone
    (a DATE is its UTC midnight). Missing columns are NULL and others are left
    out, but for ``dt``, which names the landing folder. Rows without
    ``ingested_at`` get the given one, or the current UTC time.
    """
    kind = rows.schema["date"].dataType
    date = F.col("date")
    if isinstance(kind, T.StringType):
        date, kind = F.to_timestamp(date), T.TimestampType()
    if isinstance(kind, T.DateType):
        micros = F.unix_date(date).cast("long") * 86_400_000_000
    elif isinstance(kind, T.TimestampNTZType):
        # the wall clock is taken as UTC: undo the session zone that the cast reads it in
        micros = F.unix_micros(F.from_utc_timestamp(date.cast("timestamp"), F.current_timezone()))
    elif isinstance(kind, T.TimestampType):
        micros = F.unix_micros(date)
    else:
        micros = None
    nanos = date.cast("long") if micros is None else micros * 1000
    if ingested_at is None:
        stamp = iso_utc_string(F.current_timestamp())
    else:
        stamp = F.lit(ingested_at) if isinstance(ingested_at, str) else ingested_at
    have = set(rows.columns)
    out = []
    for f in RAW_PRICE.fields:
        if f.name == "date":
            out.append(nanos.alias("date"))
        elif f.name == "ingested_at":
            out.append((F.coalesce(F.col("ingested_at").cast("string"), stamp) if "ingested_at" in have else stamp).alias("ingested_at"))
        else:
            out.append((F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name))
    return rows.select(*out, *(["dt"] if "dt" in have else []))


_NUMBERS = ("open", "high", "low", "close", "volume")


def _checked_records(req: DataFrame) -> DataFrame:
    """Every record of the requests that can be read: dt, raw (its text) and the reason it cannot be used (null: it can)."""
    texts = F.from_json("payload", T.ArrayType(T.MapType(T.StringType(), T.StringType())))
    each = req.where(F.col("reason").isNull()).select("dt", F.explode(texts).alias("r"))

    def bad(name, kind, read):
        said = F.col("r")[name]
        return F.when(said.isNotNull() & read(said).isNull(), F.concat(F.lit(f"{name} is no {kind}: "), F.substring(said, 1, 50)))

    faults = [bad("date", "time", F.try_to_timestamp)]
    faults += [bad(n, "number", lambda c: c.try_cast("double")) for n in _NUMBERS]
    faults += [F.when(F.col("r")["symbol"].isNull(), "no symbol"), F.when(F.col("r")["date"].isNull(), "no date")]
    reason = F.concat_ws("; ", *faults)
    return each.select("dt", "r", F.when(reason != "", reason).alias("reason"))


def ingest_requests(df: DataFrame, body_col: str = "body", record_schema: T.StructType = PRICE_RECORD) -> tuple[DataFrame, DataFrame]:
    """Upload requests -> (rows of the raw layer with ``dt``, rejects with raw text and reason).

    Every request and every record is in one of the two: requests that lack
    something or do not parse, and records with a field of the wrong type, are
    rejects; nothing becomes NULL unsaid.
    """
    req = _upload_requests(df, body_col, record_schema)
    records = _checked_records(req)
    r = F.col("r")
    rows = records.where(F.col("reason").isNull()).select(
        F.to_timestamp(r["date"]).alias("date"),
        r["symbol"].alias("symbol"),
        *[r[n].cast("double").cast(record_schema[n].dataType).alias(n) for n in _NUMBERS],
        r["ingested_at"].alias("ingested_at"),
        F.date_format("dt", "yyyy-MM-dd").alias("dt"),
    )
    bad = records.where(F.col("reason").isNotNull()).select(F.to_json("r").alias("raw"), "reason")
    return to_raw(rows), req.where(F.col("reason").isNotNull()).select("raw", "reason").unionByName(bad)


_TUPLE_NAME = re.compile(r"^\(\s*'([^']*)'\s*,.*\)$")


def _level0(name: str) -> str:
    m = _TUPLE_NAME.match(name)
    return m.group(1) if m else name


def normalize_columns(
    df: DataFrame,
    symbol: str | Column | None = None,
    ingested_at: str | Column | None = None,
) -> DataFrame:
    """Lower-case column names, keep level 0 of two-level headers, stamp symbol and ingest time.

    ``symbol`` is a constant ticker or a Column over the renamed frame.
    ``ingested_at`` is an ISO-8601 string (or Column); it defaults to the
    current UTC time rendered as ISO-8601 text.
    """
    out = df.toDF(*[_level0(c).lower() for c in df.columns])
    if symbol is not None:
        out = out.withColumn("symbol", F.lit(symbol) if isinstance(symbol, str) else symbol)
    if ingested_at is None:
        ing = iso_utc_string(F.current_timestamp())
    elif isinstance(ingested_at, str):
        ing = F.lit(ingested_at)
    else:
        ing = ingested_at
    return out.withColumn("ingested_at", ing)


def union_all_sources(sources: Iterable[DataFrame], *, tag: str | None = None, require_rows: bool = True) -> DataFrame:
    """UNION ALL by column name in one pass; no job runs while the plan is built.

    The columns are those of all sources, empty ones too, so the schema does
    not depend on the data; missing columns are NULL. ``tag`` names a column
    with each row's source number (from 0). With ``require_rows``, running the
    plan raises an error if all sources are empty: a branch of its own, which
    gives no row, counts the sources' rows (for stored tables from their
    footers).
    """
    sources = list(sources)
    if not sources:
        raise ValueError("No sources.")
    tagged = [s.withColumn(tag, F.lit(k)) for k, s in enumerate(sources)] if tag else sources
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    if not require_rows:
        return out
    counts = reduce(lambda a, b: a.union(b), [s.agg(F.count(F.lit(1)).alias("n")) for s in sources])
    empty = counts.agg(F.sum("n").alias("n")).filter(F.col("n") == 0)
    raised = empty.select(F.raise_error(F.lit("No data fetched for any source.")).cast("string").alias("_e"))
    guard = raised.select(*[F.col("_e").cast(f.dataType).alias(f.name) if isinstance(f.dataType, T.AtomicType) else F.from_json("_e", f.dataType).alias(f.name) for f in out.schema.fields])
    return out.unionByName(guard)


def union_sources(sources: Iterable[DataFrame]) -> DataFrame:
    """UNION ALL by column name; missing columns are NULL.

    Empty sources are skipped (so their columns do not appear); if every
    source is empty a ``ValueError`` is raised. Emptiness is a ``LIMIT 1``
    probe per source; :func:`union_all_sources` has a fixed schema and no probes.
    """
    non_empty = [s for s in sources if not s.isEmpty()]
    if not non_empty:
        raise ValueError("No data fetched for any source.")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), non_empty)
