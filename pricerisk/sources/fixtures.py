"""Stand-in inputs derived from the driver test tables.

These only reshape test tables into the schemas the library expects (ticks,
daily bars); they do none of the operators' work. The mappings are fixed:

* events -> ticks of ``EVENT_SYMBOL_COUNT`` symbols: symbol ``'S' || user_id % 8``,
  price = value, timestamp = ts (as TIMESTAMP), tie-break = event_id.
* events -> daily bars through the bar builder (:func:`daily_bars`).
* lineitem x part -> daily bars of one symbol per brand: open = low =
  min(extended price), close = high = max(extended price), volume =
  sum(quantity), date = ship date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricerisk.operators.bars import daily_bars

# The reference tracks 8 tickers; the events stand-in maps users
# onto the same number of symbols, named S0..S7.
EVENT_SYMBOL_COUNT = 8
# Fixed run timestamp used as `ingested_at` of stand-in bars, so outputs are
# reproducible.
STANDIN_INGESTED_AT = "2024-02-01T00:00:00+00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def event_symbol(user_id: str = "user_id"):
    return F.concat(F.lit("S"), (F.col(user_id) % EVENT_SYMBOL_COUNT).cast("string"))


def event_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks: symbol, price, timestamp, event_id, volume (props.k), batch (UTC day)."""
    ev = table(spark, sf_dir, "events")
    ts = F.col("ts").cast("timestamp")
    return ev.select(
        event_symbol().alias("symbol"),
        F.col("value").alias("price"),
        ts.alias("timestamp"),
        F.col("event_id"),
        F.from_json("props", "k bigint").getField("k").alias("volume"),
        F.col("ts").cast("date").alias("batch"),
    )


def rough_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks as they come in bad hours: symbol, price, timestamp, event_id.

    Half of all ticks are of one symbol, and most of those arrive in a few
    bursts (their times are cut to the day). Every 7th tick has no price, and
    every 11th no symbol.
    """
    ev = table(spark, sf_dir, "events")
    ts, hot = F.col("ts").cast("timestamp"), F.col("event_id") % 2 == 0
    return ev.select(
        F.when(F.col("event_id") % 11 == 0, None).when(hot, "HOT").otherwise(event_symbol()).alias("symbol"),
        F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("price"),
        F.when(hot & (F.col("event_id") % 10 != 0), F.date_trunc("day", ts)).otherwise(ts).alias("timestamp"),
        "event_id",
    )


def event_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily OHLCV bars of the 8 event symbols (one row per symbol and day)."""
    ticks = event_ticks(spark, sf_dir)
    bars = daily_bars(ticks, symbol="symbol", ts="timestamp", price="price", tiebreak="event_id")
    return bars.withColumn("ingested_at", F.lit(STANDIN_INGESTED_AT))


def lineitem_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars with one symbol per part brand, from lineitem x part.

    The join is left to the planner: part is broadcast when its measured size
    is under the broadcast threshold, otherwise both sides are shuffled on the
    part key (AQE splits a hot key).
    """
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_shipdate", "l_extendedprice", "l_quantity")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    j = li.join(part, li.l_partkey == part.p_partkey)
    return (
        j.groupBy(F.col("l_shipdate").cast("date").alias("date"), F.col("p_brand").alias("symbol"))
        .agg(
            F.min("l_extendedprice").alias("open"),
            F.max("l_extendedprice").alias("high"),
            F.min("l_extendedprice").alias("low"),
            F.max("l_extendedprice").alias("close"),
            F.sum("l_quantity").cast("long").alias("volume"),
        )
        .withColumn("ingested_at", F.lit(STANDIN_INGESTED_AT))
    )


# Fixed stand-in parameters for the ingest queries.
EVENT_UNIVERSE = [(f"S{i}", f"Event symbol {i}") for i in range(EVENT_SYMBOL_COUNT)]
PAYLOAD_RECORDS = 100  # records per JSON payload (one ingest response)
REINGEST_FROM = "2024-01-15"  # second landing run re-delivers days from here on
REINGEST_AT = "2024-02-02T00:00:00+00:00"
FIRST_RUN_DT = "2024-01-15"
SECOND_RUN_DT = "2024-01-31"


def raw_price_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw landed rows from events: ``date`` as epoch nanoseconds (BIGINT).

    Each event is one bar (open = high = low = close = value, volume =
    props.k), stamped with the fixed ingest time.
    """
    t = event_ticks(spark, sf_dir)
    return t.select(
        (F.unix_micros("timestamp") * F.lit(1000)).alias("date"),
        "symbol",
        F.col("price").alias("open"),
        F.col("price").alias("high"),
        F.col("price").alias("low"),
        F.col("price").alias("close"),
        "volume",
        F.lit(STANDIN_INGESTED_AT).alias("ingested_at"),
    )


def vendor_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event bars with vendor-style headers: capitalised, some as two-level tuples."""
    b = event_bars(spark, sf_dir)
    return b.select(
        F.col("date").alias("Date"),
        F.col("open").alias("('Open', 'ANY')"),
        F.col("high").alias("High"),
        F.col("low").alias("LOW"),
        F.col("close").alias("('Close', 'ANY')"),
        F.col("volume").alias("Volume"),
        F.col("symbol").alias("Ticker"),
    )


def event_sources(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """One source per event type, each exposing a different column subset."""
    ev = table(spark, sf_dir, "events")
    kinds = ["view", "click", "purchase", "error", "signup", "no_such_type"]
    shapes = {
        "view": ["event_id", "ts", "user_id", "event_type", "value"],
        "click": ["event_id", "ts", "user_id", "event_type", "props"],
        "purchase": ["event_id", "ts", "user_id", "event_type", "value", "props"],
        "error": ["event_id", "ts", "event_type"],
        "signup": ["event_id", "ts", "user_id", "event_type", "value"],
        "no_such_type": ["event_id", "event_type", "extra"],
    }
    out = []
    for k in kinds:
        cols = [c if c != "extra" else F.lit("x").alias("extra") for c in shapes[k]]
        out.append(ev.filter(F.col("event_type") == k).select(*cols))
    return out


def price_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON array-of-records payloads, ``PAYLOAD_RECORDS`` consecutive event ids each.

    Record dates are ISO-8601 strings with a UTC offset, as an HTTP ingest
    response carries them.
    """
    t = event_ticks(spark, sf_dir)
    rec = F.struct(
        F.concat(F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00")).alias("date"),
        F.col("symbol"),
        F.col("price").alias("open"),
        F.col("price").alias("high"),
        F.col("price").alias("low"),
        F.col("price").alias("close"),
        F.col("volume"),
        F.lit(STANDIN_INGESTED_AT).alias("ingested_at"),
    )
    return t.groupBy(F.floor(F.col("event_id") / PAYLOAD_RECORDS).alias("payload_id")).agg(
        F.to_json(F.collect_list(rec)).alias("payload")
    )


def duplicated_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event bars landed twice: a second run re-delivers the later days revised.

    The second run restates each day from ``REINGEST_FROM`` on with the close
    set to the day's mean tick price and a later ``ingested_at``.
    """
    first = event_bars(spark, sf_dir)
    ticks = event_ticks(spark, sf_dir)
    mean = ticks.groupBy("symbol", F.col("timestamp").cast("date").alias("date")).agg(
        F.round(F.avg("price"), 4).alias("mean_price")
    )
    second = (
        first.filter(F.col("date") >= F.lit(REINGEST_FROM).cast("date"))
        .join(mean, ["symbol", "date"])
        .withColumn("close", F.col("mean_price"))
        .withColumn("ingested_at", F.lit(REINGEST_AT))
        .drop("mean_price")
        .select(*first.columns)
    )
    return first.unionByName(second)


def tick_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broker-style messages: a binary JSON ``body`` per event tick.

    Bodies of ``error`` events are garbled (a non-JSON prefix), standing in
    for malformed messages on the wire.
    """
    ev = table(spark, sf_dir, "events")
    js = F.to_json(
        F.struct(
            event_symbol().alias("symbol"),
            F.col("value").alias("price"),
            F.concat(
                F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00")
            ).alias("timestamp"),
        )
    )
    body = F.when(F.col("event_type") == "error", F.concat(F.lit("garbled:"), js)).otherwise(js)
    return ev.select(F.col("event_id"), body.cast("binary").alias("body"))


def faulty_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The upload requests, every 7th of them not JSON, every 9th without a date, and every 20th with text for
    its first record's open.
    """
    r = upload_requests(spark, sf_dir)
    first = F.regexp_replace(F.col("body"), r'^(.*?open\\?":)[0-9.eE+-]+', "$1\"n/a\"")
    faulty = F.when(F.col("request_id") % 20 == 10, first).otherwise(F.col("body"))
    body = (
        F.when(F.col("request_id") % 7 == 6, F.concat(F.lit("<html>"), F.col("body")))
        .when(F.col("request_id") % 9 == 8, F.regexp_replace("body", r',"date":"[0-9-]{10}"}$', "}"))
        .otherwise(faulty)
    )
    return r.select("request_id", body.alias("body"))


def upload_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upload request bodies carrying price records and a run date.

    One request per ``PAYLOAD_RECORDS`` consecutive event ids. Even request
    ids send ``data`` as a JSON array, odd ones as that array serialised into
    a JSON string (both forms occur in practice). The run date is the day
    after the request's last record.
    """
    t = event_ticks(spark, sf_dir)
    rec = F.struct(
        F.concat(F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00")).alias("date"),
        F.col("symbol"),
        F.col("price").alias("open"),
        F.col("price").alias("high"),
        F.col("price").alias("low"),
        F.col("price").alias("close"),
        F.col("volume"),
        F.lit(STANDIN_INGESTED_AT).alias("ingested_at"),
    )
    g = t.groupBy(F.floor(F.col("event_id") / PAYLOAD_RECORDS).alias("request_id")).agg(
        F.sort_array(F.collect_list(rec)).alias("records"), F.date_add(F.max("batch"), 1).alias("run_date")
    )
    run = F.date_format("run_date", "yyyy-MM-dd").alias("date")
    as_array = F.to_json(F.struct(F.col("records").alias("data"), run))
    as_string = F.to_json(F.struct(F.to_json("records").alias("data"), run))
    body = F.when(F.col("request_id") % 2 == 0, as_array).otherwise(as_string)
    return g.select("request_id", body.alias("body"))
