"""Declared schemas of the data model (price bars, ticks, alerts)."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw landed price bar. `date` is epoch nanoseconds as written by pandas; it is
# read as a plain bigint so Spark does not refuse the INT64 TIMESTAMP(NANOS)
# physical type.
RAW_PRICE = T.StructType(
    [
        T.StructField("date", T.LongType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("volume", T.LongType()),
        T.StructField("ingested_at", T.StringType()),
    ]
)

# Staged bar: same columns with `date` as DATE.
PRICE_BAR = T.StructType(
    [T.StructField("date", T.DateType())] + [f for f in RAW_PRICE.fields if f.name != "date"]
)

# Tick message as produced (JSON body). Prices are doubles and `timestamp` is
# an ISO-8601 string parsed to TIMESTAMP.
TICK_MESSAGE = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("prev_price", T.DoubleType()),
        T.StructField("change_pct", T.DoubleType()),
        T.StructField("volume", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("source", T.StringType()),
    ]
)

# The fields the alert consumer reads from each tick body.
TICK = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

# Alert row; every column is NOT NULL.
ALERT = T.StructType(
    [
        T.StructField("alert_id", T.StringType(), False),
        T.StructField("symbol", T.StringType(), False),
        T.StructField("alert_type", T.StringType(), False),
        T.StructField("metric_value", T.DoubleType(), False),
        T.StructField("threshold_value", T.DoubleType(), False),
        T.StructField("price_at_alert", T.DoubleType(), False),
        T.StructField("triggered_at", T.TimestampType(), False),
    ]
)
