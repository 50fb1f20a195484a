"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query reads the driver tables (through :mod:`pricerisk.sources.fixtures`)
and runs one library operator over the whole input. Computed columns carry the
same names as the DuckDB texts in :mod:`pricerisk.plans.oracle_sql`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricerisk.functions.expressions import pct
from pricerisk.operators import alerts as al
from pricerisk.operators import correlation as corr
from pricerisk.operators import dedup as dd
from pricerisk.operators import portfolio as pf
from pricerisk.operators import returns as ret
from pricerisk.operators import risk
from pricerisk.operators import ticks as tk
from pricerisk.plans import marts
from pricerisk.session import fingerprint, scratch_path
from pricerisk.sinks import writers as sk
from pricerisk.sources import fixtures as fx
from pricerisk.sources import prices as src
from pricerisk.streaming import alerts_stream as stream_alerts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return deco


def _core_table(spark: SparkSession, bars: DataFrame, name: str, sf_dir: str, *tables: str) -> DataFrame:
    """The core daily table of some bars, as the layered build has it: built once for all marts.

    The table is published under the fingerprint of the files that the bars
    are read from, so the next query on the same files finds it, and changed
    files make a new one in its place.
    """
    files = [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in tables]
    where = hashlib.sha256(sf_dir.rstrip("/").encode()).hexdigest()[:12]
    return marts.build_core(bars, key=fingerprint(spark, *files), name=f"int_stock_daily_{name}_{where}")


def core_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _core_table(spark, fx.lineitem_bars(spark, sf_dir), "lineitem", sf_dir, "lineitem", "part")


def core_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _core_table(spark, fx.event_bars(spark, sf_dir), "events", sf_dir, "events")


@register("daily_bars")
def q_daily_bars(spark, sf_dir):
    return fx.event_bars(spark, sf_dir).drop("ingested_at")


@register("daily_returns")
def q_daily_returns(spark, sf_dir):
    return ret.daily_returns(fx.lineitem_bars(spark, sf_dir))


@register("daily_returns_events")
def q_daily_returns_events(spark, sf_dir):
    return ret.daily_returns(fx.event_bars(spark, sf_dir))


@register("risk_metrics")
def q_risk_metrics(spark, sf_dir):
    return risk.risk_metrics(core_lineitem(spark, sf_dir))


@register("risk_metrics_events")
def q_risk_metrics_events(spark, sf_dir):
    return risk.risk_metrics(core_events(spark, sf_dir))


@register("clean_returns")
def q_clean_returns(spark, sf_dir):
    return ret.clean_returns(core_lineitem(spark, sf_dir))


@register("drawdown_series")
def q_drawdown_series(spark, sf_dir):
    return ret.drawdown_series(core_lineitem(spark, sf_dir))


@register("max_drawdown")
def q_max_drawdown(spark, sf_dir):
    return risk.max_drawdown(core_lineitem(spark, sf_dir))


@register("var_95")
def q_var_95(spark, sf_dir):
    return risk.value_at_risk(core_lineitem(spark, sf_dir))


@register("var_95_window")
def q_var_95_window(spark, sf_dir):
    w = risk.var_95_window(core_lineitem(spark, sf_dir))
    return w.select("symbol", pct("var_95").alias("var_95_pct")).distinct()


@register("volatility")
def q_volatility(spark, sf_dir):
    return risk.volatility(core_lineitem(spark, sf_dir))


@register("sharpe_ratio")
def q_sharpe_ratio(spark, sf_dir):
    return risk.sharpe_ratio(core_lineitem(spark, sf_dir))


@register("latest_prices")
def q_latest_prices(spark, sf_dir):
    return pf.latest_prices(core_lineitem(spark, sf_dir))


@register("latest_price_per_symbol")
def q_latest_price_per_symbol(spark, sf_dir):
    return pf.latest_price_per_symbol(core_lineitem(spark, sf_dir))


@register("portfolio_summary")
def q_portfolio_summary(spark, sf_dir):
    return pf.portfolio_summary(core_lineitem(spark, sf_dir))


@register("portfolio_summary_events")
def q_portfolio_summary_events(spark, sf_dir):
    return pf.portfolio_summary(core_events(spark, sf_dir))


@register("return_pairs")
def q_return_pairs(spark, sf_dir):
    return corr.return_pairs(core_lineitem(spark, sf_dir))


@register("correlation_matrix")
def q_correlation_matrix(spark, sf_dir):
    return corr.correlation_matrix(core_lineitem(spark, sf_dir))


@register("correlation_matrix_events")
def q_correlation_matrix_events(spark, sf_dir):
    return corr.correlation_matrix(core_events(spark, sf_dir))


def _asked(spark, sf_dir):
    """Pairs asked for: every brand with Brand#7 (often the wrong way round), one with an unnamed side."""
    brand = fx.table(spark, sf_dir, "part").select(F.col("p_brand").alias("symbol_1")).distinct()
    return brand.withColumn("symbol_2", F.when(F.col("symbol_1") != "Brand#9", "Brand#7"))


def _unnamed(core):
    """``core`` with the rows of one symbol unnamed."""
    return core.withColumn("symbol", F.when(F.col("symbol") != "Brand#23", F.col("symbol")))


@register("return_pairs_asked")
def q_return_pairs_asked(spark, sf_dir):
    return corr.return_pairs(_unnamed(core_lineitem(spark, sf_dir)), _asked(spark, sf_dir))


@register("correlation_asked")
def q_correlation_asked(spark, sf_dir):
    """Correlations of the pairs asked for, in small tiles, with an unnamed symbol among the rows."""
    return corr.correlation_matrix(_unnamed(core_lineitem(spark, sf_dir)), pairs=_asked(spark, sf_dir), tile_size=4, block_days=366)


# --- ingest side -----------------------------------------------------------

HISTORY_START, HISTORY_END = "1998-01-01", "1999-01-01"  # one year of history, end exclusive


def part_universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Universe of lineitem symbols: every brand in the part table."""
    return fx.table(spark, sf_dir, "part").select(F.col("p_brand").alias("symbol")).distinct()


@register("stg_prices")
def q_stg_prices(spark, sf_dir):
    return src.stage_prices(fx.raw_price_rows(spark, sf_dir))


@register("raw_roundtrip")
def q_raw_roundtrip(spark, sf_dir):
    """Land raw rows in two dated runs (re-running the first), glob them back and stage them."""
    raw = fx.raw_price_rows(spark, sf_dir)
    cut = F.unix_micros(F.lit(fx.FIRST_RUN_DT).cast("timestamp")) * F.lit(1000)
    root = scratch_path(spark, "raw_roundtrip")
    first, second = raw.filter(F.col("date") < cut), raw.filter(F.col("date") >= cut)
    sk.write_raw(first, root, fx.FIRST_RUN_DT)
    sk.write_raw(second, root, fx.SECOND_RUN_DT)
    sk.write_raw(first, root, fx.FIRST_RUN_DT)  # re-run replaces that date's files
    return src.stage_prices(src.read_raw_prices(spark, f"{root}/{sk.RAW_PREFIX}"))


@register("normalize_columns")
def q_normalize_columns(spark, sf_dir):
    return src.normalize_columns(
        fx.vendor_frame(spark, sf_dir), symbol=F.col("ticker"), ingested_at=fx.STANDIN_INGESTED_AT
    )


@register("union_sources")
def q_union_sources(spark, sf_dir):
    return src.union_sources(fx.event_sources(spark, sf_dir))


@register("universe_filter")
def q_universe_filter(spark, sf_dir):
    return src.universe_filter(fx.event_bars(spark, sf_dir), src.universe(spark, fx.EVENT_UNIVERSE))


@register("load_history")
def q_load_history(spark, sf_dir):
    return src.load_history(
        fx.lineitem_bars(spark, sf_dir),
        part_universe(spark, sf_dir),
        HISTORY_START,
        HISTORY_END,
    )


SOME_SYMBOLS = ["S1", "S6", "NONE"]


@register("universe_filter_some")
def q_universe_filter_some(spark, sf_dir):
    """A universe that most symbols are not in, and one symbol of which has no bars."""
    return src.universe_filter(fx.event_bars(spark, sf_dir), src.universe(spark, SOME_SYMBOLS))


@register("load_history_some")
def q_load_history_some(spark, sf_dir):
    """History of the brands that have a large part: a universe read from a table."""
    large = fx.table(spark, sf_dir, "part").filter(F.col("p_partkey") % 400 == 0).select(F.col("p_brand").alias("symbol"))
    return src.load_history(fx.lineitem_bars(spark, sf_dir), large.distinct(), HISTORY_START, HISTORY_END)


@register("union_all_sources")
def q_union_all_sources(spark, sf_dir):
    return src.union_all_sources(fx.event_sources(spark, sf_dir), tag="source")


@register("ingest_to_staging")
def q_ingest_to_staging(spark, sf_dir):
    """Upload requests, some of them faulty, landed by run date with their rejects, read back and staged."""
    root = scratch_path(spark, "ingest")
    rows, rejects = src.ingest_requests(fx.faulty_requests(spark, sf_dir))
    sk.land_run(rows, rejects, root, "first")
    return src.stage_prices(src.read_raw_prices(spark, f"{root}/{sk.RAW_PREFIX}"))


@register("ingest_rejects")
def q_ingest_rejects(spark, sf_dir):
    """Reasons and numbers of the rejects of the same requests."""
    return src.reject_counts(src.ingest_requests(fx.faulty_requests(spark, sf_dir))[1])


@register("ingest_other_zone")
def q_ingest_other_zone(spark, sf_dir):
    """The same ingest in a session of another time zone: dates and stamps are UTC all the same."""
    other = spark.newSession()
    for k, v in {**spark.conf.getAll, "spark.sql.session.timeZone": "America/New_York"}.items():
        if other.conf.isModifiable(k):
            other.conf.set(k, v)
    return q_ingest_to_staging(other, sf_dir)


@register("records_from_json")
def q_records_from_json(spark, sf_dir):
    return src.records_to_prices(fx.price_payloads(spark, sf_dir), "payload")


@register("upload_requests")
def q_upload_requests(spark, sf_dir):
    return src.upload_requests_to_prices(fx.upload_requests(spark, sf_dir), "body")


@register("ingest_counts")
def q_ingest_counts(spark, sf_dir):
    return sk.ingest_counts(fx.raw_price_rows(spark, sf_dir))


@register("dedup_prices")
def q_dedup_prices(spark, sf_dir):
    return dd.dedup_prices(fx.duplicated_bars(spark, sf_dir))


@register("base_prices")
def q_base_prices(spark, sf_dir):
    return pf.base_prices(fx.lineitem_bars(spark, sf_dir), part_universe(spark, sf_dir))


@register("base_prices_trading_days")
def q_base_prices_trading_days(spark, sf_dir):
    """Base prices over the last five trading days, with a holiday week before the last day."""
    bars = fx.lineitem_bars(spark, sf_dir)
    last = bars.agg(F.max("date")).scalar()
    holiday = (F.col("date") < last) & (F.col("date") >= F.date_sub(last, 7))
    return pf.base_prices(bars.filter(~holiday), part_universe(spark, sf_dir), trading_days=True)


# --- ticks and alerts ----------------------------------------------------------

METRIC_DECIMALS = 6  # float statistics are reported with 6 dp
ALERT_WINDOW = "6 hours"  # event-time window of the windowed-alert query


def _alert_out(df: DataFrame, group: list[str]) -> DataFrame:
    return df.select(
        *group,
        "symbol",
        "alert_id",
        "alert_type",
        F.round("metric_value", METRIC_DECIMALS).alias("metric_value"),
        "threshold_value",
        "price_at_alert",
    )


@register("tick_parse")
def q_tick_parse(spark, sf_dir):
    return tk.parse_ticks(fx.tick_bodies(spark, sf_dir), "body")


@register("tick_change")
def q_tick_change(spark, sf_dir):
    t = fx.event_ticks(spark, sf_dir).select("symbol", "timestamp", "event_id", "price")
    return tk.tick_change(t)


@register("tick_change_rough")
def q_tick_change_rough(spark, sf_dir):
    """Tick change over a bursty symbol, ticks without a price and ticks without a symbol."""
    return tk.tick_change(fx.rough_ticks(spark, sf_dir))


@register("keyed_messages")
def q_keyed_messages(spark, sf_dir):
    t = fx.event_ticks(spark, sf_dir).select("symbol", "timestamp", "event_id", "price", "volume")
    return sk.to_keyed_messages(tk.tick_change(t))


@register("keyed_messages_exact")
def q_keyed_messages_exact(spark, sf_dir):
    """What a consumer reads from the messages: every digit of the numbers."""
    t = fx.event_ticks(spark, sf_dir).select("symbol", "timestamp", "event_id", "volume", (F.col("price") / 7e6).alias("price"))
    m = sk.to_keyed_messages(tk.tick_change(t), decimals=None)
    return m.select("key", F.from_json("value", "price double, prev_price double, volume long").alias("m")).select("key", "m.*")


@register("tick_change_seeded")
def q_tick_change_seeded(spark, sf_dir):
    """Tick change from the symbols' starting prices: the first tick of a symbol has a previous price."""
    t = fx.event_ticks(spark, sf_dir).select("symbol", "timestamp", "event_id", "price")
    symbols = src.universe(spark, fx.EVENT_UNIVERSE).filter(F.col("symbol") != "S5")
    base = symbols.select("symbol", (F.lit(100.0) + F.col("position")).alias("base_price"))
    return tk.tick_change(t, base=base)


@register("latest_tick")
def q_latest_tick(spark, sf_dir):
    return tk.latest_tick(fx.event_ticks(spark, sf_dir), ["batch", "symbol"])


@register("batch_metrics")
def q_batch_metrics(spark, sf_dir):
    m = tk.batch_metrics(fx.event_ticks(spark, sf_dir), "batch")
    r = lambda c: F.round(c, METRIC_DECIMALS).alias(c)
    return m.select(
        "batch", "symbol", r("volatility"), r("avg_price"), "max_price", "min_price", "current_price", "n_ticks"
    )


def _rule_query(rules):
    def q(spark, sf_dir):
        return _alert_out(al.batch_alerts(fx.event_ticks(spark, sf_dir), "batch", rules=rules), ["batch"])

    return q


register("alert_high_volatility")(_rule_query([al.HIGH_VOLATILITY]))
register("alert_price_drop")(_rule_query([al.PRICE_DROP]))
register("alert_price_anomaly")(_rule_query([al.PRICE_ANOMALY]))
register("alerts")(_rule_query(list(al.ALL_RULES)))


@register("windowed_alerts")
def q_windowed_alerts(spark, sf_dir):
    w = al.windowed_alerts(fx.event_ticks(spark, sf_dir), ALERT_WINDOW)
    return _alert_out(w, ["window_start", "window_end"])


def _day_folders(spark, sf_dir, *columns) -> str:
    """Ticks landed as day folders, one file for each day: a source for the stream queries."""
    path = scratch_path(spark, "stream_src")
    ticks = fx.event_ticks(spark, sf_dir).select(*columns, "batch")
    ticks.repartition("batch").write.mode("overwrite").partitionBy("batch").parquet(path)
    return path


@register("micro_batch_alerts")
def q_micro_batch_alerts(spark, sf_dir):
    """The alert stream itself: a day of ticks a trigger, its alerts written batch by batch and read back."""
    stream = stream_alerts.read_tick_stream(
        spark, "parquet", _day_folders(spark, sf_dir, "symbol", "price", "timestamp", "event_id"),
        schema="symbol string, price double, timestamp timestamp, event_id long, batch date",
        options={"maxFilesPerTrigger": "1"},
    )
    sink = scratch_path(spark, "micro_batch_alerts")
    q = stream_alerts.start_alert_stream(stream.drop("batch"), sink, available_now=True)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"stream failed: {q.exception()}")
    out = sk.read_alerts(spark, sink, view=None)
    return out.select(
        "symbol", "alert_type", F.round("metric_value", METRIC_DECIMALS).alias("metric_value"), "threshold_value", "price_at_alert"
    )


# --- streaming ----------------------------------------------------------------

STREAM_FILES_PER_TRIGGER = 8


@register("stream_state_alerts")
def q_stream_state_alerts(spark, sf_dir):
    """Ticks landed as day folders, streamed a few files per trigger into running
    (day, symbol) statistics; the alert rules run on the final statistics."""
    ticks = fx.event_ticks(spark, sf_dir).select("symbol", "price", "timestamp", "event_id", "batch")
    src_dir = scratch_path(spark, "stream_src")
    ticks.write.mode("overwrite").partitionBy("batch").parquet(src_dir)
    stream = stream_alerts.read_tick_stream(
        spark,
        "parquet",
        src_dir,
        schema="symbol string, price double, timestamp timestamp, event_id long, batch date",
        options={"maxFilesPerTrigger": str(STREAM_FILES_PER_TRIGGER)},
    )
    table = scratch_path(spark, "stream_stats")
    q = stream_alerts.start_state_stats_stream(stream, table, ("batch",), available_now=True)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"stream failed: {q.exception()}")
    return _alert_out(stream_alerts.alerts_from_stats(spark, table, ("batch",)), ["batch"])
