"""Threshold alerts over per-batch (or per-window) price statistics (ST6-ST9, E3, E4).

The three rules are evaluated on every metrics row at once:
an array of ``(type, metric, threshold, fired)`` structs is filtered to the
fired ones and inlined, so each symbol yields 0-3 alert rows in one
projection, with no collect and no per-symbol job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricerisk.functions.expressions import positive_ratio
from pricerisk.operators.ticks import price_stats

# Fixed values that must equal the reference's (strict ">" comparisons).
VOLATILITY_THRESHOLD = 0.02
DROP_THRESHOLD = 0.03
ZSCORE_THRESHOLD = 2.0
HIGH_VOLATILITY = "HIGH_VOLATILITY"
PRICE_DROP = "PRICE_DROP"
PRICE_ANOMALY = "PRICE_ANOMALY"
ALL_RULES = (HIGH_VOLATILITY, PRICE_DROP, PRICE_ANOMALY)


def rule_metrics(metrics: DataFrame) -> DataFrame:
    """Add the three rule metrics to a statistics frame.

    * ``volatility_ratio = std / avg`` if ``avg > 0`` else 0 (std NULL -> 0);
    * ``drop_ratio = (max - current) / max`` if ``max > 0`` else 0;
    * ``zscore = |current - avg| / std`` only when ``std > 0``.

    ``current`` is the latest price, or the average when there is none.
    """
    vol = F.coalesce(F.col("volatility"), F.lit(0.0))
    avg = F.coalesce(F.col("avg_price"), F.lit(0.0))
    mx = F.coalesce(F.col("max_price"), F.lit(0.0))
    cur = F.coalesce(F.col("current_price"), avg)
    return (
        metrics.withColumn("_cur", cur)
        .withColumn("volatility_ratio", positive_ratio(vol, avg))
        .withColumn("drop_ratio", positive_ratio(mx - F.col("_cur"), mx))
        .withColumn("zscore", F.when(vol > 0, F.abs(F.col("_cur") - avg) / vol))
    )


def alerts(
    metrics: DataFrame,
    group: Sequence[str] = ("batch",),
    *,
    rules: Sequence[str] = ALL_RULES,
    triggered_at=None,
) -> DataFrame:
    """Alert rows from statistics rows (one per fired rule and symbol).

    Output: ``*group, symbol, alert_id, alert_type, metric_value,
    threshold_value, price_at_alert, triggered_at``. ``alert_id`` is the
    SHA-256 of ``group | symbol | type``, so replaying a batch reproduces the
    same ids. ``triggered_at`` defaults to the current time.
    """
    m = rule_metrics(metrics)
    spec = {
        HIGH_VOLATILITY: (F.col("volatility_ratio"), VOLATILITY_THRESHOLD),
        PRICE_DROP: (F.col("drop_ratio"), DROP_THRESHOLD),
        PRICE_ANOMALY: (F.col("zscore"), ZSCORE_THRESHOLD),
    }
    cands = [
        F.struct(
            F.lit(r).alias("alert_type"),
            spec[r][0].cast("double").alias("metric_value"),
            F.lit(float(spec[r][1])).alias("threshold_value"),
            F.coalesce(spec[r][0] > F.lit(spec[r][1]), F.lit(False)).alias("fired"),
        )
        for r in rules
    ]
    fired = F.filter(F.array(*cands), lambda a: a["fired"])
    ts = F.current_timestamp() if triggered_at is None else F.lit(triggered_at).cast("timestamp")
    group = list(group)
    out = m.select(*group, "symbol", F.col("_cur").alias("price_at_alert"), F.inline(fired))
    id_parts = [F.col(g).cast("string") for g in group] + [F.col("symbol"), F.col("alert_type")]
    return out.select(
        *group,
        "symbol",
        F.sha2(F.concat_ws("|", *id_parts), 256).alias("alert_id"),
        "alert_type",
        "metric_value",
        "threshold_value",
        "price_at_alert",
        ts.alias("triggered_at"),
    )


def batch_alerts(ticks: DataFrame, batch_col: str = "batch", *, rules: Sequence[str] = ALL_RULES, **kw) -> DataFrame:
    """Statistics per ``(batch, symbol)`` followed by :func:`alerts`."""
    stats = price_stats(ticks, [batch_col, "symbol"], **kw)
    return alerts(stats, [batch_col], rules=rules)


def windowed_alerts(
    ticks: DataFrame,
    window: str = "10 seconds",
    *,
    ts: str = "timestamp",
    rules: Sequence[str] = ALL_RULES,
    tiebreak: str | None = "event_id",
) -> DataFrame:
    """The same rules over event-time tumbling windows instead of arrival batches.

    Works on a static frame and on a watermarked stream alike; output carries
    ``window_start``/``window_end`` in place of the batch column.
    """
    w = ticks.withColumn("_w", F.window(F.col(ts), window))
    stats = price_stats(w, ["_w", "symbol"], ts=ts, tiebreak=tiebreak)
    stats = stats.withColumn("window_start", F.col("_w.start")).withColumn("window_end", F.col("_w.end")).drop("_w")
    return alerts(stats, ["window_start", "window_end"], rules=rules)
