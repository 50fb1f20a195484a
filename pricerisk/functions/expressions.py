"""Scalar building blocks shared by the operators.

Each helper returns a ``Column`` made only of built-in expressions so it stays
inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for identical results.
ANNUALISATION_DAYS = 252  # trading days per year used for volatility and Sharpe
RETURN_DECIMALS = 6  # daily_return is rounded to 6 dp before any statistic
REPORT_DECIMALS = 4  # marts report percentages / ratios with 4 dp
NANOS_PER_SECOND = 1_000_000_000
# Tick direction markers: up, down, unchanged.
DIRECTION_UP = "↑"
DIRECTION_DOWN = "↓"
DIRECTION_FLAT = "-"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def epoch_ns_to_date(col) -> Column:
    """Epoch nanoseconds -> DATE.

    Integer-divides by 1e9 (truncating toward zero, as the staging view does)
    and counts whole UTC days, whatever the session time zone is.
    """
    secs = F.call_function("div", _c(col).cast("long"), F.lit(NANOS_PER_SECOND))
    midnight = secs - F.pmod(secs, F.lit(86_400))
    return F.date_from_unix_date(F.call_function("div", midnight, F.lit(86_400)).cast("int"))


def simple_return(close, prev_close, decimals: int = RETURN_DECIMALS) -> Column:
    """``round((close - prev) / nullif(prev, 0), decimals)`` on doubles."""
    c = _c(close).cast("double")
    p = _c(prev_close).cast("double")
    return F.round((c - p) / F.nullif(p, F.lit(0.0)), decimals)


def pct(col, decimals: int = REPORT_DECIMALS) -> Column:
    """Scale a ratio to percent and round."""
    return F.round(_c(col) * F.lit(100.0), decimals)


def positive_ratio(num, den) -> Column:
    """``num / den`` when ``den > 0`` else 0.0 (the alert rules' guard)."""
    d = _c(den)
    return F.when(d > 0, _c(num) / d).otherwise(F.lit(0.0))


def pearson(n, sx, sy, sxy, sx2, sy2, decimals: int = REPORT_DECIMALS) -> Column:
    """Pearson correlation from count and running sums.

    ``(n*Sxy - Sx*Sy) / nullif(sqrt(greatest((n*Sx2 - Sx^2)(n*Sy2 - Sy^2), 0)), 0)``.
    The clamp guards the product against tiny negative values produced by
    rounding (sqrt of those would be NaN); a zero-variance side gives NULL.
    """
    n, sx, sy, sxy, sx2, sy2 = (_c(v) for v in (n, sx, sy, sxy, sx2, sy2))
    num = n * sxy - sx * sy
    var_prod = (n * sx2 - sx * sx) * (n * sy2 - sy * sy)
    den = F.nullif(F.sqrt(F.greatest(var_prod, F.lit(0.0))), F.lit(0.0))
    return F.round(num / den, decimals)


def tick_direction(price, prev_price) -> Column:
    """Direction of a tick: up, down or unchanged (also when there is no previous price)."""
    p, q = _c(price), _c(prev_price)
    return (
        F.when(p > q, F.lit(DIRECTION_UP)).when(p < q, F.lit(DIRECTION_DOWN)).otherwise(F.lit(DIRECTION_FLAT))
    )


def utc_today() -> Column:
    """The current date in UTC, whatever the session's time zone."""
    return F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()).cast("date")


def iso_utc_string(ts) -> Column:
    """TIMESTAMP -> ISO-8601 text of its UTC time with microseconds and a ``+00:00`` offset."""
    utc = F.to_utc_timestamp(_c(ts).cast("timestamp"), F.current_timezone())
    return F.concat(F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
