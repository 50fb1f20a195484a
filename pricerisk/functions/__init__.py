"""Column-expression helpers (all JVM-side, no Python UDFs)."""

from pricerisk.functions.expressions import (  # noqa: F401
    ANNUALISATION_DAYS,
    epoch_ns_to_date,
    iso_utc_string,
    pct,
    pearson,
    positive_ratio,
    simple_return,
    tick_direction,
)
