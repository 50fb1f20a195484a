"""Every registered query against its DuckDB oracle text (the driver's correctness gate)."""

import pytest

import __spark_entry__ as E
from pricerisk.plans.catalog import QUERIES as CATALOG
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare

QUERIES = E.queries()
ORACLE = E.oracle_sql()


def test_every_query_has_an_oracle():
    assert set(CATALOG) <= set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    ok, msg = compare(spark, QUERIES[name], ORACLE[name], SF_SMALL)
    assert ok, f"{name}: {msg}"


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:2] == ["symbol", "trading_days"]
