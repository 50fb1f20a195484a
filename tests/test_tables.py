"""Durable tables: swapped in whole, found by later sessions, built once."""

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from pricerisk.operators import returns as ret
from pricerisk.plans import marts
from pricerisk.plans.catalog import QUERIES
from pricerisk.session import ensure_checkpoint_dir, fingerprint
from pricerisk.sinks import writers as sk
from pricerisk.sources import fixtures as fx
from tests.conftest import SF_SMALL


def test_a_new_version_is_swapped_in_and_old_ones_go(spark, tmp_dir):
    made = [sk.publish_table(spark.range(k + 1), "core", "t", base=tmp_dir, key=str(k)) for k in range(4)]
    assert made[-1].count() == made[3].count() == 4
    assert made[2].count() == 3  # a reader of the version before still has its files
    assert sum(n.startswith("v-") for n in os.listdir(os.path.join(tmp_dir, "core", "t"))) == 2
    assert sk.open_table(spark, "core", "t", base=tmp_dir).count() == 4
    assert sk.open_table(spark, "core", "t", base=tmp_dir, key="3").count() == 4
    assert sk.open_table(spark, "core", "t", base=tmp_dir, key="2") is None
    assert sk.open_table(spark, "core", "none", base=tmp_dir) is None
    assert spark.table("core_t").count() == 4


def test_a_failed_write_leaves_the_table_as_it_was(spark, tmp_dir):
    sk.publish_table(spark.range(3), "core", "f", base=tmp_dir)
    bad = spark.range(5).withColumn("x", F.when(F.col("id") == 4, F.raise_error(F.lit("no"))))
    with pytest.raises(PySparkException):
        sk.publish_table(bad, "core", "f", base=tmp_dir)
    assert sk.open_table(spark, "core", "f", base=tmp_dir).count() == 3
    assert spark.table("core_f").count() == 3


def test_a_table_may_be_made_from_its_own_present_version(spark, tmp_dir):
    now = sk.publish_table(spark.range(3), "core", "own", base=tmp_dir)
    assert sk.publish_table(now.union(now), "core", "own", base=tmp_dir).count() == 6


def test_another_session_reads_the_marts(spark, tmp_dir):
    m = marts.build_marts(fx.event_bars(spark, SF_SMALL), base=tmp_dir)
    other = spark.newSession()
    for name in marts.MART_TABLES:
        assert sk.open_table(other, "marts", name, base=tmp_dir).count() > 0
        assert other.table(f"marts_{name}").count() > 0
    found = sk.open_table(other, "marts", "mart_risk_metrics", base=tmp_dir)
    assert sorted(found.collect()) == sorted(m.risk_metrics.collect())


def test_core_is_built_once_for_the_same_prices(spark, tmp_dir):
    bars = fx.event_bars(spark, SF_SMALL)
    first = marts.build_core(bars, base=tmp_dir, key="a")
    again = marts.build_core(bars.limit(1), base=tmp_dir, key="a")
    assert again.inputFiles() == first.inputFiles()
    assert marts.build_core(bars.limit(1), base=tmp_dir, key="b").count() == 1


def test_repeated_queries_leave_no_new_folders(spark):
    root = os.path.join(ensure_checkpoint_dir(spark).replace("file:", "", 1), "pricerisk", "tables", "core")
    QUERIES["volatility"](spark, SF_SMALL).collect()
    before = {d: os.listdir(os.path.join(root, d)) for d in os.listdir(root)}
    QUERIES["risk_metrics"](spark, SF_SMALL).collect()
    QUERIES["volatility"](spark, SF_SMALL).collect()
    assert {d: os.listdir(os.path.join(root, d)) for d in os.listdir(root)} == before


def test_fingerprint_follows_the_files(spark, tmp_dir):
    path = os.path.join(tmp_dir, "x.parquet")
    spark.range(3).coalesce(1).write.parquet(path)
    one = fingerprint(spark, path)
    assert fingerprint(spark, path) == one
    spark.range(1).write.mode("append").parquet(path)
    assert fingerprint(spark, path) != one


def test_marts_are_ordered(spark):
    risk = [r.annual_volatility_pct for r in QUERIES["risk_metrics"](spark, SF_SMALL).collect()]
    assert len(risk) > 3 and risk == sorted(risk, reverse=True)
    symbols = [r.symbol for r in QUERIES["portfolio_summary_events"](spark, SF_SMALL).collect()]
    assert len(symbols) > 3 and symbols == sorted(symbols)
    corr = [r.correlation for r in QUERIES["correlation_matrix_events"](spark, SF_SMALL).collect()]
    assert corr == sorted(corr, key=lambda c: -2 if c is None else c, reverse=True)


def test_core_of_written_bars_equals_the_operator(spark, tmp_dir):
    bars = fx.lineitem_bars(spark, SF_SMALL)
    got = marts.build_core(bars, base=tmp_dir)
    assert sorted(got.collect(), key=str) == sorted(ret.daily_returns(bars).collect(), key=str)
