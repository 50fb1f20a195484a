"""Rank selection equals the built-in exact percentile, and no task holds a whole hot key."""

import random

import pytest
from pyspark.sql import functions as F

from pricerisk.operators.percentile import exact_percentile


def _values(spark):
    rnd = random.Random(5)
    rows = [("hot", round(rnd.gauss(0, 1), 3)) for _ in range(3000)] + [("hot", 0.0)] * 2000
    rows += [(f"k{i % 40}", round(rnd.uniform(-1, 1), 6)) for i in range(900)]
    rows += [("one", 4.5), ("same", 2.0), ("same", 2.0), ("same", 2.0), ("two", -1.0), ("two", 1.0), (None, 3.0), (None, 5.0)]
    rows += [("none", None), ("hot", None)]
    return spark.createDataFrame(rows, "symbol string, x double").repartition(5)


@pytest.mark.parametrize("p", [0.0, 0.05, 0.5, 0.937, 1.0])
@pytest.mark.parametrize("ranges", [1, 30])
def test_equals_the_built_in_percentile(spark, p, ranges):
    df = _values(spark)
    got = {r.symbol: r.q for r in exact_percentile(df, "symbol", "x", p, "q", ranges=ranges).collect()}
    want = {r.symbol: r.q for r in df.groupBy("symbol").agg(F.percentile("x", p).alias("q")).collect()}
    assert "none" not in got and want.pop("none") is None
    assert set(got) == set(want)
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_empty_input_and_wrong_p(spark):
    df = _values(spark)
    assert exact_percentile(df.filter("false"), "symbol", "x", 0.05, "q").collect() == []
    with pytest.raises(ValueError):
        exact_percentile(df, "symbol", "x", 5, "q")
