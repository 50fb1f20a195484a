"""The ordered scan equals a plain per-key window for any number of ranges, and no task gets more than its share."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pricerisk.operators.scan import ordered_scan, range_borders, with_ranges, with_tie


def _data(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = rnd.choice(["hot"] * 6 + ["a", "b", "c"])  # one key holds ~2/3 of rows
        day = rnd.randint(0, 400)
        price = None if rnd.random() < 0.02 else round(rnd.uniform(1, 100), 2)
        rows.append((key, day, i, price))
    return spark.createDataFrame(rows, "k string, d int, id long, p double")


def _expected(df):
    w = Window.partitionBy("k").orderBy("d", "id")
    return df.select(
        "k",
        "d",
        "id",
        "p",
        F.lag("p").over(w).alias("prev"),
        F.max("p").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("runmax"),
        (F.row_number().over(w) == 1).alias("first"),
        F.last("p", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("known"),
    )


@pytest.mark.parametrize("ranges", [None, 1, 2, 7, 50, 1000])
def test_scan_matches_window(spark, ranges):
    df = _data(spark)
    got = ordered_scan(
        df, "k", ["d", "id"], "p", lag_as="prev", running_max_as="runmax", first_as="first", last_known_as="known", ranges=ranges
    )
    exp = _expected(df)
    a = sorted(got.select("k", "d", "id", "p", "prev", "runmax", "first", "known").collect(), key=str)
    b = sorted(exp.collect(), key=str)
    assert a == b


def test_no_range_holds_more_than_its_share(spark):
    """A bursty symbol: half of all rows, most of them within one second, many at one instant."""
    rnd = random.Random(3)
    rows = [("burst", 1_000_000 + rnd.randint(0, 3), i, float(i % 7)) for i in range(9000)]
    rows += [("burst", rnd.randint(0, 10**9), 9000 + i, 1.0) for i in range(1000)]
    rows += [(f"thin{i % 500}", rnd.randint(0, 10**9), 20_000 + i, 2.0) for i in range(10_000)]
    df = spark.createDataFrame(rows, "k string, d long, id long, p double").repartition(6)
    for ranges in (10, 100):
        groups = with_ranges(df, "k", ["d", "id"], ranges).groupBy("_scan_kc").count().collect()
        assert max(r["count"] for r in groups) <= 2 * len(rows) / ranges
        assert sum(r["_scan_kc"]["k"] == "burst" for r in groups) >= ranges // 2 - 1
    got = ordered_scan(df, "k", ["d", "id"], "p", lag_as="prev", running_max_as="runmax", ranges=40)
    assert sorted(got.collect(), key=str) == sorted(_expected(df).drop("first", "known").collect(), key=str)


def test_borders_do_not_depend_on_partitions_or_copies(spark):
    df = _data(spark)
    copies = df.unionByName(df.filter("id = 5")).unionByName(df.filter("id = 5"))
    seen = [
        d.select(range_borders(with_tie(d), "k", ["d", "id"], 9).alias("b")).first().b
        for d in (df.repartition(1), df.repartition(7), df.orderBy(F.desc("id")))
    ]
    assert seen[0] == seen[1] == seen[2] and len(seen[0]) == 8
    assert sorted(seen[0]) == seen[0]
    got = ordered_scan(copies, "k", ["d", "id"], "p", lag_as="prev", ranges=9)
    assert got.count() == copies.count()


def test_planning_runs_no_job(spark):
    df = _data(spark)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "planning")
    try:
        ordered_scan(df, "k", ["d", "id"], "p", lag_as="prev")
        assert list(tracker.getJobIdsForGroup("planning")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_only_keys_at_borders_are_summarised(spark):
    df = _data(spark)
    marked = with_ranges(df, "k", ["d", "id"], 6).filter("_scan_from or _scan_to").select("_scan_kc").distinct()
    split = with_ranges(df, "k", ["d", "id"], 6).select("_scan_kc").distinct().groupBy("_scan_kc.k").count().filter("count > 1")
    assert {r.k for r in split.collect()} <= {r["_scan_kc"]["k"] for r in marked.collect()}
    assert marked.count() <= 2 * 5


def test_empty_input_and_few_rows(spark):
    df = _data(spark)
    assert ordered_scan(df.filter("false"), "k", ["d"], "p", lag_as="prev").collect() == []
    one = ordered_scan(df.filter("id = 3"), "k", ["d"], "p", lag_as="prev", first_as="f", ranges=50).collect()
    assert [(r.prev, r.f) for r in one] == [(None, True)]


def test_scan_ties_are_deterministic(spark):
    rows = [("x", 1, 5.0), ("x", 1, 3.0), ("x", 2, 4.0), ("x", 2, 4.0)]
    df = spark.createDataFrame(rows, "k string, d int, p double")
    r1 = sorted(ordered_scan(df, "k", ["d"], "p", lag_as="prev", ranges=3).collect())
    r2 = sorted(ordered_scan(df.repartition(3), "k", ["d"], "p", lag_as="prev", ranges=3).collect())
    assert r1 == r2


def test_scan_null_keys_and_null_order(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(600):
        k = rnd.choice(["a", "b", None])
        d = None if rnd.random() < 0.1 else rnd.randint(0, 60)
        rows.append((k, d, i, round(rnd.uniform(0, 10), 2)))
    df = spark.createDataFrame(rows, "k string, d int, id long, p double")
    got = ordered_scan(df, "k", ["d", "id"], "p", lag_as="prev", running_max_as="runmax", ranges=12)
    exp = _expected(df).drop("first", "known")
    assert sorted(got.collect(), key=str) == sorted(exp.collect(), key=str)
