import math
import random

from pyspark.sql import functions as F

from pricerisk.llm.mtree import top_k_of_table
from tests.llm.helpers import clashing

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=20, every=20):
    kept = {}
    for i, v in rows:
        if i is None or v is None or any(c is None or not math.isfinite(c) for c in v):
            continue
        v = [math.floor(64 * float(c)) for c in v]
        kept[i] = min(kept.get(i, v), v)
    out = []
    for q in kept:
        if q % every:
            continue
        s = sorted((-sum(a * b for a, b in zip(kept[q], v)), i) for i, v in kept.items() if i != q)
        out += [(q, r + 1, i, -x) for r, (x, i) in enumerate(s[:k])]
    return sorted(out)


def rows_of(n, seed, dims=6):
    """Clusters, many exact copies and ties; float32 values so that Spark and Python agree."""
    import numpy as np

    rnd = random.Random(seed)
    centers = [[rnd.uniform(-1, 1) for _ in range(dims)] for _ in range(5)]
    rows = []
    for i in range(n):
        c = centers[0] if i % 3 == 0 else [x + rnd.gauss(0, 0.2) for x in rnd.choice(centers)]
        rows.append((i, [float(np.float32(x)) for x in c]))
    return rows


def run(spark, rows, **options):
    df = clashing(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA))
    return sorted(tuple(r) for r in top_k_of_table(df, **options).select("query_id", "rank", "vec_id", "score").collect())


def test_against_brute_force(spark):
    rows = rows_of(700, 1)
    assert run(spark, rows, n_nodes=9, page_rows=16, first_nodes=1) == brute(rows)


def test_odd_rows(spark):
    rows = rows_of(70, 2) + [(None, [1.0]), (140, None), (160, [1.0, None]), (180, [float("nan")]), (200, [float("inf")])]
    rows += [(220, []), (240, [0.5]), (40, [9.0] * 6), (40, [-9.0] * 6), (1001, [1e6, -1e6])]
    assert run(spark, rows) == brute(rows)


def test_few_and_none(spark):
    rows = rows_of(5, 3)
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []


def test_whole_small_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got = sorted(tuple(r) for r in top_k_of_table(df).select("query_id", "rank", "vec_id", "score").collect())
    assert got == brute(rows)
    assert df.where(F.col("vec_id") % 20 == 0).count() * 20 == len(got)
