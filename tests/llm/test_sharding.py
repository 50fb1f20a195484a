import zlib
from collections import Counter

import pytest

from pricerisk.llm.sharding import rendezvous_shard, shard_documents
from tests.llm.helpers import ODD_TEXTS, clashing, documents


def test_digest_and_gapless_slots(spark):
    rows = shard_documents(clashing(documents(spark, ODD_TEXTS)), 3).collect()
    assert len(rows) == len(ODD_TEXTS)
    got = Counter((r.doc_id, r.size, r.text_crc32) for r in rows)
    want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in ODD_TEXTS)
    assert got == want
    for s in {r.shard for r in rows}:
        slots = sorted(r.slot for r in rows if r.shard == s)
        assert slots == list(range(len(slots)))
    assert len({r.shard for r in rows if r.doc_id == 4}) == 1


def test_one_more_shard_takes_rows_only_into_itself(spark):
    rows = shard_documents(documents(spark, [(i, "t") for i in range(4000)]), 40).collect()
    moved = [r for r in rows if r.grown_shard != r.shard]
    assert all(r.grown_shard == 40 for r in moved)
    assert 50 < len(moved) < 150
    sizes = Counter(r.shard for r in rows)
    assert len(sizes) == 40 and max(sizes.values()) < 150
    again = shard_documents(documents(spark, [(i, "t") for i in range(4000)]), 41).collect()
    assert {r.doc_id: r.shard for r in again} == {r.doc_id: r.grown_shard for r in rows}


def test_weights(spark):
    df = spark.range(6000).select(rendezvous_shard(__import__("pyspark").sql.functions.col("id"), [1, 0, 3]).alias("s"))
    n = Counter(r.s for r in df.collect())
    assert n[1] == 0 and 2.6 < n[2] / n[0] < 3.4
    with pytest.raises(ValueError):
        rendezvous_shard(df.s, [0, 0])


def test_empty(spark):
    assert shard_documents(documents(spark, []), 4).collect() == []
