import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pricerisk.llm import langid
from pricerisk.llm.common import tidy
from pricerisk.llm.ftrl import Ftrl, softmax, temperature
from pricerisk.llm.langid import document_frequencies, gram_buckets, grams_of, identify
from tests.llm.helpers import ODD_TEXTS, clashing, documents


def test_buckets_do_not_depend_on_neighbours():
    texts = ["Abc de", "", "12 !!", "é", "İstanbul's  word\n\nline", "x"]
    alone = [gram_buckets([t])[0] for t in texts]
    for a, b in zip(alone, gram_buckets(texts)):
        assert sorted(a.tolist()) == sorted(b.tolist())
    assert [len(a) for a in alone[1:3]] == [0, 0]
    # " abc de ": 5 letters, 7 pairs, 6 triples
    assert len(alone[0]) == 5 + 7 + 6


def test_ftrl_is_sparse_and_learns():
    rnd = np.random.default_rng(1)
    m = Ftrl(50, 2, alpha=0.5, l1=2.0, l2=0.1)
    for _ in range(1500):
        y = int(rnd.integers(2))
        noise = rnd.choice(np.arange(2, 50), 4, replace=False)
        m.learn(np.append([y], noise), np.ones(5), y)
    w = m.weights()
    assert w[0, 0] > 0.5 > w[0, 1] and w[1, 1] > 0.5 > w[1, 0]
    assert (w[2:50] == 0).mean() > 0.5


def test_temperature():
    rnd = np.random.default_rng(2)
    logits = rnd.normal(size=(4000, 3))
    labels = np.array([rnd.choice(3, p=p) for p in softmax(logits)])
    assert 0.9 < temperature(logits, labels) < 1.1
    assert 2.6 < temperature(3 * logits, labels) < 3.4
    assert temperature(np.zeros((0, 3)), np.zeros(0, dtype=int)) == 1.0


def test_held_out_accuracy(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = identify(df).join(df.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == df.count()
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    right = [r.lang == r.lang_pred for r in held]
    assert sum(right) / len(right) > 0.95
    confidence = sum(r.score for r in held) / len(held)
    assert abs(confidence - sum(right) / len(right)) < 0.08
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(spark):
    rnd = random.Random(1)
    learn = [(100 + k, " ".join(rnd.choice(["the", "and", "of"]) for _ in range(30)), "en") for k in range(40)]
    learn += [(200 + k, " ".join(rnd.choice(["der", "und", "ist"]) for _ in range(30)), "de") for k in range(40)]
    docs = documents(spark, [*learn, *((i, t, None) for i, t in ODD_TEXTS)])
    got = identify(clashing(docs)).collect()
    assert len(got) == 80 + len(ODD_TEXTS)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, set()).add((r.lang_pred, r.score))
    assert all(len(v) == 1 for v in by.values())
    assert by[2] == by[3] == by[7] == {("und", 0.0)}
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    assert sum(r.lang_pred == ("en" if r.doc_id < 200 else "de") for r in got if r.doc_id and r.doc_id >= 100) == 80
    # neither lang nor doc_id of a row decides its result
    swapped = identify(docs.withColumn("lang", F.when(F.col("doc_id") > 99, F.col("lang")).otherwise(F.lit("de")))
                       .where("doc_id > 99 or doc_id is null or doc_id in (2, 3)")).collect()
    assert {r.lang_pred for r in swapped if r.doc_id in (2, 3)} == {"und"}


def test_nothing_to_learn(spark):
    assert identify(documents(spark, [])).collect() == []
    rows = identify(documents(spark, [(1, "some words", None)])).collect()
    assert [(r.lang_pred, r.score) for r in rows] == [("und", 0.0)]


def test_every_language_is_learned(spark):
    rows = [(k, " ".join(["the of and"] * 5 + [str(k)]), "en") for k in range(200)]
    rows += [(1000 + k, "ja nein wohl doch", f"l{k}") for k in range(12)]
    seen = []
    from pricerisk.llm import langid

    was = langid.fit
    try:
        langid.fit = lambda learned, *a, **o: seen.extend(y for _, _, y in learned) or was(learned, *a, **o)
        model = langid.train(documents(spark, rows))
    finally:
        langid.fit = was
    assert len(model.langs) == 13 and set(seen) == set(range(13)) and seen.count(0) == 160


class Taken:
    """Stands for a DataFrame, and keeps the function that would run over its batches."""

    def mapInArrow(self, run, schema):
        self.run = run
        raise InterruptedError


def test_arrays_of_a_batch_stay_small():
    taken = Taken()
    with pytest.raises(InterruptedError):
        document_frequencies(taken)
    batch = pa.RecordBatch.from_pydict({"text": [f"{k} " + "Some words of one text. " * 100 for k in range(1000)]})
    list(taken.run([batch.slice(0, 1)]))  # the table of letters is made once
    tracemalloc.start()
    (counted,) = taken.run([batch])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert counted.to_pydict()["n"][-1] == 1000
    assert peak < 64 << 20  # 163 MiB when all of the 2.4 million characters had their arrays at once


def test_slices_give_the_same_buckets(monkeypatch):
    texts = ["", "Ein Satz.", "zwei  Wörter", "12", "x" * 300, "ab cd", "é"]
    whole = gram_buckets(texts)
    monkeypatch.setattr(langid, "SLICE", 150)
    parts = list(grams_of(texts))
    assert len(parts) == len(texts) and all((a == b).all() for a, b in zip(whole, parts))


def test_arrow_memory_goes_back_after_a_task(monkeypatch):
    released = []

    class Pool:
        def release_unused(self):
            released.append(True)

    monkeypatch.setattr(pa, "default_memory_pool", Pool)
    assert list(tidy(lambda batches: (b + 1 for b in batches))([1, 2])) == [2, 3] and len(released) == 1
    early = tidy(iter)([1, 2])
    assert next(early) == 1
    early.close()  # a task that is not read to its end
    assert len(released) == 2
