
from pyspark.sql import functions as F

import corpus_pipeline
from corpus_pipeline import COLUMNS, STAGES
from pricerisk.llm.langid import identify
from pricerisk.llm.quality import judge
from tests.llm.helpers import ODD_TEXTS, clashing, documents
from tests.llm.test_lines import brute as line_brute
from tests.llm.test_simhash import plain_components, plain_fingerprint

SF = "/root/testdata/sf0.001"
BY_NAME = dict(STAGES)


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = {r.doc_id for r in judge(docs, labels).collect() if r.kept}
    out = BY_NAME["quality rules"](spark, docs, SF)
    assert out.columns == list(COLUMNS)
    assert sorted(r[0] for r in rows_of(out)) == sorted(kept) and kept

    known = {r.doc_id for r in identify(docs).collect() if r.lang_pred != "und" and r.score >= 0.5}
    out = BY_NAME["language ID"](spark, docs, SF)
    assert out.columns == list(COLUMNS)
    assert sorted(rows_of(out)) == sorted(r for r in rows_of(docs) if r[0] in known)
    assert len(known) > 190

    out = BY_NAME["line dedup"](spark, docs, SF)
    want = line_brute(rows_of(docs))
    assert sorted(rows_of(out)) == sorted((i, want[i, t][0]) for i, t in rows_of(docs))
    assert out.where(F.length("text") != F.col("n_chars")).count() == 0

    out = BY_NAME["SimHash near-dedup"](spark, docs, SF)
    items = sorted(rows_of(docs))
    parts = plain_components([(i, plain_fingerprint(t)) for i, t in items])
    assert sorted(r[0] for r in rows_of(out)) == sorted({c for c in parts})


def test_run(spark):
    out = corpus_pipeline.run(spark, SF).collect()
    assert out and {r.offset for r in out} and max(r.offset + r.length for r in out) <= 1024


def test_odd_rows_through_all_stages(spark, tmp_dir):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    none.write.mode("overwrite").parquet(f"{tmp_dir}/labels.parquet")
    docs = clashing(documents(spark, ODD_TEXTS))
    for name, stage in STAGES:
        rows = stage(spark, docs, tmp_dir)
        if name == "SimHash near-dedup":
            assert sorted(str(r.doc_id) for r in rows.collect()) == sorted(["1", "2", "8", "9", "None"])
        elif name == "line dedup":
            assert rows.count() == len(ODD_TEXTS)
        else:
            rows.collect()
        assert stage(spark, documents(spark, []), tmp_dir).collect() == []


def test_language_stage_without_a_model(spark, tmp_dir):
    stage = BY_NAME["language ID"]
    rows = [(k, f"clean words of document {k}", None) for k in range(1, 30)]
    rows += [(40, "12 !!", None), (41, None, None), (42, "", None), (None, "кириллица", None)]
    docs = documents(spark, rows)
    want = sorted(str(r[0]) for r in rows if r[0] not in (40, 41, 42))
    assert sorted(str(r.doc_id) for r in stage(spark, docs, tmp_dir).collect()) == want
    # labelled, but in the fold held out
    held = [r.doc_id for r in docs.where("crc32(cast(doc_id as string)) % 4 = 2 and doc_id < 40").collect()]
    few = stage(spark, documents(spark, [(k, "clean words", "en") for k in held]), tmp_dir)
    assert few.columns == list(COLUMNS) and held and sorted(r.doc_id for r in few.collect()) == sorted(held)
