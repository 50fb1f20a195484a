import math
import random
import re

import pytest
from pyspark.sql import functions as F

from pricerisk.llm.quality import base_counts, binomial_tail, judge
from tests.llm.helpers import ODD_TEXTS, clashing, documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    win = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    rep = {p for i, x in enumerate(win) if win.count(x) > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(rep),
        len(w) < 50 or 100 * len(rep) > 50 * len(w),
    )


def test_base_counts_against_brute_force(spark):
    rnd = random.Random(4)
    rows = [(100 + k, "".join(rnd.choice(["a", "b", "é🙂", " ", " ", "\n", "\t", "#", "|"]) for _ in range(120))) for k in range(40)]
    rows += [(300, "a b c a b c a b c"), (301, "x " * 60), (302, "a b c d " + "q w e " * 30), *ODD_TEXTS[:7], ODD_TEXTS[8]]
    got = base_counts(clashing(documents(spark, rows)), "lang").collect()
    key = lambda x: str(x)
    cols = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted(((r.doc_id, *[r[c] for c in cols]) for r in got), key=key) == sorted(((i, *brute(t)) for i, t in rows), key=key)


def test_binomial_tail(spark):
    cases = [(0, 500, 0.0125), (3, 1000, 0.0125), (0, 1, 0.3), (5, 20, 0.3), (900, 100_000, 0.01), (7, 10, 0.3)]
    df = spark.createDataFrame(cases, "k long, n long, p double")
    for k, n, p in cases:
        got = df.where((F.col("k") == k) & (F.col("n") == n)).select(binomial_tail(F.col("k"), F.col("n"), p).alias("x")).first().x
        lg = math.lgamma
        want = sum(
            math.exp(lg(n + 1) - lg(j + 1) - lg(n - j + 1) + j * math.log(p) + (n - j) * math.log(1 - p)) for j in range(k + 1)
        )
        assert math.isclose(got, 1.0 if k >= n * p else want, rel_tol=1e-8), (k, n, p)


def test_cutoffs_keep_the_risk_and_reject_bad(spark):
    rnd = random.Random(1)
    rows, labels = [], []
    for k in range(2400):
        bad = k % 4 == 0
        words = [rnd.choice("alpha beta gamma delta".split()) + str(rnd.random()) + ("###" if bad else "") for _ in range(55)]
        rows.append((k, " ".join(words), "en" if k < 2300 else "xx"))
        labels.append((k, 0 if bad else 1, 0))
    out = judge(documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    kept = {r.doc_id: r.kept for r in out}
    good = [k for k in range(2300) if k % 4]
    assert sum(not kept[k] for k in good) <= 0.05 * len(good)
    assert not any(kept[k] for k in range(0, 2300, 4))
    # too few labels to certify anything in the small stratum
    assert all(kept[k] for k in range(2300, 2400))


def test_odd_rows_and_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    odd = spark.createDataFrame([(None, 0, 0), (1, None, None), (1, 0, 1), (1, 1, 1)], "doc_id long, quality int, toxic int")
    docs = clashing(documents(spark, [(*r, None) for r in ODD_TEXTS]))
    for labels in (none, odd):
        rows = judge(docs, labels).collect()
        assert len(rows) == len(ODD_TEXTS)
        assert all(r.kept == (not r.base_failed) for r in rows)
    assert judge(documents(spark, []), none).collect() == []


def test_joint_cutoffs_need_few_labels(spark):
    rnd = random.Random(6)
    word = lambda: rnd.choice("alpha beta gamma delta".split()) + str(rnd.random())
    rows, labels = [], []
    for k in range(1000):
        lang = "en" if k < 700 else "es" if k < 860 else "xx"
        bad = k % 8 == 0 or (lang == "xx" and k % 2)
        words = [word() + ("###" if bad else "") for _ in range(55)]
        # capitals are common in good documents of one language, and in a bad one
        words = [w.upper() for w in words] if lang == "es" and (k % 3 == 0 or k == 704) else words
        rows.append((k, " ".join(words), lang))
        labels.append((k, 0 if bad else 1, 0))
    docs, truth = documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    for joint in (False, True):
        kept = {r.doc_id: r.kept for r in judge(docs, truth, joint=joint).collect()}
        for lo, hi in ((0, 700), (700, 860), (860, 1000)):
            good = [k for k in range(lo, hi) if labels[k][1]]
            assert sum(not kept[k] for k in good) <= 0.05 * len(good)
        assert not any(kept[k] for k in range(0, 700, 8))
        # 140 good labels, and 61 that are too few for three strata
        assert [kept[k] for k in range(704, 860, 8)] == [not joint] * 20
        assert all(kept[k] for k in range(860, 1000))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    odd = clashing(documents(spark, [(*r, None) for r in ODD_TEXTS]))
    assert all(r.kept == (not r.base_failed) for r in judge(odd, none, joint=True).collect())


@pytest.mark.parametrize("joint", [False, True])
def test_copies_are_no_evidence(spark, joint):
    """Three good documents two hundred times over certify no more than the three."""
    rnd = random.Random(9)
    word = lambda: rnd.choice("alpha beta gamma delta".split()) + str(rnd.random())
    plain = lambda: " ".join(word() for _ in range(55))
    marked = lambda: " ".join(word() + "###" for _ in range(55))
    good = [(k, plain(), "en") for k in range(3)]
    bad = [(10 + k, marked(), "en") for k in range(3)]
    rows = good * 200 + bad * 200 + [(100 + k, marked(), None) for k in range(5)] + [(200 + k, marked(), "en") for k in range(20)]
    labels = spark.createDataFrame([(i, 1, 0) for i, *_ in good] + [(i, 0, 0) for i, *_ in bad], "doc_id long, quality int, toxic int")
    out = judge(documents(spark, rows), labels, joint=joint).collect()
    assert len(out) == len(rows) and all(r.kept for r in out)
    assert {r.stratum for r in out} == {"en", ""}


def test_the_row_that_stands_for_a_repeated_id_is_fixed(spark):
    rnd = random.Random(10)
    word = lambda: rnd.choice("alpha beta gamma delta".split()) + str(rnd.random())
    text = lambda mark: " ".join(word() + mark for _ in range(55))
    rows = [(k % 700, text("###" if k % 2 else ""), "en") for k in range(1400)]
    labels = spark.createDataFrame([(k, k % 3 > 0, 0) for k in range(700)], "doc_id long, quality boolean, toxic int").selectExpr(
        "doc_id", "int(quality) as quality", "toxic"
    )
    docs = documents(spark, rows)
    want = sorted((r.doc_id, r.kept, r.word_chars) for r in judge(docs, labels).collect())
    assert sorted((r.doc_id, r.kept, r.word_chars) for r in judge(docs.repartition(7), labels).collect()) == want
