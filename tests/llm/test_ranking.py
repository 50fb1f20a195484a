import math
import random
import re
from collections import Counter

import numpy as np

from pricerisk.llm.ranking import Best, SharingDag, ranked_search
from tests.llm.helpers import ODD_TEXTS, clashing, documents

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=50):
    """(item_id, rank, doc_id, score) by the formula, document by document."""
    sized = [(i, Counter(terms(t))) for i, t in docs]
    sized = [(i, c, sum(c.values())) for i, c in sized if c]
    n_docs, length = len(sized), sum(n for _, _, n in sized)
    df = Counter(t for _, c, _ in sized for t in c)
    out = []
    for item_id, text in items:
        scored = []
        for i, c, n in sized:
            m = 50 + (50 * n * n_docs) // length
            s = 0
            for t in set(terms(text)):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    s += w * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item_id, r, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=lambda x: (str(x[0]), x[1:2], str(x)))


def items_table(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def rows_of(df):
    return sorted([(r.item_id, r.rank, r.doc_id, r.score) for r in df.collect()], key=lambda x: (str(x[0]), x[1:2], str(x)))


def make(seed, n_docs, n_items):
    rnd = random.Random(seed)
    pool = ["the", "The", "and", "of", "naïve", "don't", "x1", "日本", "a_b", "Über", *[f"w{k}" for k in range(60)]]
    weight = [30, 10, 20, 20, 2, 2, 2, 1, 2, 2, *[1 + 60 // (k + 1) for k in range(60)]]

    def text(lo, hi):
        return " ".join(rnd.choices(pool, weight, k=rnd.randint(lo, hi)))

    return [(k, text(0, 60)) for k in range(n_docs)], [(k, text(1, 25)) for k in range(n_items)]


def test_against_brute_force(spark):
    docs, items = make(5, 150, 30)
    docs += [(500 + k, docs[3][1]) for k in range(70)]  # a group of copies beyond k
    got = rows_of(ranked_search(clashing(documents(spark, docs)), clashing(items_table(spark, items))))
    assert got == brute(docs, items)


def test_blocks_of_items_give_the_same(spark):
    docs, items = make(6, 60, 20)
    d, t = documents(spark, docs), items_table(spark, items)
    assert rows_of(ranked_search(d, t, k=5, block_terms=90)) == rows_of(ranked_search(d, t, k=5)) == brute(docs, items, 5)


def test_odd_rows_and_empty_tables(spark):
    items = [(1, "plain words"), (2, None), (3, ""), (4, "... !"), (5, "long"), (None, "no id"), (1, "plain words"), (1, "endoftext é")]
    want = brute(ODD_TEXTS, [items[0], items[4], items[5], items[7]])
    got = ranked_search(documents(spark, ODD_TEXTS), items_table(spark, items))
    assert Counter((x[0], x[2], x[3]) for x in rows_of(got)) == Counter((x[0], x[2], x[3]) for x in want)
    assert ranked_search(documents(spark, []), items_table(spark, items)).collect() == []
    assert ranked_search(documents(spark, ODD_TEXTS), items_table(spark, [])).collect() == []
    assert ranked_search(documents(spark, [(1, None), (2, "-")]), items_table(spark, items)).collect() == []
    assert got.columns == ["item_id", "rank", "doc_id", "score"]


def test_shared_sums_are_added_once():
    rnd = random.Random(7)
    items = [set(rnd.sample(range(40), rnd.randint(1, 20))) for _ in range(50)]
    dag = SharingDag([set(x) for x in items], 40)
    assert dag.additions < 0.7 * dag.plain_additions
    acc = np.zeros((dag.n_rows, 6), dtype=np.int64)
    acc[:40] = np.random.default_rng(1).integers(0, 1000, (40, 6))
    want = np.array([acc[sorted(x)].sum(0) for x in items])
    assert (dag.combine(acc) == want).all()


def test_best_of_many_equal_scores():
    best = Best(2, 3)
    best.room = 10
    for lo in range(0, 100, 10):
        ids = np.arange(lo, lo + 10)[::-1]
        best.add(np.vstack([np.full(10, 7), ids * 0]), ids, (ids == 0).astype(np.int64))
    item, score, null, doc = best.settle()
    assert item.tolist() == [0, 0, 0] and doc.tolist() == [1, 2, 3] and set(score) == {7}


def test_no_task_ranks_a_whole_item(spark):
    docs, items = make(8, 40, 4)
    plan = ranked_search(documents(spark, docs), items_table(spark, items))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2
