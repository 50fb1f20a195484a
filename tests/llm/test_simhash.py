import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pricerisk.llm.simhash import anchors_of, components, fingerprint, links, near_duplicates
from tests.llm.helpers import ODD_TEXTS, clashing, documents


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or [" ".join(words)]
    hs = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(items):
    """doc_id -> smallest reachable, over (doc_id, fingerprint) pairs."""
    parent = list(range(len(items)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, a) in enumerate(items):
        for j in range(i):
            if (a ^ items[j][1]).bit_count() <= 2:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    big = float("inf")
    least = {}
    for i, (d, _) in enumerate(items):
        r = find(i)
        least[r] = min(least.get(r, big), big if d is None else d)
    return [None if least[find(i)] == big else least[find(i)] for i in range(len(items))]


def test_fingerprint():
    for t in ["", None, "One", "One two", "A b c d E f", "İ x\xa0y z É é\x1cq", "w " * 999]:
        assert fingerprint(t) == plain_fingerprint(t)


def test_anchors_cover_all_pairs():
    """The home of one is an anchor of the other, for all differences of at most 2 bits."""
    rnd = random.Random(7)
    base = [rnd.getrandbits(64) for _ in range(30)] + [0, 2**64 - 1]
    for fp in base:
        near = [fp ^ (1 << a) for a in range(64)] + [fp ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a)]
        fps = np.array([fp, *near], dtype=np.uint64).view(np.int64)
        row, anchor, home = anchors_of(fps)
        assert home.sum() == len(fps)
        at_home = {r: a for r, a in zip(row[home].tolist(), anchor[home].tolist())}
        mine = set(anchor[row == 0].tolist())
        assert all(at_home[k] in mine for k in range(1, len(fps)))
    many = np.array([rnd.getrandbits(64) for _ in range(2000)], dtype=np.uint64).view(np.int64)
    assert 55 < len(anchors_of(many)[0]) / 2000 < 67


def test_components_of_a_long_chain(spark):
    n = 300
    rnd = random.Random(3)
    names = list(range(n))
    rnd.shuffle(names)
    edges = [(max(a, b), min(a, b)) for a, b in zip(names, names[1:])] + [(1001, 1000), (1002, 1001)]
    got = {r.fp: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(n)}, 1000: 1000, 1001: 1000, 1002: 1000}


def test_links_are_stars(spark):
    rnd = random.Random(5)
    center = rnd.getrandbits(63)
    fps = [center] + [center ^ (1 << b) for b in range(60)]
    nodes = spark.createDataFrame([(f,) for f in fps], "fp long")
    edges = links(nodes).collect()
    assert len(edges) < 61 * 20  # all pairs within 2 bits would be 1830, seen from both ends 3660
    assert {r.root for r in components(links(nodes)).collect()} == {min(fps)}


def test_against_brute_force(spark):
    rnd = random.Random(11)
    words = [f"w{k}" for k in range(50)]
    rows = []
    for k in range(40):
        base = [rnd.choice(words) for _ in range(rnd.randint(1, 160))]
        for c in range(rnd.randint(1, 6)):
            copy = list(base)
            for _ in range(rnd.randint(0, 1)):
                copy[rnd.randrange(len(copy))] = "changed"
            rows.append((1000 - len(rows), " ".join(copy)))
    rows += ODD_TEXTS
    got = near_duplicates(clashing(documents(spark, rows))).collect()
    want = plain_components([(i, plain_fingerprint(t)) for i, t in rows])
    expected = sorted((str(i), f"{plain_fingerprint(t):016x}", str(c)) for (i, t), c in zip(rows, want))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == expected
    assert len({r.component_id for r in got}) < len(rows)


def test_nulls_only_and_empty(spark):
    assert [r.component_id for r in near_duplicates(documents(spark, [(None, "a"), (None, "a")])).collect()] == [None, None]
    assert near_duplicates(documents(spark, [])).collect() == []


def test_same_hash_as_spark(spark):
    df = spark.createDataFrame([("a b c",), ("é🙂 x " * 20,)], "t string")
    for r in df.select("t", F.xxhash64("t").alias("h")).collect():
        assert r.h % 2**64 == xxhash.xxh64(r.t.encode(), seed=42).intdigest()


@pytest.mark.parametrize("order", ["rising", "falling", "shuffled", "zigzag"])
def test_components_of_paths_in_few_rounds(spark, order, monkeypatch):
    import pricerisk.llm.simhash as sh

    n = 10_000
    names = list(range(n))
    if order == "falling":
        names.reverse()
    elif order == "shuffled":
        random.Random(4).shuffle(names)
    elif order == "zigzag":
        names = [x for pair in zip(names[: n // 2], reversed(names[n // 2 :])) for x in pair]
    rounds = []
    mates = sh._mates
    monkeypatch.setattr(sh, "_mates", lambda live: rounds.append(1) or mates(live))
    edges = [(max(a, b), min(a, b)) for a, b in zip(names, names[1:])]
    got = components(spark.createDataFrame(edges, "a long, b long")).groupBy("root").count().collect()
    assert [(r.root, r["count"]) for r in got] == [(0, n)]
    assert len(rounds) <= 14  # log2 of the nodes


def test_components_of_random_graphs(spark):
    rnd = random.Random(12)
    for n, m in ((30, 15), (200, 150), (300, 900)):
        edges = [(rnd.randrange(-n, n), rnd.randrange(-n, n)) for _ in range(m)]
        of = {x: {x} for e in edges for x in e}
        for a, b in edges:
            if of[a] is not of[b]:
                of[a] |= of[b]
                for x in of[b]:
                    of[x] = of[a]
        got = {r.fp: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
        linked = {x for a, b in edges if a != b for x in (a, b)}
        assert got == {x: min(of[x]) for x in linked}
