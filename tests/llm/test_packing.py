import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from pricerisk.llm.packing import cut_points, fullest, minimum_bin_slack, pack_documents, placements
from tests.llm.helpers import ODD_TEXTS, clashing, documents

PATH = public_tokenizers.path("byte_bpe_50k.json")


def ids_of(text):
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t.encode(text or "", add_special_tokens=False).ids


def test_fullest_is_the_best_multiset():
    rnd = random.Random(3)
    for _ in range(200):
        items = [rnd.randint(1, 20) for _ in range(rnd.randint(0, 7))]
        room = rnd.randint(1, 40)
        counts = {x: items.count(x) for x in items}
        best = max(
            sum(c) for k in range(len(items) + 1) for c in itertools.combinations(items, k) if sum(c) <= room
        )
        got = fullest(counts, room)
        assert sum(x * k for x, k in got.items()) == best
        assert all(k <= counts[x] for x, k in got.items())


def test_patterns_use_every_piece_once():
    rnd = random.Random(5)
    hist = {x: rnd.randint(1, 500) * (1 + 600 // x) for x in rnd.sample(range(1, 1025), 500)}
    patterns = minimum_bin_slack(hist)
    used = defaultdict(int)
    for p, n in patterns:
        assert sum(x * k for x, k in p.items()) <= 1024
        for x, k in p.items():
            used[x] += k * n
    assert dict(used) == hist
    bins = sum(n for _, n in patterns)
    assert bins <= 1.01 * sum(x * n for x, n in hist.items()) / 1024 + 1
    assert len(placements(patterns)) < 20000


def test_cut_points():
    assert cut_points(1, 4) == [0]
    assert cut_points(4, 4) == [0]
    assert cut_points(5, 4) == [0, 1]
    assert cut_points(12, 4) == [0, 4, 8]


def test_pieces_and_places(spark):
    rows = pack_documents(clashing(documents(spark, ODD_TEXTS)), PATH).collect()
    want = []
    for i, t in ODD_TEXTS:
        ids = np.array(ids_of(t) + [2], dtype="<u4")
        starts = cut_points(len(ids), 1024)
        for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
            want.append((i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())))
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted((tuple(r)[:5] for r in rows), key=key) == sorted(want, key=key)
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(bins) == -(-sum(r.length for r in rows) // 1024)


def test_empty(spark):
    assert pack_documents(documents(spark, []), PATH).collect() == []
