import random
import re
import zlib

from pyspark.sql import functions as F

from pricerisk.llm.spelling import number_trie, variant_groups
from tests.llm.helpers import ODD_TEXTS, clashing, documents


def brute(docs):
    """(word, form, root, n, n_near, form_n) by the definition: every pair of words compared."""
    n = {}
    for doc_id, text in docs:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                n[run] = n.get(run, 0) + 1
    n = {w: c for w, c in n.items() if c >= 2}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    close = {w: [x for x in n if near(w, x)] for w in n}
    form = {}
    for w, others in close.items():
        if others:
            best = min(others, key=lambda x: (-n[x], x))
            if n[best] >= 10 * n[w]:
                form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return sorted((w, form.get(w) or "", root(w), n[w], len(close[w]), n[form[w]] if w in form else 0) for w in n)


def rows_of(df):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in df.collect())


def make(seed, n_words, n_docs):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abÀéz") for _ in range(rnd.randint(6, 9))) for _ in range(n_words)]
    docs = []
    for k in range(n_docs):
        own = []
        for _ in range(rnd.randint(0, 40)):
            w = words[int(rnd.random() ** 4 * n_words)]
            if rnd.random() < 0.15:
                at = rnd.randrange(len(w) + 1)
                w = rnd.choice([w[:at] + w[at + 1 :], w[:at] + rnd.choice("abÀéz") + w[at:], w[:at] + rnd.choice("ab") + w[at + 1 :]])
            own.append(rnd.choice([w, w.upper(), w.capitalize()]))
        docs.append((k, rnd.choice([" ", "-", "1", ", "]).join(own)))
    return docs


def test_against_brute_force(spark):
    docs = make(3, 60, 150)
    got = rows_of(variant_groups(clashing(documents(spark, docs))))
    want = brute(docs)
    assert got == want
    assert sum(1 for r in want if r[1]) > 5 and len(want) > 100


def test_chains_of_forms_and_repeated_letters(spark):
    counts = {"aaaaaaa": 4000, "aaaaaaab": 400, "aaaaaabb": 40, "aaaaabbb": 4, "aaaaaaaa": 390, "zaaaaaab": 3, "bbaaaabbb": 2}
    docs = []
    for w, c in counts.items():
        doc_id = next(k for k in range(len(docs), 999) if zlib.crc32(f"{k}:{w}".encode()) % 31)
        docs.append((doc_id, " ".join([w] * c)))
    got = {r[0]: r for r in rows_of(variant_groups(documents(spark, docs)))}
    assert sorted(got.values()) == brute(docs)
    assert got["aaaaabbb"][2] == "aaaaaaa" and got["aaaaabbb"][1] == "aaaaaabb"


def test_ties_go_to_the_smaller_word(spark):
    words = ["xabcdefg", "zabcdefg", "yabcdefg", "abcdefg"]
    # a document whose words are not disturbed
    doc_id = next(k for k in range(99) if all(zlib.crc32(f"{k}:{w}".encode()) % 31 for w in words))
    docs = [(doc_id, " ".join(words[:2] * 20 + words[2:] * 2))]
    got = {r[0]: r for r in rows_of(variant_groups(documents(spark, docs)))}
    assert sorted(got.values()) == brute(docs)
    assert got["yabcdefg"][1] == got["abcdefg"][1] == "xabcdefg" and got["abcdefg"][4] == 3


def test_odd_rows_and_empty_table(spark):
    rows = [*ODD_TEXTS, (10, "ÀÉÎõüÿ÷ ÀÉÎõüÿ÷"), (11, "q" * 30_000 + " " + "q" * 30_000 + " " + "q" * 29_999 + "x " + "q" * 29_999 + "x"), (None, "seldomly Seldomly")]
    got = rows_of(variant_groups(documents(spark, rows)))
    assert got == brute(rows)
    assert any(len(r[0]) >= 29_999 and r[4] == 1 for r in got)
    assert variant_groups(documents(spark, [])).collect() == []
    assert variant_groups(documents(spark, [(1, None), (2, "short"), (3, "onlyonce")])).collect() == []


def test_trie_numbers_are_equal_where_beginnings_are(spark):
    rnd = random.Random(9)
    words = sorted({"".join(rnd.choice("abé") for _ in range(rnd.randint(1, 9))) for _ in range(700)})
    rnd.shuffle(words)
    rows = number_trie(spark.createDataFrame([(w,) for w in words], "word string")).collect()
    assert [r.word for r in sorted(rows, key=lambda r: r.place)] == sorted(words)
    assert sorted(r.place for r in rows) == list(range(len(words)))
    node_of = {}
    for r in rows:
        assert len(r.nodes) == len(r.word) + 1
        for k, node in enumerate(r.nodes):
            assert node_of.setdefault(r.word[:k], node) == node
    assert len(set(node_of.values())) == len(node_of)
    # as one range, and with a range for every few words
    again = number_trie(spark.createDataFrame([(w,) for w in words], "word string").where(F.length("word") > 8)).collect()
    assert len(again) == sum(len(w) > 8 for w in words)
