import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricerisk.llm.toxicity import SIZE, CharModel, character_model, decode, fold, gram_counts, judge_toxicity, restore, restored_words
from tests.llm.helpers import ODD_TEXTS, clashing, documents

WORDS = "idiot clown scum moron trash loser worthless pathetic disgusting stupid the there then of only this line day a".split()


@pytest.fixture(scope="module")
def costs():
    rnd = random.Random(1)
    return CharModel(gram_counts([" ".join(rnd.choice(WORDS) for _ in range(4000))])).table()


def test_gram_counts():
    n = gram_counts(["Ab", "é"]).reshape((SIZE,) * 4)
    assert n.sum() == 5  # a, b, end, e, end
    assert n[0, 0, 0, 1] == n[0, 0, 1, 2] == n[0, 1, 2, 0] == n[0, 0, 0, 5] == n[0, 0, 5, 0] == 1


def test_fold():
    assert fold("Éà") == "ea" and fold("ñß1") == "ns" and fold("ABC") == "abc"


@pytest.mark.parametrize(
    "token,word",
    [
        ("id1ot", "idiot"), ("Réeux,", "réeux"), ("1d10t", "idiot"), ("m0r0n", "moron"), ("$tupid", "stupid"), ("5cum", "scum"),
        ("w0rthle$$", "worthless"), ("p@thet!c", "pathetic"), ("tr4sh,", "trash"), ("l0s3r!", "loser"),
        ("stuuuupid", "stupid"), ("iiidiottt", "idiot"), ("c-l-o-w-n", "clown"), ("s.c.u.m", "scum"), ("mor*n", "moron"),
        ("STUPID!!", "stupid"), ("d1sgu5t1ng", "disgusting"), ("(lown", "clown"), ("there###", "there"), ("***", ""),
    ],
)
def test_restore(costs, token, word):
    plain = token.strip(".,!#").isalpha() and "uuuu" not in token and "iii" not in token
    assert restore(token, costs) == (word if plain or not word else "~" + word)


def test_decode_finds_the_least_cost(costs):
    """All readings of short tokens, priced one by one."""
    from itertools import product

    from pricerisk.llm.toxicity import lattice

    rnd = random.Random(4)
    for _ in range(60):
        token = "".join(rnd.choice("st1i0$*aa!") for _ in range(5))
        best = None
        for path in product(*lattice(token)):
            word, cost, h = "".join(x for x, _ in path), sum(p for _, p in path), 0
            for x in word:
                cost += costs[h][ord(x) - 96]
                h = (h * SIZE + ord(x) - 96) % SIZE**3
            cost += costs[h][0]
            best = min(best or (cost, word), (cost, word))
        word, h, got = decode(token, costs), 0, None
        assert len(word) == len(best[1]) and word == best[1], token


def test_spaced_letters(costs):
    found = restored_words("they said s t u p i d, and 1 d 1 0 t. a b, a c-l-o-w-n, o n l y a s c u m", costs, {})
    assert {"~stupid", "~idiot", "they", "and", "~clown", "~scum"} <= found


def test_held_out_and_disguised(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    hidden = {"idiot": "1d10t", "moron": "m0r0n", "stupid": "s t u p i d", "trash": "tr@sh", "clown": "c l o w n",
              "loser": "l0s3r", "scum": "$cum", "pathetic": "p4thet1c", "worthless": "w0rthle55", "disgusting": "disgussstting"}
    masked = F.col("text")
    for w, x in hidden.items():
        masked = F.replace(masked, F.lit(w), F.lit(x))
    toxic = labels.where("toxic = 1").select("doc_id")
    insult = "|".join(hidden)
    extra = docs.join(toxic, "doc_id").where(F.col("text").rlike(insult)).select((F.col("doc_id") + 10_000_000).alias("doc_id"), masked.alias("text"))
    rows = judge_toxicity(docs.union(extra), labels).collect()
    assert len(rows) == docs.count() + extra.count()
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    held = [(truth[r.doc_id], r.predicted) for r in rows if r.doc_id in truth and r.held_out]
    # some labels of junk texts are 1 without a word to show for it
    assert np.mean([t == p for t, p in held]) > 0.97
    assert np.mean([p for t, p in held if t == 1]) > 0.8
    assert np.mean([p for t, p in held if t == 0]) < 0.01
    plain = {r.doc_id for r in docs.join(toxic, "doc_id").where(F.col("text").rlike(insult)).collect()}
    assert np.mean([r.predicted for r in rows if r.doc_id in plain]) > 0.97
    assert np.mean([r.predicted for r in rows if r.doc_id >= 10_000_000]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)


def test_odd_rows_and_empty(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = judge_toxicity(clashing(documents(spark, ODD_TEXTS)), none).collect()
    assert len(rows) == len(ODD_TEXTS) and all(r.predicted == 0 for r in rows)
    some = spark.createDataFrame([(1, 0, 1), (3, 1, 0), (None, 0, 1), (4, 0, None), (1, 0, 0)], none.schema)
    rows = judge_toxicity(documents(spark, ODD_TEXTS), some).collect()
    assert len(rows) == len(ODD_TEXTS)
    assert judge_toxicity(documents(spark, []), none).collect() == []
    assert character_model(documents(spark, [])).cost.shape == (SIZE,) * 4


@pytest.mark.parametrize("token", ["you,idiot", "lazy/stupid", "ok.Moron", "clown-loser", "day|scum", "the—$tupid", "you!m0r0n", "a,b,trash"])
def test_words_without_a_space(costs, token):
    want = {"you,idiot": "idiot", "lazy/stupid": "stupid", "ok.Moron": "moron", "clown-loser": "loser", "day|scum": "scum",
            "the—$tupid": "~stupid", "you!m0r0n": "~moron", "a,b,trash": "trash"}
    assert want[token] in restored_words(f"so {token}.", costs, {})


def test_marks_end_words_in_the_lattice(costs):
    assert decode("m0ron,1diot", costs) == "moron idiot" and decode("scum|l0ser", costs) == "scum loser"
    assert decode("i.d.i.o.t", costs) == "idiot"


@pytest.mark.parametrize("token,word", [("stuupid", "stupid"), ("idiiot", "idiot"), ("Mooron!", "moron"), ("cloown,", "clown"),
                                        ("id**t", "idiot"), ("i***t", "idiot"), ("st**id", "stupid"), ("m*r*n", "moron")])
def test_doubled_letters_and_stars(costs, token, word):
    assert "~" + word in restored_words(token, costs, {})
    assert restored_words("loser the", costs, {}) == {"loser", "the"}


@pytest.mark.parametrize("token,word", [("ду-рак", "дурак"), ("дурак1", "дурак"), ("дураааак", "дурак"), ("он,Дурак!", "дурак"),
                                        ("дурраак", "дурак"), ("ηλί.θιε", "ηλίθιε"), ("मूर्ख", "मूर्ख"), ("मूर्ख।तुम", "मूर्ख"),
                                        ("โง่", "โง่"), ("أحمق2", "أحمق"), ("笨蛋，走", "笨蛋"), ("idiot,дурак", "дурак")])
def test_words_of_other_scripts(costs, token, word):
    assert word in restored_words(f"so {token} so", costs, {})
    assert "so" in restored_words(f"so {token} so", costs, {})


def test_other_scripts_are_learned(spark):
    rnd = random.Random(3)
    plain = "он она дом лес река день ночь как".split()
    rows = [(k, " ".join([*(rnd.choice(plain) for _ in range(20)), *(["ду-рак!"] if k % 2 else [])])) for k in range(200)]
    labels = spark.createDataFrame([(k, 1, k % 2) for k in range(150)], "doc_id long, quality int, toxic int")
    rows += [(300, "как он, дурак1"), (301, "как он, лес1")]
    got = {r.doc_id: r.predicted for r in judge_toxicity(documents(spark, rows), labels).collect()}
    assert all(got[k] == k % 2 for k in range(200)) and got[300] == 1 and got[301] == 0


def test_decode_of_long_tokens_is_linear_and_exact(costs, monkeypatch):
    import time

    import pricerisk.llm.toxicity as tx

    rnd = random.Random(8)
    token = "".join(rnd.choice("abstreidom013$5") for _ in range(120_000))
    took = []
    for n in (30_000, 120_000):
        start = time.perf_counter()
        decode(token[:n], costs)
        took.append(time.perf_counter() - start)
    assert took[1] < 12 * took[0] + 0.5
    with_settling = decode(token[:9000], costs)
    monkeypatch.setattr(tx, "SETTLE", 10**9)
    assert decode(token[:9000], costs) == with_settling


def test_runs_of_stars_of_any_length(costs):
    for n in (1, 2, 3, 17, 100, 20_000):
        word = decode("sc" + "*" * n + "um", costs)
        assert word.startswith("sc") and word.endswith("um") and len(word) < 20, n
    assert decode("mor*n", costs) == "moron" and decode("m***n", costs) == "moron"
    assert decode("x" + "*" * costs.most_stars, costs) == decode("x" + "*" * (costs.most_stars + 300), costs)


def test_steps_as_arrays_equal_steps_one_by_one(costs, monkeypatch):
    import pricerisk.llm.toxicity as tx

    rnd = random.Random(5)
    tokens = ["".join(rnd.choice("st1i0$*aa!|e") for _ in range(7)) for _ in range(40)]
    plain = [decode(t, costs) for t in tokens]
    monkeypatch.setattr(tx, "MANY", 1)
    assert [decode(t, costs) for t in tokens] == plain
    monkeypatch.setattr(tx, "SETTLE", 1)
    assert [decode(t, costs) for t in tokens] == plain


def test_doubled_letters_priced_one_by_one(costs):
    from pricerisk.llm.toxicity import decode_doubled

    rnd = random.Random(6)
    for _ in range(200):
        word = "".join(rnd.choice(["st", "uu", "p", "ii", "dd", "o", "mm", "an"]) for _ in range(5))
        if not any(word[k] == word[k + 1] == word[k + 2] for k in range(len(word) - 2)):
            assert decode_doubled(word, costs) == decode(word, costs)


def test_scores_of_texts_equal_scores_of_their_restored_words(costs):
    from pricerisk.llm.toxicity import Scorer

    rnd = random.Random(7)
    scorer = Scorer(None, {"idiot": 2.0, "scum": 1.5, "stup-": 1.0, "réeux": 0.5, "mor-": 0.2, "the": -0.5, "ид": 1.0, "a": 0.25}, -1.0)
    pool = ["1d10t", "id1ot,", "SCUM!!", "stuupid", "the.", "(the)", "Réeux", "r-é-e-u-x", "и.д", "a", "moor", "m o r o n", "lazy/stupid", "x" * 40, "s**m", "é"]
    for _ in range(60):
        text = " ".join(rnd.choice(pool) for _ in range(12))
        assert scorer.score_text(text, costs, {}) == scorer.score(restored_words(text, costs, {}))


def test_repeated_rows_of_a_labelled_document_are_one_row_of_the_sample(spark):
    rows = [(k, f"word{k % 7} idiot here" if k % 2 else f"word{k % 7} good here") for k in range(60)]
    labels = spark.createDataFrame([(k, 1, k % 2) for k in range(60)], "doc_id long, quality int, toxic int")
    once = judge_toxicity(documents(spark, rows), labels).collect()
    again = judge_toxicity(documents(spark, rows + [(1, f"other text {k}") for k in range(200)] + rows[3:4] * 500), labels).collect()
    assert {r.doc_id for r in once if r.predicted} == {r.doc_id for r in again if r.predicted and r.doc_id != 1} | {1}
