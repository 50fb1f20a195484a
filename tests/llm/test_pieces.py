import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from pricerisk.llm.pieces import Vocabulary, decode_documents, encode_digest, encode_documents, product, states, through
from tests.llm.helpers import ODD_TEXTS, clashing, documents

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocab():
    return Vocabulary(PATH)


def sequential(v, text):
    """Best score and one best encoding of the whole text, place by place."""
    t = " " + text
    best, back = v.forward(t, 0, len(t))
    return best[len(t)], v.trace(t, back, 0, len(t))


def odd_text(rnd, n):
    marks = ["a", "b", "the", "ing", "tion", "é", "🙂", "▁", " ", " ", "  ", "\n", "\t", "0", "<0x0A>", "中"]
    return "".join(rnd.choice(marks) for _ in range(n))


def test_words_apart_equal_the_whole(vocab):
    rnd = random.Random(1)
    for _ in range(200):
        t = odd_text(rnd, 30)
        ids = vocab.whole(" " + t)
        assert vocab.score(ids) == sequential(vocab, t)[0]
        assert vocab.decode(ids) == t


def test_many_texts_at_once(vocab):
    rnd = random.Random(7)
    words = ["the", "tion,", "ing.", "a", "don't", "0x", "über!", "(ok)", "中", "b;c", "xq-", "\nnew", "x" * 30]
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 12))) for _ in range(300)]
    texts += ["", "a\nb", "\n", " a", "a  b", "a\tb", "a\n", "a \nb", *(odd_text(rnd, 30) for _ in range(200))]
    for t, ids in zip(texts, vocab.many(texts)):
        assert vocab.decode(b"" if not t else ids) == t
        if t:
            assert vocab.score(ids) == pytest.approx(sequential(vocab, t)[0], abs=1e-6)


def test_same_as_the_library_on_a_unigram_model(vocab):
    """The library's own Viterbi over the same pieces and scores, as far as ties and unknown characters allow."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    m = sentencepiece_model_pb2.ModelProto()
    with open(PATH, "rb") as f:
        m.ParseFromString(f.read())
    m.trainer_spec.model_type = 1  # unigram
    sp = sentencepiece.SentencePieceProcessor(model_proto=m.SerializeToString())
    rnd = random.Random(2)
    for _ in range(300):
        t = " ".join("".join(rnd.choice("etaoinshr") for _ in range(rnd.randint(1, 7))) for _ in range(6))
        own, theirs = np.frombuffer(vocab.whole(" " + t), dtype="<u4"), sp.encode(t)
        assert sp.decode(theirs) == t
        assert vocab.scores[own].sum() == vocab.scores[theirs].sum()


def test_matrix_against_plain_search(vocab):
    rnd = random.Random(3)
    for joint in (True, False):
        for _ in range(12):
            t = odd_text(rnd, 40)
            t = t.replace(" ", "x") if joint else t
            own = 20
            m = vocab.matrix(t, own)
            cut = vocab.edges(t, own)
            for a in range(0, vocab.longest, 3):
                if cut and a > cut[0]:  # no piece reaches over the end of a word
                    assert (m[a] == -np.inf).all()
                    continue
                best = vocab.forward(t, a, own)[0]
                for b in range(min(vocab.longest, len(t) - own + 1)):
                    assert m[a, b] == best[own + b]


def test_scan_is_associative_and_finds_states():
    rnd = np.random.default_rng(4)
    ms = [rnd.integers(-50, 0, (4, 4)).astype(float) for _ in range(7)]
    left = product(product(ms[0], ms[1]), ms[2])
    assert (left == product(ms[0], product(ms[1], ms[2]))).all()
    s = states(ms, 0, 0)
    row = np.full(4, -np.inf)
    row[0] = 0
    for m in ms:
        row = through(row, m)
    assert sum(m[a, b] for m, a, b in zip(ms, s, s[1:])) == row[0]


def test_giant_documents_in_chunks(spark, vocab):
    rnd = random.Random(5)
    rows = [(k, odd_text(rnd, 200)) for k in range(6)] + [(10, "internationalization" * 60), (11, "中é" * 300), (12, " " * 500)]
    rows += [(13, "ation" * 10 + " " + "x" * 90 + " end")]
    got = {r.doc_id: r for r in encode_documents(documents(spark, rows), PATH, chunk=40).collect()}
    for i, t in rows:
        best, _ = sequential(vocab, t)
        assert got[i].n_chunks == max(1, (len(t) + 1) // 40)
        assert vocab.decode(got[i].ids) == t
        assert got[i].score == vocab.score(got[i].ids) == best


def test_round_trip_of_odd_rows(spark, vocab):
    docs = clashing(documents(spark, ODD_TEXTS))
    encoded = encode_documents(docs, PATH, chunk=5000)
    back = sorted((str(r.doc_id), r.text) for r in decode_documents(encoded, PATH).collect())
    assert back == sorted((str(i), t or "") for i, t in ODD_TEXTS)
    rows = encode_digest(docs, PATH, chunk=5000).collect()
    assert len(rows) == len(ODD_TEXTS) and all(r.restored for r in rows)
    by = {r.doc_id: r for r in rows}
    assert by[8].n_chunks == 9 and by[2].n_pieces == by[3].n_pieces == 0
    ids = vocab.whole(" " + ODD_TEXTS[0][1])
    assert (by[1].n_pieces, by[1].ids_crc32) == (len(ids) // 4, zlib.crc32(ids))
    assert encode_digest(documents(spark, []), PATH).collect() == []
