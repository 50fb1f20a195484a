import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pricerisk.llm import tokens
from pricerisk.llm.tokens import UnitEncoder


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_same_ids_as_the_library_on_whole_texts(name):
    path = public_tokenizers.path(name)
    rnd = random.Random(1)
    marks = list(" \n\t   \xa0ab'sé1#🙂\x1cć́İΣς　AZ.,") + ["'t ", "  ", "\n\n", "don't", " <|endoftext|>", "ABC", "word "]
    texts = ["".join(rnd.choice(marks) for _ in range(rnd.randint(0, 40))) for _ in range(1500)]
    texts += ["", " ", "\n", " a", "a ", "a\n\n", "x" * 5000, "Word, word.\nWord word."]
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    enc = UnitEncoder(path, max_units=50)
    for lo in range(0, len(texts), 100):
        some = texts[lo : lo + 100]
        for t, raw in zip(some, enc.encode(some)):
            assert np.frombuffer(raw, enc.dtype).tolist() == plain.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@pytest.mark.parametrize("places", [1, 7, 1 << 17])
def test_ids_gathered_in_any_number_of_places(monkeypatch, name, places):
    monkeypatch.setattr(tokens, "PLACES", places)
    path = public_tokenizers.path(name)
    rnd = random.Random(2)
    words = ["naïve", "Été,", "(so)", "end.", "a-b", "x1", "'s", "!!", "word", "word,", "word!?", "ÿ;", "×", "_", "don't", "Ωmega."]
    texts = [" ".join(rnd.choices(words, k=rnd.randint(1, 30))) for _ in range(200)]
    texts = [t.replace(" word ", "\nword ") for t in texts] + ["word", "", "word." * 3000, "w" * 40 + ","]
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    enc = UnitEncoder(path, max_units=20)
    for _ in range(2):
        for t, raw in zip(texts, enc.encode(texts)):
            assert np.frombuffer(raw, enc.dtype).tolist() == plain.encode(t, add_special_tokens=False).ids
