"""Token ids of whole texts by the ``tokenizers`` library, with a bounded memo.

Both public tokenizers cut a text before they merge anything: always where
white space begins, and between Latin letters and a run of punctuation that
ends a unit. So the ids of a text are the ids of its parts put end to end.
Parts repeat often; each worker keeps the ids of parts it has met and hands
only new ones to the library, many at a time. The memo is bounded: when a
table is full it becomes the old generation, and the one before goes.
"""

from __future__ import annotations

import os
import re
import string

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pricerisk.llm.common import worker_cache

#: Unicode White_Space (fixed values), as the tokenizers' patterns define it.
UNICODE_SPACE = (
    " \t\n\x0b\x0c\r\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
_S, _X = f"[{UNICODE_SPACE}]", f"[^{UNICODE_SPACE}]"
#: Any text: white space at the end; white space of two or more with what
#: follows; a space and a word; one line break; another single one and a word.
_UNITS = re.compile(f"{_S}+\\Z|{_S}{{2,}}{_X}+| {_X}+|\\n|{_S}?{_X}+")
#: White space that makes a text uneven: other than single spaces and line breaks.
_RARE = ("  ", "\n\n", " \n", "\n ", *(c for c in UNICODE_SPACE if c not in " \n"))
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
MARKS = string.punctuation
WORD_MARKS = re.compile(f"([{_LETTERS}]+)([{re.escape(MARKS)}]*)")
#: How vocabularies spell the space before a word, or its end (fixed values).
SPACE_SIGN, END_SIGN = "Ġ", "</w>"
#: Places of units whose ids are gathered at a time; more only for one longer text.
PLACES = 1 << 17
#: Units longer than this repeat too rarely to be worth keeping.
MEMO_UNIT = 16


def uneven(texts: list[str]) -> list[bool]:
    """For each text: has it white space other than single spaces and line breaks between words?"""
    together = "|".join(texts)
    met = [x for x in _RARE if x in together]
    return [bool(t) and (t[0] in " \n" or t[-1] in " \n" or any(x in t for x in met)) for t in texts]


class Memo:
    """A dict of two generations with at most ``limit`` values each."""

    def __init__(self, limit: int):
        self.limit = limit
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def missing(self, keys) -> list[str]:
        """Distinct keys without a value; those of the old generation move to the young one."""
        young, old = self.young, self.old
        new = []
        for k in keys:
            if k not in young:
                if k in old:
                    young[k] = old[k]
                else:
                    new.append(k)
        return new

    def turn(self) -> None:
        if len(self.young) >= self.limit:
            self.old, self.young = self.young, {}

    def values(self, keys: list[str], learn) -> list[bytes]:
        """The value of each of the distinct keys; ``learn`` gives those of keys not met before.

        Values of the old generation move to the young one.
        """
        young, old = self.young, self.old
        out = list(map(young.get, keys))
        new = []
        for i in [i for i, value in enumerate(out) if value is None]:
            if (value := old.get(keys[i])) is None:
                new.append(i)
            else:
                young[keys[i]] = out[i] = value
        for i, value in zip(new, learn([keys[i] for i in new])):
            out[i] = value
            if len(keys[i]) <= MEMO_UNIT:
                young[keys[i]] = value
        self.turn()
        return out


class UnitEncoder:
    """Ids of texts as raw little-endian arrays of ``dtype``."""

    def __init__(self, path: str, max_units: int = 250_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # the strings of special tokens are ordinary text in a document
        self.tokenizer.encode_special_tokens = True
        self.vocab = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2") if self.vocab <= 1 << 16 else np.dtype("<u4")
        self.memo = Memo(max_units)
        pieces = self.tokenizer.get_vocab().items()
        #: True at ids that end a word, or, where the vocabulary does not mark them, at ids that begin one.
        self.ends_known = any(piece.endswith(END_SIGN) for piece, _ in pieces)
        self.edge = np.zeros(self.vocab, dtype=bool)
        self.edge[[k for piece, k in pieces if (piece.endswith(END_SIGN) if self.ends_known else piece.startswith(SPACE_SIGN))]] = True
        self.line_break = self._plain(["\n"])["\n"]

    def _plain(self, parts: list[str]) -> dict[str, bytes]:
        out = {}
        for lo in range(0, len(parts), 256):
            some = parts[lo : lo + 256]
            for p, enc in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False)):
                out[p] = np.array(enc.ids, dtype=self.dtype).tobytes()
        return out

    def _words(self, words: list[str]) -> list[bytes]:
        """Words of Latin letters go to the library end to end, a space before each: each is one piece to merge."""
        out: list[bytes] = []
        width = self.dtype.itemsize
        for lo in range(0, len(words), 8000):
            some = words[lo : lo + 8000]
            (enc,) = self.tokenizer.encode_batch_fast([" " + " ".join(some)], add_special_tokens=False)
            ids = np.array(enc.ids, dtype=self.dtype)
            at = np.flatnonzero(self.edge[ids])
            edges = np.append(0, at + 1) if self.ends_known else np.append(at, len(ids))
            if len(edges) != len(some) + 1 or edges[0] != 0 or edges[-1] != len(ids):
                raise ValueError("a word was cut before merging")
            raw, edges = ids.tobytes(), (edges * width).tolist()
            out += [raw[a:b] for a, b in zip(edges, edges[1:])]
        return out

    def _others(self, keys: list[str]) -> list[bytes]:
        """Ids of units that are no word, named as :meth:`_values` names them."""
        # after a line break a unit goes on as a text of its own, unless white space follows
        after = {k: k[1:] for k in keys if k[0] == "\n" and len(k) > 1 and k[1] not in UNICODE_SPACE}
        plain = [after.get(k, k if k[0] == "\n" else " " + k) for k in keys]
        ids = self._plain(list(dict.fromkeys(plain)))
        return [self.line_break + ids[p] if k in after else ids[p] for k, p in zip(keys, plain)]

    def _values(self, units: pa.LargeStringArray) -> tuple[list[bytes], np.ndarray]:
        """Ids of parts of distinct units, and for each unit its two parts as indices into them.

        Units are without the space that stands before them; one that has none
        begins with a line break. The parts of a word of Latin letters are the
        word and the marks behind it; another unit is one part, and an empty one.
        """
        bare = pc.utf8_rtrim(units, characters=MARKS).dictionary_encode()
        is_word = pc.match_substring_regex(bare.dictionary, f"^[{_LETTERS}]+$")
        held, at = is_word.to_numpy(zero_copy_only=False), bare.indices.to_numpy()
        word = held[at]
        words = bare.dictionary.filter(is_word).to_pylist()
        others = units.filter(pa.array(~word)).to_pylist()
        first = np.where(word, (np.cumsum(held) - 1)[at], len(words) + np.cumsum(~word) - 1)
        values = self.memo.values(words, self._words) + self.memo.values(others, self._others)

        starts = np.frombuffer(units.buffers()[1], dtype=np.int64)[units.offset : units.offset + len(units) + 1]
        cut = starts[:-1] + pc.binary_length(bare.dictionary).to_numpy()[at]
        marked = np.flatnonzero(word & (cut < starts[1:]))
        # each word and what is behind it, as texts over the bytes of the units themselves
        edges = np.append(np.column_stack([starts[:-1], cut]).ravel(), starts[-1:])
        parts = pa.LargeStringArray.from_buffers(2 * len(units), pa.py_buffer(edges), units.buffers()[2])
        marks = parts.take(pa.array(2 * marked + 1)).dictionary_encode()
        known = self._plain(marks.dictionary.to_pylist())
        second = np.full(len(units), len(values))
        second[marked] += 1 + marks.indices.to_numpy()
        return [*values, b"", *known.values()], np.column_stack([first, second])

    def _even(self, texts: list[str]) -> list[bytes]:
        """Ids of even texts: each distinct unit is looked up once for all of them."""
        units, codes, ends = units_of(["\n" + t for t in texts])
        values, parts = self._values(units)
        cut = len(self.line_break)
        return [ids[cut:] for ids in put_together(values, parts[codes].ravel(), 2 * ends, self.dtype)]

    def _odd(self, texts: list[str]) -> list[bytes]:
        """Ids of texts with other white space, cut by a pattern."""
        cut = [_UNITS.findall(t) for t in texts]
        known, plain = [], []
        for u in {u for us in cut for u in us}:
            goes_on = len(u) > 1 and u[0] in " \n" and u[1] not in UNICODE_SPACE
            (known if goes_on else plain).append(u)
        ids = self._plain(plain)
        if known:
            values, parts = self._values(pa.array([u[1:] if u[0] == " " else u for u in known], pa.large_string()))
            ids.update((u, values[a] + values[b]) for u, (a, b) in zip(known, parts.tolist()))
        return [b"".join([ids[u] for u in us]) for us in cut]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text."""
        out: list[bytes] = [b""] * len(texts)
        odd = uneven(texts)
        for work in (self._even, self._odd):
            at = [i for i, t in enumerate(texts) if t and odd[i] == (work == self._odd)]
            if at:
                for i, ids in zip(at, work([texts[i] for i in at])):
                    out[i] = ids
        return out


def units_of(texts: list[str]) -> tuple[pa.LargeStringArray, np.ndarray, np.ndarray]:
    """Distinct units of texts cut at single spaces and before line breaks, the
    unit of each place as an index into them, and each text's end among the places.

    Units are without the space before them; one that has none begins with a
    line break or a text.
    """
    whole = pa.array([t[:1] + t[1:].replace("\n", " \n") for t in texts], pa.large_string())
    cut = pc.split_pattern(whole, " ")
    coded = cut.flatten().dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(), cut.offsets.to_numpy()[1:]


def coded_units(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """As :func:`units_of`, with a list of the distinct units."""
    units, codes, ends = units_of(texts)
    return units.to_numpy(zero_copy_only=False).tolist(), codes, ends


def put_together(values: list[bytes], codes: np.ndarray, ends: np.ndarray, dtype: np.dtype) -> list[bytes]:
    """The values of all places end to end, as one run of bytes for each text."""
    table = np.frombuffer(b"".join(values), dtype=dtype)
    sizes = np.fromiter(map(len, values), dtype=np.int64, count=len(values)) // dtype.itemsize
    first = np.cumsum(sizes) - sizes
    out = []
    # as many places at a time as keep the index arrays small, each cut at the end of a text
    lo = text = 0
    while text < len(ends):
        last = max(text + 1, int(np.searchsorted(ends, lo + PLACES, side="right")))
        some = codes[lo : ends[last - 1]]
        n = sizes[some]
        stop = np.cumsum(n)
        at = np.repeat(first[some] - (stop - n), n)
        at += np.arange(len(at))
        ids = table[at]
        edges = [0, *stop[ends[text:last] - lo - 1].tolist()]
        out += [ids[a:b].tobytes() for a, b in zip(edges, edges[1:])]
        lo, text = int(ends[last - 1]), last
    return out


def encoder(path: str) -> UnitEncoder:
    """The worker's encoder for a tokenizer file."""
    cache = worker_cache()
    key = ("encoder", path)
    if key not in cache:
        cache[key] = UnitEncoder(path)
    return cache[key]


def in_slices(values: list, limit: int = 2_500_000):
    """Index ranges of ``values`` (texts) of about ``limit`` characters each."""
    lo, size = 0, 0
    for i, v in enumerate(values):
        size += len(v) + 64
        if size >= limit:
            yield lo, i + 1
            lo, size = i + 1, 0
    if lo < len(values):
        yield lo, len(values)
