"""Toxicity behind a noisy channel.

Disguised words (leetspeak, letters set apart, letters repeated, marks put in
between) become a lattice: every character offers the letters it may stand
for, at a cost, or nothing, and a mark a word's end too. A token with marks
inside is read as a whole and in its parts. Words of other scripts have no
lattice; they count without marks, digits and repetitions. A Viterbi search finds the path of least cost
under a character language model. The model's counts are 4-grams of the folded
letters of every document, 27^4 numbers at any size of the corpus. The
restored text, not the written one, is then scored by a logistic regression
over words, trained on labelled rows by follow-the-regularised-leader with an
l1 penalty that leaves only the telling words.

The fit may see a bounded sample of labelled rows (``sample_rows``); counts of
the language model and scores cover all documents and whole texts.

Defined results: null and empty texts score like a text without a telling
word; rows without any label to learn from score 0; conflicting labels of a
doc_id count as toxic; of repeated rows of a labelled doc_id one is learned
from (a fixed one, by hash), and all score equally; very long tokens and runs
of stars are read whole, in time in proportion to their length; extra columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricerisk.llm.common import pick, worker_cache, written
from pricerisk.llm.ftrl import fit, softmax
from pricerisk.llm.langid import in_fold
from pricerisk.llm.tokens import in_slices

LETTERS = "abcdefghijklmnopqrstuvwxyz"
SIZE = len(LETTERS) + 1  # and 0, the edge of a word
ORDER = 4
SAMPLE_ROWS = 8000
MAX_WORDS = 3000
MIN_TOXIC_ROWS = 5
#: Features that begin alike in so many letters are looked for together.
HEAD = 4
#: Lengths of the beginnings of words that count as features of their own.
BEGINNINGS = (4, 5, 6, 7)

#: What a character may stand for (fixed values).
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "tl", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "{": "c", "€": "e", "£": "l", "¢": "c",
}
#: Costs in nats: a leet character read as a letter, a mark left out, a digit left out, a star read as some letter.
LEET_COST, MARK_COST, DIGIT_COST, STAR_COST = 0.4, 1.0, 6.0, 3.0
#: Cost of a word's end between letters set apart, beside the language model's.
GAP_COST = 1.0
#: From so many (state, choice) pairs in one step on, a step is computed as arrays.
MANY = 4000


def _combining() -> str:
    """Signs that belong to the letter before them (vowel signs, accents) and joiners, as a class of characters."""
    marks = [c for c in (*range(0x300, 0x20000), *range(0xE0100, 0xE01F0)) if unicodedata.category(chr(c))[0] == "M"]
    ends = [k for k in range(len(marks)) if k == 0 or marks[k] != marks[k - 1] + 1]
    spans = [(marks[a], marks[b - 1]) for a, b in zip(ends, [*ends[1:], len(marks)])]
    return "\u200c\u200d" + "".join(chr(a) + "-" + chr(b) for a, b in spans)


_STAR = [("", MARK_COST), *[(x, STAR_COST) for x in LETTERS]]
_SPACED = re.compile(r"(?<!\S)(?:\S(?:[ \t]{1,2}|[-_.])){2,}\S(?![^\s.,;:!?])")
_PUNCTUATION = ".,;:!?\"'`#%&*|~^=>)]}…“”„»«-_/\\"
_LEADING = ".,;:?\"'`#%&*~^=>)]}…“”„»«-_/\\["
_PLAIN = re.compile(r"[^\W\d_]+")
_RUN = re.compile(r"(.)\1\1")
_DOUBLED = re.compile(r"(.)\1")
_COMBINING = _combining()
_SIGN = re.compile(f"[{_COMBINING}]")
#: Where a token may be cut: at marks that are no letter's disguise, at those that are more often marks, at all.
_CUTS = [re.compile(rf"(?:[^\w{_COMBINING}{re.escape(but)}]|_)+") for but in ("@$!|+(<{€£¢*", "@$€£¢*", "")]

COUNTS = T.StructType([T.StructField("gram", T.IntegerType(), False), T.StructField("n", T.LongType(), False)])
SCORED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("held_out", T.BooleanType(), False),
        T.StructField("score", T.DoubleType(), False),
        T.StructField("predicted", T.IntegerType(), False),
    ]
)


def folded() -> np.ndarray:
    """Letter number (1 to 26) of every code point without its accents, 0 for all others."""
    cache = worker_cache()
    if "folded" not in cache:
        table = np.zeros(0x110000, dtype=np.int32)
        for c in range(0x2000):
            base = unicodedata.normalize("NFKD", chr(c))[0].casefold()[:1]
            if "a" <= base <= "z":
                table[c] = ord(base) - 96
        cache["folded"] = table
    return cache["folded"]


class _Folding(dict):
    """For ``str.translate``: a code point's letter without accents, or nothing."""

    def __missing__(self, code: int) -> str:
        k = int(folded()[code])
        letter = self[code] = LETTERS[k - 1] if k else ""
        return letter


_FOLDING = _Folding()


def fold(word: str) -> str:
    """Lower-case letters a to z of ``word`` without accents; other characters go."""
    if word.isascii() and word.isalpha():
        return word.lower()
    return word.translate(_FOLDING)


class _OtherLetters(dict):
    """Whether a character is a letter that does not fold to a to z."""

    def __missing__(self, c: str) -> bool:
        is_other = self[c] = c.isalpha() and not fold(c)
        return is_other


_OTHER = _OtherLetters()


def gram_counts(texts: list[str]) -> np.ndarray:
    """Counts of (history of up to three letters of the word, next letter or edge), as one array of 27^4."""
    code = np.frombuffer("\n".join(["", *texts, ""]).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    c = folded()[code].astype(np.int32)
    keep = np.ones(len(c), dtype=bool)
    keep[1:] = (c[1:] > 0) | (c[:-1] > 0)
    c = c[keep]
    if len(c) < 2:
        return np.zeros(SIZE**ORDER, dtype=np.int64)
    pad = np.concatenate((np.zeros(ORDER - 1, dtype=np.int32), c))
    h1, h2, h3 = pad[2:-1], pad[1:-2], pad[:-3]
    h2 = np.where(h1 > 0, h2, 0)
    h3 = np.where(h2 > 0, h3, 0)
    gram = ((h3 * SIZE + h2) * SIZE + h1) * SIZE + c
    return np.bincount(gram[1:], minlength=SIZE**ORDER)


class CharModel:
    """Interpolated 4-gram costs (-ln p) of a letter or a word's end (0) after up to three letters."""

    def __init__(self, counts: np.ndarray, strength: float = 5.0):
        n4 = counts.reshape((SIZE,) * ORDER).astype(np.float64)
        n3, n2, n1 = n4.sum(0), n4.sum((0, 1)), n4.sum((0, 1, 2))
        p = (n1 + 1) / (n1.sum() + SIZE)
        p = (n2 + strength * p) / (n2.sum(1, keepdims=True) + strength)
        p = (n3 + strength * p) / (n3.sum(2, keepdims=True) + strength)
        p = (n4 + strength * p) / (n4.sum(3, keepdims=True) + strength)
        self.cost = (-np.log(p)).astype(np.float32)

    def table(self) -> "Costs":
        """Rows of 27 costs by history number: plain lists are quickest for single look-ups."""
        return Costs(self.cost.reshape(-1, SIZE).tolist())


class Costs(list):
    """Rows of 27 costs by history number."""

    def __init__(self, rows: list[list[float]]):
        super().__init__(rows)
        self.array = np.array(rows, dtype=np.float64)
        # A star read as a letter costs at least STAR_COST - MARK_COST more than one that is nothing, and can
        # make no more than the three letters behind the run cheaper, each by the largest cost at most.
        self.most_stars = int(3 * self.array.max() / (STAR_COST - MARK_COST)) + 1


def lattice(token: str, most_stars: int | None = None) -> list[list[tuple[str, float]]]:
    """For each character, or run of one, the letters it may give and the cost of each.

    White space within ``token`` (letters set apart) and marks are nothing or a
    word's end. Each star of a run is a letter or nothing; ``most_stars`` is
    how many of a run can be letters on a path of least cost, so that the
    others, whichever they are, are nothing.
    """
    out: list[list[tuple[str, float]]] = []
    k = 0
    while k < len(token):
        c = token[k]
        end = k
        while end < len(token) and token[end] == c:
            end += 1
        run = end - k
        k = end
        letter = fold(c)
        if c.isspace():
            out.append([("", 0.0), (" ", GAP_COST)])
        elif letter:
            if run == 1:
                out.append([(letter, 0.0)])
            else:  # a run is one letter or two
                out.append([(letter, 0.2 if run > 2 else 0.7), (letter * 2, 0.0 if run == 2 else 0.9)])
        elif c in LEET:
            choices = []
            for x in LEET[c]:
                choices.append((x, LEET_COST))
                if run > 1:
                    choices.append((x * 2, LEET_COST + 0.5))
            choices.append(("", DIGIT_COST if c.isdigit() else MARK_COST))
            if c == "|":
                choices.append((" ", GAP_COST))
            out.append(choices)
        elif c == "*":
            free = run if most_stars is None else min(run, most_stars)
            if run > free:
                out.append([("", MARK_COST * (run - free))])
            out += [_STAR] * free
        elif c.isdigit():
            out.append([("", DIGIT_COST)])
        elif _SIGN.match(c) or c.isalnum():
            out.append([("", MARK_COST)])
        else:
            out.append([("", MARK_COST), (" ", GAP_COST)])
    return out


def _many_step(states: dict, choices: list[tuple[str, float]], costs: Costs) -> dict:
    """One step of ``decode`` over all 27^3 histories at once."""
    rest = SIZE * SIZE  # histories that differ in their oldest letter alone become one
    start = np.full(SIZE**3, np.inf)
    start[np.fromiter(states, dtype=np.int64, count=len(states))] = [s[0] for s in states.values()]
    best, origin, chosen = np.full(SIZE**3, np.inf), np.zeros(SIZE**3, dtype=np.int64), np.zeros(SIZE**3, dtype=np.int64)
    for k, (letters, price) in enumerate(choices):
        total, source = start + price, np.arange(SIZE**3)
        for x in letters:
            code = ord(x) - 96 if x != " " else 0
            total = total + costs.array[:, code]
            now, came = np.full(SIZE**3, np.inf), np.zeros(SIZE**3, dtype=np.int64)
            if code:
                at = total.reshape(SIZE, rest).argmin(0) * rest + np.arange(rest)
                to = np.arange(rest) * SIZE + code
            else:
                at, to = np.array([total.argmin()]), np.array([0])
            now[to], came[to] = total[at], source[at]
            total, source = now, came
        better = total < best
        best[better], origin[better], chosen[better] = total[better], source[better], k
    out = {}
    held = np.flatnonzero(np.isfinite(best))
    for h, cost, before, k in zip(held.tolist(), best[held].tolist(), origin[held].tolist(), chosen[held].tolist()):
        node, letters = states[before][1], choices[k][0]
        out[h] = (cost, (letters, node) if letters else node)
    return out


def _written_down(node) -> str:
    """The letters on the path that ends in ``node``: links of (letters, node before)."""
    parts = []
    while node is not None:
        parts.append(node[0])
        node = node[1]
    return "".join(reversed(parts))


def _settled(states: dict) -> tuple[str, dict]:
    """The letters that all paths have in common from their beginning, and the states without them."""
    paths = []
    for cost, node in states.values():
        path = []
        while node is not None:
            path.append(node)
            node = node[1]
        paths.append(path[::-1])
    n = 0
    for nodes in zip(*paths):
        if any(x is not nodes[0] for x in nodes):
            break
        n += 1
    if not n:
        return "", states
    out = {}
    for (h, (cost, _)), path in zip(states.items(), paths):
        node = None
        for letters, _before in path[n:]:
            node = (letters, node)
        out[h] = (cost, node)
    return "".join(x[0] for x in paths[0][:n]), out


#: Steps after which a decoder writes down what its paths have in common.
SETTLE = 2000


def decode(token: str, costs: Costs) -> str:
    """The letters of least cost that ``token`` may stand for: Viterbi over histories of three letters.

    A state keeps its cost and a link to the state before it. What all paths
    agree on is written down from time to time, so long tokens take time and
    memory in proportion to their length.
    """
    states: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}
    done: list[str] = []
    for step, choices in enumerate(lattice(token, costs.most_stars)):
        if len(states) * len(choices) > MANY:
            states = _many_step(states, choices, costs)
        else:
            after: dict[int, tuple[float, tuple | None]] = {}
            for history, (cost, node) in states.items():
                for letters, price in choices:
                    h, total = history, cost + price
                    for x in letters:
                        code = ord(x) - 96 if x != " " else 0
                        total += costs[h][code]
                        h = (h * SIZE + code) % SIZE**3 if code else 0
                    old = after.get(h)
                    if old is None or total < old[0]:
                        after[h] = (total, (letters, node) if letters else node)
            states = after
        if step % SETTLE == SETTLE - 1:
            text, states = _settled(states)
            done.append(text)
    ends = [(cost + costs[h][0], node) for h, (cost, node) in states.items()]
    least = min(cost for cost, _ in ends)
    return "".join(done) + min(_written_down(node) for cost, node in ends if cost == least)


def decode_doubled(word: str, costs: Costs) -> str:
    """``decode`` of a plain word without accents whose runs are of two letters: every spelling is priced."""
    spellings = [(0.0, 0, "")]
    k = 0
    while k < len(word):
        code = ord(word[k]) - 96
        run = 2 if word[k : k + 2] == word[k] * 2 else 1
        k += run
        out = []
        for total, h, text in spellings:
            if run == 2:
                out.append((total + 0.7 + costs[h][code], (h * SIZE + code) % SIZE**3, text + word[k - 1]))
            total = total + costs[h][code]
            h = (h * SIZE + code) % SIZE**3
            if run == 2:
                total, h = total + costs[h][code], (h * SIZE + code) % SIZE**3
            out.append((total, h, text + word[k - run : k]))
        spellings = out
    return min((total + costs[h][0], text) for total, h, text in spellings)[1]


def restore(token: str, costs: Costs) -> str:
    """The word that a token without white space stands for; '' without any letter from a to z.

    A plain word is itself in lower case, accents and all. A disguised one is
    the letters decoded, which have no accents, behind a tilde; there may be
    several words, with spaces between.
    """
    core = token.rstrip(_PUNCTUATION).lstrip(_LEADING)
    if _PLAIN.fullmatch(core) and not _RUN.search(core):
        return core.lower()
    if not fold(core):
        return ""
    return "~" + decode(core, costs)


def other_words(core: str) -> set[str]:
    """The words of ``core`` that have letters outside a to z: cut at marks, and joined across them.

    Signs stay with their letters and digits go. A word with repeated letters
    is there with runs of one letter and of two as well.
    """
    out: set[str] = set()
    if not any(_OTHER[c] for c in {*core, *core.lower()}):
        return out
    for part in {*_CUTS[-1].split(core), _CUTS[-1].sub("", core)}:
        word = re.sub(r"\d+", "", part).lower()
        if any(_OTHER[c] for c in set(word)):
            if not _RUN.search(word):
                out.add(word)
            if _DOUBLED.search(word):
                out |= {re.sub(r"(.)\1+", r"\1", word), re.sub(r"(.)\1{2,}", r"\1\1", word)}
    return out


#: Doubled letters in one word up to which all its spellings are priced one by one.
FEW_RUNS = 3


def _heads(word: str) -> set[str]:
    """Beginnings, of ``HEAD`` letters at most, of all that a plain word can be decoded to."""
    some, out, k = {""}, set(), 0
    while k < len(word) and some:
        end = k
        while end < len(word) and word[end] == word[k]:
            end += 1
        letter = fold(word[k])
        grown = {x + y for x in some for y in ((letter, letter * 2) if end - k > 1 else (letter,))}
        out |= {x[:HEAD] for x in grown if len(x) >= HEAD}
        some = {x for x in grown if len(x) < HEAD}
        k = end
    return out | some


def _plain_readings(word: str, costs: Costs) -> set[str]:
    """Readings of a plain word in lower case: itself, and without its doubled letters."""
    out = {word}
    runs = len(_DOUBLED.findall(word))
    if runs:
        if word.isascii() and runs <= FEW_RUNS and not _RUN.search(word):
            found = decode_doubled(word, costs)
            if found != word:
                out.add("~" + found)
        elif fold(word):
            out.update(["~" + w for w in decode(word, costs).split() if w != word])
    return out


def readings(token: str, costs: Costs) -> set[str]:
    """All words that a token may stand for: read as a whole, and in its parts between marks."""
    core = token.rstrip(_PUNCTUATION).lstrip(_LEADING)
    if _PLAIN.fullmatch(core) and not _RUN.search(core):
        # marks outside alone: every part is the word or nothing
        out = _plain_readings(core.lower(), costs) | {""}
        return out if token.isascii() else out | other_words(token)
    out = set()
    for part in {token, *[x for cut in _CUTS for x in cut.split(token)]} if not _PLAIN.fullmatch(token) else (token,):
        word = restore(part, costs)
        if word[:1] == "~":
            out.update(["~" + w for w in word[1:].split()])
        else:
            out |= _plain_readings(word, costs)
    if not token.isascii():
        out |= other_words(token)
    return out


def spaced_words(text: str, costs: Costs) -> set[str]:
    """Words restored from letters set apart."""
    out = set()
    for m in _SPACED.finditer(text):
        out.update(["~" + w for w in decode(re.sub(r"[-_.]", " ", m.group()), costs).split()])
    return out


def restored_words(text: str, costs: Costs, memo: dict, limit: int = 300_000) -> set[str]:
    """The distinct restored words of a whole text. ``memo`` keeps tokens met before, ``limit`` at most."""
    out = set()
    for token in set(text.split()):
        words = memo.get(token)
        if words is None:
            words = tuple(readings(token, costs))
            if len(token) <= 16:
                if len(memo) >= limit:
                    memo.clear()
                memo[token] = words
        out.update(words)
    out |= spaced_words(text, costs)
    out -= {"", "~"}
    return out


def character_model(docs: DataFrame) -> CharModel:
    """The language model of all rows' whole texts."""

    def run(batches):
        total = np.zeros(SIZE**ORDER, dtype=np.int64)
        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            for a, b in in_slices(texts):
                total += gram_counts(texts[a:b])
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], names=["gram", "n"])

    rows = pick(docs, "text").mapInArrow(run, COUNTS).groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(SIZE**ORDER, dtype=np.int64)
    counts[rows["gram"].to_numpy(dtype=np.int64)] = rows["n"].to_numpy(dtype=np.int64)
    return CharModel(counts)


def features(words: set[str], spelled: dict[str, str] | None = None) -> set[str]:
    """Words and their beginnings (marked by a dash), which inflected forms share.

    ``spelled`` gives the accented feature that decoded letters stand for.
    """
    out = set()
    for w in words:
        hidden = w[0] == "~"
        w = w[1:] if hidden else w
        own = [w, *[w[:n] + "-" for n in BEGINNINGS if len(w) >= n]]
        out.update(own)
        if hidden and spelled:
            out.update([spelled[f] for f in own if f in spelled])
    return out


class Scorer:
    """A word model over restored text."""

    def __init__(self, chars: CharModel, words: dict[str, float], bias: float):
        self.chars, self.words, self.bias = chars, words, bias
        self.spelled = {}
        for w, weight in sorted(words.items(), key=lambda x: (x[1], x[0])):
            plain = fold(w) + ("-" if w[-1] == "-" else "")
            if weight > 0 and plain != w:
                self.spelled[plain] = w

        # in one order, so that equal features sum up to equal scores
        self.place = {w: k for k, w in enumerate(sorted(words))}
        self.weight = [words[w] for w in sorted(words)]
        # no word that begins otherwise has a telling feature: beginnings are of HEAD letters or more
        self.heads = {f[:HEAD] for f in (*words, *self.spelled)}

    def telling(self, words) -> tuple[int, ...]:
        """Places of the features of ``words`` that have a weight."""
        return tuple(self.place[f] for f in features({w for w in words if w not in ("", "~")}, self.spelled) if f in self.place)

    def told(self, token: str, costs: "Costs") -> tuple[int, ...]:
        """``telling`` of all readings of a token; readings that cannot tell anything are not made."""
        core = token.rstrip(_PUNCTUATION).lstrip(_LEADING)
        if not _PLAIN.fullmatch(core) or _RUN.search(core):
            return self.telling(readings(token, costs))
        word, found = core.lower(), set()
        if word[:HEAD] in self.heads:
            found.add(word)
        if _DOUBLED.search(word) and not self.heads.isdisjoint(_heads(word)):
            found |= _plain_readings(word, costs)
        if not token.isascii():
            found |= other_words(token)
        return self.telling(found) if found else ()

    def of_features(self, places: set[int]) -> float:
        x = self.bias + sum(self.weight[k] for k in sorted(places))
        return float(1 / (1 + np.exp(-np.clip(x, -30, 30))))

    def score(self, words: set[str]) -> float:
        return self.of_features(set(self.telling(words)))

    def score_text(self, text: str, costs: "Costs", memo: dict, limit: int = 300_000) -> float:
        """Score of a whole text. ``memo`` keeps what tokens met before tell, ``limit`` at most."""
        found: set[int] = set()
        for token in set(text.split()):
            told = memo.get(token)
            if told is None:
                told = self.told(token, costs)
                if len(token) <= 24:
                    if len(memo) >= limit:
                        memo.clear()
                    memo[token] = told
            found.update(told)
        found.update(self.telling(spaced_words(text, costs)))
        return self.of_features(found)


def _memo_of_scores(shared, words: dict[str, float], bias: float) -> tuple[Scorer, dict]:
    """The worker's scorer and its memo; those of one broadcast model and one scorer at a time."""
    cache = worker_cache()
    held = cache.get("toxicity-scores")
    if held is None or held[0] != shared.id:
        held = (shared.id, Scorer(None, words, bias), {})
        cache["toxicity-scores"] = held
    return held[1], held[2]


def _memo(shared) -> tuple[Costs, dict]:
    """The worker's cost table and memo for a broadcast character model; those of one model at a time."""
    cache = worker_cache()
    held = cache.get("toxicity")
    if held is None or held[0] != shared.id:
        held = (shared.id, shared.value.table(), {})
        cache["toxicity"] = held
    return held[1], held[2]


class _Shared:
    """A broadcast character model with a name that workers can tell models apart by."""

    def __init__(self, spark, chars: CharModel):
        import uuid

        self.id, self.broadcast = uuid.uuid4().hex, spark.sparkContext.broadcast(chars)

    @property
    def value(self) -> CharModel:
        return self.broadcast.value


def train(docs: DataFrame, labels: DataFrame, chars: CharModel, sample_rows: int = SAMPLE_ROWS) -> Scorer:
    """A scorer from the labelled rows of ``docs``, all of which may be learned from."""
    spark = docs.sparkSession
    truth = (
        pick(labels, "doc_id", "toxic")
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .groupBy(F.col("doc_id").alias("_id"))
        .agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    )
    sizes = {r["toxic"]: r["n"] for r in truth.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return Scorer(chars, {}, -30.0)
    # the labelled ids of the sample: bounded, half toxic at most
    chance = F.shiftrightunsigned(F.xxhash64("_id"), 11) / float(1 << 53)
    part = F.when(F.col("toxic") == 1, sample_rows / 2 / sizes[1]).otherwise(sample_rows / 2 / sizes[0])
    chosen = truth.where(chance < part).orderBy(F.xxhash64("_id"), "_id").limit(2 * sample_rows)
    d = pick(docs, "doc_id", "text")
    rows = d.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("_id", "toxic", "text")
    # one row of each id, so that rows are bounded as ids are; two passes read them
    one = F.min_by(F.struct("toxic", "text"), F.struct(F.xxhash64("text"), "text")).alias("r")
    rows = written(rows.groupBy("_id").agg(one).select("r.toxic", "r.text"), "toxic-sample")
    shared = _Shared(spark, chars)

    def tally(batches):
        costs, memo = _memo(shared)
        counts: dict[str, list[int]] = {}
        for batch in batches:
            for toxic, text in zip(*(c.to_pylist() for c in batch.columns)):
                # '' stands for the row itself
                for w in features(restored_words(text or "", costs, memo)) | {""}:
                    counts.setdefault(w, [0, 0])[1 - toxic] += 1
        some = list(counts.items())
        for lo in range(0, len(some), 20_000):
            part = some[lo : lo + 20_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in part], pa.string()), *[pa.array([n[k] for _, n in part], pa.int64()) for k in (0, 1)]],
                names=["word", "t", "c"],
            )

    counted = rows.mapInArrow(tally, "word string, t long, c long").groupBy("word").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    counted = written(counted, "toxic-words")
    total = counted.where("word = ''").first()
    if total is None or not total["t"] or not total["c"]:
        return Scorer(chars, {}, -30.0)
    lift = F.log((F.col("t") + 0.5) / (total["t"] + 1)) - F.log((F.col("c") + 0.5) / (total["c"] + 1))
    telling = (
        counted.where((F.col("word") != "") & (F.col("t") >= MIN_TOXIC_ROWS))
        .withColumn("gain", F.abs(lift) * F.sqrt("t"))
        .orderBy(F.desc("gain"), "word")
        .limit(MAX_WORDS)
    )
    words = [r["word"] for r in telling.collect()]
    place = {w: k for k, w in enumerate(words)}

    def held(batches):
        costs, memo = _memo(shared)
        for batch in batches:
            found = [
                sorted(place[w] for w in features(restored_words(t or "", costs, memo)) if w in place)
                for t in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["toxic", "w"])

    sample = [
        (np.array(r["w"], dtype=np.int64), np.ones(len(r["w"])), r["toxic"])
        for r in rows.mapInArrow(held, "toxic int, w array<long>").collect()
    ]
    sample.sort(key=lambda r: (r[2], len(r[0]), r[0].tolist()))
    weights = fit(sample, len(words), 2, epochs=8, alpha=0.5, l1=1.5, l2=0.05)
    margin = weights[:, 1] - weights[:, 0]
    return Scorer(chars, {w: float(margin[k]) for w, k in place.items() if margin[k]}, float(margin[-1]))


def score(docs: DataFrame, scorer: Scorer, held_out: Column) -> DataFrame:
    """doc_id, held_out, score, predicted of every row. Only the text decides."""
    shared = _Shared(docs.sparkSession, scorer.chars)
    words, bias = scorer.words, scorer.bias

    def run(batches):
        costs = _memo(shared)[0]
        own, memo = _memo_of_scores(shared, words, bias)
        for batch in batches:
            got = [own.score_text(t.as_py() or "", costs, memo) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(got, pa.float64()),
                    pa.array([int(s >= 0.5) for s in got], pa.int32()),
                ],
                names=SCORED.fieldNames(),
            )

    d = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out.alias("held_out"))
    return d.mapInArrow(run, SCORED)


def judge_toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out_fold: int = 0, **options) -> DataFrame:
    """Learns from the labels of all folds but one, and scores every row of ``docs``."""
    held = in_fold(F.col("doc_id"), folds, held_out_fold)
    chars = character_model(docs)
    known = pick(labels, "doc_id", "toxic").where(F.col("doc_id").isNotNull())
    scorer = train(docs, known.where(~in_fold(F.col("doc_id"), folds, held_out_fold)), chars, **options)
    return score(docs, scorer, held)
