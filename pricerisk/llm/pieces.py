"""SentencePiece encoding and decoding by a max-plus parallel scan.

The vocabulary and its scores come from a SentencePiece model file. A text's
encoding is the sequence of pieces with the largest sum of scores; characters
without a piece become their UTF-8 bytes at a penalty. As in SentencePiece a
space goes before the text and is dropped in decoding; spaces are kept as they
are, so decoding gives back every text.

Giant documents are cut into chunks of ``chunk`` characters. A chunk knows
nothing of the others: for every number of its first characters that a piece
from before may cover (the state at its left edge) and every number of
characters its last piece may reach beyond it (the state at its right edge) it
yields the best score, a transfer matrix. Matrices combine associatively under
(max, +): blocks of chunks first, then the blocks of a document. The scan
gives the state at every edge, and each chunk backtraces its pieces between
its two states on its own. Shorter documents are the case of one chunk.

Inside a chunk no piece crosses from a word to the space behind it (checked on
the vocabulary), so words are solved one by one and kept in a bounded memo; a
chunk that has such a place has a matrix of rank one.

Among encodings of equal score any may be chosen, always the same for one
document and chunk size: within a word the longest last piece counts. Defined
results: null and empty texts have no pieces; repeated rows are encoded one by
one and equally; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricerisk.llm.common import pick, worker_cache, written
from pricerisk.llm.tokens import WORD_MARKS, Memo, coded_units, put_together, uneven

CHUNK = 32_768
BLOCK = 256
UNKNOWN_PENALTY = 10.0
NONE = -np.inf

ENCODED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_chunks", T.IntegerType(), False),
        T.StructField("score", T.DoubleType(), False),
        T.StructField("ids", T.BinaryType(), False),
        T.StructField("text_crc32", T.LongType(), False),
    ]
)
CHUNKS = T.StructType(
    [
        T.StructField("row", T.StringType(), False),
        T.StructField("doc_id", T.LongType()),
        T.StructField("chunk", T.IntegerType(), False),
        T.StructField("n_chunks", T.IntegerType(), False),
        T.StructField("own", T.IntegerType(), False),
        T.StructField("text", T.StringType(), False),
        T.StructField("text_crc32", T.LongType(), False),
    ]
)


class Vocabulary:
    """Pieces with spaces for U+2581, their scores, and exact segmentation of short strings."""

    def __init__(self, path: str, memo_size: int = 500_000):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.byte_ids: dict[int, int] = {}
        self.ids: dict[str, int] = {}
        self.texts: list[bytes] = [b""] * n
        self.scores = np.zeros(n)
        for k in range(n):
            piece = sp.id_to_piece(k)
            if sp.is_byte(k):
                value = int(piece[3:5], 16)
                self.byte_ids[value], self.texts[k] = k, bytes([value])
            elif not (sp.is_unknown(k) or sp.is_control(k) or sp.is_unused(k)):
                text = piece.replace("▁", " ")
                self.ids[text], self.texts[k] = k, text.encode()
                self.scores[k] = sp.get_score(k)
        if len(self.byte_ids) != 256:
            raise ValueError("the model has no byte pieces")
        if any(re.search("[^ ] ", p) for p in self.ids):
            raise ValueError("a piece crosses from a word to the space behind it")
        self.unknown = float(min(self.scores[k] for k in self.ids.values())) - UNKNOWN_PENALTY
        for value, k in self.byte_ids.items():
            # the penalty counts once for a character: at its first byte
            self.scores[k] = 0.0 if value & 0xC0 == 0x80 else self.unknown
        #: Every beginning of a piece, with the id of the piece that it is or -1.
        self.beginnings = {p[:k]: -1 for p in self.ids for k in range(1, len(p))} | self.ids
        self.longest = max(map(len, self.ids))
        self.score_of = self.scores.tolist()
        alone = "".join(c for c in "\n\t\r" if not any(c in p for p in self.ids if len(p) > 1))
        mark = re.escape(alone)
        self.units = re.compile(f" *[^ {mark}]+| +|[{mark}]" if alone else " *[^ ]+| +")
        self.memo: dict[str, bytes] = {}
        self.memo_size = memo_size
        self.breaks_alone = "\n" in alone
        #: Neighbouring characters of pieces; no piece crosses a place between two others.
        self.joint = {p[k : k + 2] for p in self.ids for k in range(len(p) - 1)}
        self.words = Memo(memo_size // 2)

    def forward(self, text: str, start: int, stop: int):
        """Best scores from ``start`` to each place, and the last piece's start: pieces begin before ``stop``.

        A character that is no piece by itself is unknown and stands alone at a penalty.
        """
        n, longest, find, score_of = len(text), self.longest, self.beginnings.get, self.score_of
        best, back = [NONE] * (n + 1), [-1] * (n + 1)
        best[start] = 0.0
        for at in range(start, min(stop, n)):
            here = best[at]
            if here == NONE:
                continue
            k = find(text[at])
            score = here + (self.unknown if k is None or k < 0 else score_of[k])
            if score > best[at + 1]:  # the first found starts earliest: the longest last piece
                best[at + 1], back[at + 1] = score, at
            if k is None:
                continue
            for end in range(at + 2, min(n, at + longest) + 1):
                k = find(text[at:end])
                if k is None:
                    break
                if k >= 0:
                    score = here + score_of[k]
                    if score > best[end]:
                        best[end], back[end] = score, at
        return best, back

    def trace(self, text: str, back: list[int], start: int, end: int) -> bytes:
        out: list[int] = []
        find = self.ids.get
        while end > start:
            at = back[end]
            k = find(text[at:end])
            if k is None:
                out.extend(self.byte_ids[b] for b in reversed(text[at:end].encode("utf-8", "surrogatepass")))
            else:
                out.append(k)
            end = at
        out.reverse()
        return struct.pack(f"<{len(out)}I", *out)

    def unit(self, text: str) -> bytes:
        """The ids of one unit."""
        ids = self.memo.get(text)
        if ids is None:
            ids = self.search(text)
            if len(text) <= 16:
                if len(self.memo) >= self.memo_size:
                    self.memo.clear()
                self.memo[text] = ids
        return ids

    def whole(self, text: str) -> bytes:
        """The ids of a text that begins and ends where units do."""
        memo, unit = self.memo, self.unit
        return b"".join([memo.get(u) or unit(u) for u in self.units.findall(text)])

    def _key(self, key: str) -> tuple[str, str]:
        """A word with its space, and marks behind it that no piece joins to it; or the whole key and nothing."""
        if key[:1] == "\n":
            return key, ""
        m = WORD_MARKS.fullmatch(key)
        if m and m[2] and m[1][-1] + m[2][0] not in self.joint:
            return " " + m[1], m[2]
        return " " + key, ""

    def many(self, texts: list[str]) -> list[bytes]:
        """The ids of texts with a space before each; distinct words are looked up once for all of them."""
        out = [b""] * len(texts)
        even = []
        for i, (t, odd) in enumerate(zip(texts, uneven(texts))):
            if t and (odd or not self.breaks_alone):
                out[i] = self.whole(" " + t)
            elif t:
                even.append(i)
        if even:
            keys, codes, ends = coded_units([texts[i] for i in even])
            cut = [self._key(k) for k in keys]
            memo = self.words
            new = memo.missing(dict.fromkeys(w for w, _ in cut))
            young, search = memo.young, self.search
            for w in new:
                young[w] = b"".join(map(search, self.units.findall(w)))
            values = [young[w] + self.unit(x) if x else young[w] for w, x in cut]
            for i, ids in zip(even, put_together(values, codes, ends, np.dtype("<u4"))):
                out[i] = ids
            for w in new:
                if len(w) > 16:
                    del young[w]
            memo.turn()
        return out

    def search(self, text: str) -> bytes:
        _, back = self.forward(text, 0, len(text))
        return self.trace(text, back, 0, len(text))

    def score(self, ids: bytes) -> float:
        return float(self.scores[np.frombuffer(ids, dtype="<u4")].sum())

    def edges(self, text: str, own: int) -> tuple[int, int] | None:
        """The first and the last place in (0, own) that no piece crosses."""
        places = [m.start() for m in re.finditer("(?<=[^ ]) ", text[:own])]
        return (places[0], places[-1]) if places else None

    def matrix(self, text: str, own: int) -> np.ndarray:
        """Best score from each left state to each right state of a chunk.

        ``text`` is the chunk's ``own`` characters and those after it that its
        last piece may reach.
        """
        width = self.longest
        out = np.full((width, width), NONE)
        reach = min(width, len(text) - own + 1)
        cut = self.edges(text, own)
        if cut is None:
            for a in range(min(width, own + 1)):
                out[a, :reach] = self.forward(text, a, own)[0][own : own + reach]
            return out
        first, last = cut
        head = np.array([self.forward(text[:first], a, first)[0][first] if a <= first else NONE for a in range(width)])
        middle = self.score(self.whole(text[first:last]))
        tail = self.forward(text[last:], 0, own - last)[0][own - last : own - last + reach]
        out[:, :reach] = head[:, None] + middle + np.array(tail)[None]
        return out

    def between(self, text: str, own: int, a: int, b: int) -> bytes:
        """The ids of a chunk between its left state and its right state."""
        end = own + b
        cut = self.edges(text, own)
        if cut is None:
            back = self.forward(text[:end], a, own)[1]
            return self.trace(text, back, a, end)
        first, last = cut
        head = text[:first]
        tail = text[last:end]
        return (
            self.trace(head, self.forward(head, a, first)[1], a, first)
            + self.whole(text[first:last])
            + self.trace(tail, self.forward(tail, 0, own - last)[1], 0, len(tail))
        )

    def decode(self, ids: bytes) -> str:
        text = b"".join(map(self.texts.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))
        return text.decode("utf-8", "surrogatepass")[1:]


def vocabulary(path: str) -> Vocabulary:
    cache = worker_cache()
    if ("pieces", path) not in cache:
        cache["pieces", path] = Vocabulary(path)
    return cache["pieces", path]


def through(vector: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """A row of scores times a matrix under (max, +)."""
    return (vector[:, None] + matrix).max(axis=0)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Associative: the matrix of two neighbouring runs of chunks as one."""
    return (a[:, :, None] + b[None]).max(axis=1)


def states(matrices: list[np.ndarray], first: int, last: int) -> list[int]:
    """The states at all edges of neighbouring runs, between two given ones."""
    row = np.full(len(matrices[0]), NONE)
    row[first] = 0.0
    rows = [row]
    for m in matrices:
        rows.append(through(rows[-1], m))
    out = [last]
    for k in range(len(matrices) - 1, 0, -1):
        out.append(int((rows[k] + matrices[k][:, out[-1]]).argmax()))
    return [first, *out[::-1]]


def _crc(text: str) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass"))


def _short(docs: DataFrame, path: str, chunk: int) -> DataFrame:
    def run(batches):
        v = vocabulary(path)
        for batch in batches:
            rows = []
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for doc, text, ids in zip(batch.column(0).to_pylist(), texts, v.many(texts)):
                rows.append((doc, 1 if text else 0, v.score(ids), ids, _crc(text)))
            types = (pa.int64(), pa.int32(), pa.float64(), pa.binary(), pa.int64())
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types)], names=ENCODED.fieldNames())

    return docs.where(F.coalesce(F.length("text"), F.lit(0)) < chunk).mapInArrow(run, ENCODED)


def _chunks(docs: DataFrame, path: str, chunk: int) -> DataFrame:
    """The chunks of texts of at least ``chunk`` characters, each with what its last piece may reach."""

    def run(batches):
        ahead = vocabulary(path).longest - 1
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                row, crc, text = uuid.uuid4().hex, _crc(text), " " + text
                n = len(text) // chunk
                for k in range(n):
                    lo, hi = k * chunk, (k + 1) * chunk if k + 1 < n else len(text)
                    values = (row, doc, k, n, hi - lo, text[lo : hi + ahead], crc)
                    types = (pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x], type=t) for x, t in zip(values, types)], names=CHUNKS.fieldNames()
                    )

    return docs.where(F.length("text") >= chunk).mapInArrow(run, CHUNKS)


def _edge_states(chunks: DataFrame, path: str) -> DataFrame:
    """(row, chunk, a, b): the states on both sides of every chunk."""

    def matrices(batches):
        v = vocabulary(path)
        for batch in batches:
            cells = [v.matrix(t, own).tobytes() for t, own in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(cells, pa.binary())], names=["row", "chunk", "m"]
            )

    def read(cells) -> list[np.ndarray]:
        flat = [np.frombuffer(c) for c in cells]
        return [f.reshape(int(len(f) ** 0.5), -1) for f in flat]

    def of_block(key, pdf: pd.DataFrame) -> pd.DataFrame:
        ms = read(pdf.sort_values("chunk")["m"])
        total = ms[0]
        for m in ms[1:]:
            total = product(total, m)
        return pd.DataFrame({"row": [key[0]], "block": [key[1]], "m": [total.tobytes()]})

    def of_document(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block")
        s = states(read(pdf["m"]), 0, 0)
        return pd.DataFrame({"row": key[0], "block": pdf["block"], "s0": s[:-1], "s1": s[1:]})

    def inside(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("chunk")
        s = states(read(pdf["m"]), int(pdf["s0"].iloc[0]), int(pdf["s1"].iloc[0]))
        return pd.DataFrame({"row": key[0], "chunk": pdf["chunk"], "a": s[:-1], "b": s[1:]})

    cells = chunks.select("row", "chunk", "text", "own").mapInArrow(matrices, "row string, chunk int, m binary")
    cells = written(cells.withColumn("block", F.expr(f"chunk div {BLOCK}").cast("int")), "matrices")
    blocks = cells.groupBy("row", "block").applyInPandas(of_block, "row string, block int, m binary")
    edges = blocks.groupBy("row").applyInPandas(of_document, "row string, block int, s0 int, s1 int")
    met = cells.join(edges, ["row", "block"])
    return met.groupBy("row", "block").applyInPandas(inside, "row string, chunk int, a int, b int")


def _long(docs: DataFrame, path: str, chunk: int) -> DataFrame:
    chunks = written(_chunks(docs, path, chunk), "chunks")
    between = _edge_states(chunks, path)

    def trace(batches):
        v = vocabulary(path)
        for batch in batches:
            c = batch.to_pydict()
            ids = [v.between(*x) for x in zip(c["text"], c["own"], c["a"], c["b"])]
            arrays = [batch.column(n) for n in range(5)]
            arrays += [pa.array([v.score(x) for x in ids], pa.float64()), pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(
                arrays, names=["row", "doc_id", "chunk", "n_chunks", "text_crc32", "score", "ids"]
            )

    def joined(batches):
        for batch in batches:
            ids = [b"".join(x["ids"] for x in parts) for parts in batch.column(3).to_pylist()]
            arrays = [batch.column(0), batch.column(1), batch.column(2), pa.array(ids, pa.binary()), batch.column(4)]
            yield pa.RecordBatch.from_arrays(arrays, names=ENCODED.fieldNames())

    traced = (
        chunks.join(between, ["row", "chunk"])
        .select("row", "doc_id", "chunk", "n_chunks", "text_crc32", "text", "own", "a", "b")
        .mapInArrow(trace, "row string, doc_id long, chunk int, n_chunks int, text_crc32 long, score double, ids binary")
    )
    # a document's ids are one row again, as its text was
    return (
        traced.groupBy("row")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.first("n_chunks").alias("n_chunks"),
            F.sum("score").alias("score"),
            F.sort_array(F.collect_list(F.struct("chunk", "ids"))).alias("parts"),
            F.first("text_crc32").alias("text_crc32"),
        )
        .select("doc_id", "n_chunks", "score", "parts", "text_crc32")
        .mapInArrow(joined, ENCODED)
    )


def encode_documents(docs: DataFrame, model_path: str, chunk: int = CHUNK) -> DataFrame:
    """doc_id, n_chunks, score, ids (little-endian uint32), text_crc32 of every row."""
    d = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return _short(d, model_path, chunk).union(_long(d, model_path, chunk))


def decode_documents(encoded: DataFrame, model_path: str) -> DataFrame:
    """The rows of ``encoded`` (doc_id, ids) with their text."""

    def run(batches):
        v = vocabulary(model_path)
        for batch in batches:
            texts = [v.decode(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return pick(encoded, "doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def encode_digest(docs: DataFrame, model_path: str, chunk: int = CHUNK) -> DataFrame:
    """doc_id, n_chunks, n_pieces, score, ids_crc32, restored: each row encoded, decoded again, and compared."""

    def run(batches):
        v = vocabulary(model_path)
        for batch in batches:
            ids = batch.column(3).to_pylist()
            same = [_crc(v.decode(x)) == c for x, c in zip(ids, batch.column(4).to_pylist())]
            arrays = [
                *batch.columns[:3],
                pa.array([len(x) // 4 for x in ids], pa.int64()),
                pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                pa.array(same, pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(
                arrays, names=["doc_id", "n_chunks", "score", "n_pieces", "ids_crc32", "restored"]
            )

    schema = "doc_id long, n_chunks int, score double, n_pieces long, ids_crc32 long, restored boolean"
    return encode_documents(docs, model_path, chunk).mapInArrow(run, schema)
