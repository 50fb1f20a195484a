"""Language identification by sparse multinomial logistic regression.

Features are TF-IDF weights of hashed character n-grams (1 to 3 letters, lower
case, runs of other characters as one space) of the whole text, scaled to
length one. Document frequencies count every document of the training fold.
The classifier is trained by follow-the-regularised-leader with elastic-net
penalties on a bounded sample of it (``sample_rows``, spread evenly over the
languages), and a temperature fitted on a fifth of that sample, kept apart
from the training, makes the score a probability.

Defined results: null text or text without a letter is ``und`` with score 0,
as is everything if there is nothing to learn from; a null doc_id is in no
fold that is held out and is not learned from; repeated rows get equal
results; very long texts count as a whole; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricerisk.llm.common import pick, tidy, worker_cache
from pricerisk.llm.ftrl import fit, logits_of, softmax, temperature
from pricerisk.llm.tokens import in_slices

BITS = 15
GRAMS = 3
SAMPLE_ROWS = 4000
MAX_LANGS = 1000
UNDETERMINED = "und"
#: Characters whose n-grams are made at a time, some 70 bytes of arrays for each; more only for one longer text.
SLICE = 500_000
#: Odd multipliers of the n-gram hash, one for each place in it.
MULTIPLIERS = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35)

COUNTS = T.StructType([T.StructField("bucket", T.IntegerType(), False), T.StructField("n", T.LongType(), False)])
SAMPLE = T.StructType(
    [T.StructField("lang", T.StringType()), T.StructField("index", T.BinaryType()), T.StructField("tf", T.BinaryType())]
)
PREDICTED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("held_out", T.BooleanType(), False),
        T.StructField("lang_pred", T.StringType(), False),
        T.StructField("score", T.DoubleType(), False),
    ]
)


def in_fold(doc_id: Column, folds: int, which: int) -> Column:
    """crc32(doc_id as text) mod ``folds`` is ``which``; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == which, F.lit(False))


def letters() -> np.ndarray:
    """True at the code points of letters."""
    cache = worker_cache()
    if "letters" not in cache:
        cache["letters"] = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
    return cache["letters"]


def gram_buckets(texts: list[str], bits: int = BITS) -> list[np.ndarray]:
    """Hash buckets of each text's n-grams, repeats included; empty without a letter."""
    # a space before and behind each text; n-grams never cross two of them
    joined = "".join(f" {t.lower()} \n" for t in texts)
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    ends = np.cumsum([len(t.lower()) + 3 for t in texts])
    letter = letters()[code]
    doc = np.repeat(np.arange(len(texts)), np.diff(np.concatenate(([0], ends))))
    has = np.add.reduceat(letter.astype(np.int64), np.concatenate(([0], ends[:-1]))) > 0
    symbol = np.where(letter, code, 32).astype(np.uint32)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # of a run of other characters only the first stays
    keep[np.concatenate(([0], ends[:-1]))] = True
    symbol, doc, letter = symbol[keep], doc[keep], letter[keep]
    n, out = len(symbol), []
    h = np.zeros(n, dtype=np.uint32)
    for k in range(GRAMS):
        m = n - k
        if m <= 0:
            break
        h = h[:m] + symbol[k:] * np.uint32(MULTIPLIERS[k])
        mixed = (h + np.uint32(k)) * np.uint32(0x27D4EB2F)
        mixed ^= mixed >> np.uint32(15)
        mixed *= np.uint32(0x165667B1)
        whole = doc[:m] == doc[k:]
        if k == 0:
            whole &= letter
        out.append(((mixed >> np.uint32(32 - bits)).astype(np.int32)[whole], doc[:m][whole]))
    cuts = np.arange(1, len(texts))
    parts = [np.split(b, np.searchsorted(d, cuts)) for b, d in out]
    empty = np.zeros(0, dtype=np.int32)
    return [np.concatenate([p[k] for p in parts]) if has[k] else empty for k in range(len(texts))]


def grams_of(texts: list[str]):
    """The buckets of each text, in arrays for a slice of the texts at a time."""
    for a, b in in_slices(texts, SLICE):
        yield from gram_buckets(texts[a:b])


def term_counts(buckets: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    counts = np.bincount(buckets, minlength=1 << bits)
    index = np.flatnonzero(counts)
    return index, counts[index]


def weighted(index: np.ndarray, tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1.0 + np.log(tf)) * idf[index]
    norm = np.sqrt((x * x).sum())
    return x / norm if norm > 0 else x


class Model:
    def __init__(self, langs: list[str], idf: np.ndarray, weights: np.ndarray, heat: float):
        self.langs, self.idf, self.weights, self.heat = langs, idf, weights, heat

    def predict(self, buckets: np.ndarray) -> tuple[str, float]:
        if not len(buckets) or not self.langs:
            return UNDETERMINED, 0.0
        index, tf = term_counts(buckets)
        p = softmax(logits_of(self.weights, index, weighted(index, tf, self.idf))[None] / self.heat)[0]
        k = int(p.argmax())
        return self.langs[k], float(p[k])


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Documents that hold each bucket, and documents in all: every row of ``texts`` counts.

    Each task adds up its share; as many numbers as buckets come to the driver,
    whatever the size of the table. Bucket -1 stands for all documents.
    """

    def run(batches):
        total = np.zeros((1 << BITS) + 1, dtype=np.int64)
        for batch in batches:
            for buckets in grams_of([t or "" for t in batch.column(0).to_pylist()]):
                if len(buckets):
                    total[np.unique(buckets) if len(buckets) < 4096 else term_counts(buckets)[0]] += 1
                    total[-1] += 1
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], names=["bucket", "n"])

    rows = texts.mapInArrow(tidy(run), COUNTS).groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    df = np.zeros((1 << BITS) + 1, dtype=np.int64)
    for r in rows:
        df[r["bucket"]] = r["n"]
    return df[:-1], int(df[-1])


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, **options) -> Model:
    """A model from doc_id, text and lang of the rows of ``docs``, all of which may be learned from."""
    d = pick(docs, "doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    df, n = document_frequencies(d.select("text"))
    idf = np.log((1.0 + n) / (1.0 + df)) + 1.0
    sizes = d.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(MAX_LANGS).collect()
    if not sizes:
        return Model([], idf, np.zeros((1, 0)), 1.0)
    share = sample_rows / len(sizes)
    parts = F.create_map(*[x for r in sizes for x in (F.lit(r["lang"]), F.lit(min(1.0, share / r["n"])))])
    order = F.xxhash64("doc_id", "text")
    chance = F.shiftrightunsigned(order, 11) / float(1 << 53)

    def run(batches):
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in in_slices(texts, SLICE):
                rows = []
                for lang, buckets in zip(langs[a:b], gram_buckets(texts[a:b])):
                    if len(buckets):
                        index, tf = term_counts(buckets)
                        rows.append((lang, index.astype("<i4").tobytes(), tf.astype("<i4").tobytes()))
                columns = list(zip(*rows)) if rows else ([], [], [])
                types = (pa.string(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types)], names=SAMPLE.fieldNames())

    chosen = d.select("text", "lang", order.alias("h")).where(chance < F.coalesce(parts[F.col("lang")], F.lit(0.0)))
    sample = chosen.orderBy("h", "lang").limit(2 * sample_rows).select("text", "lang").mapInArrow(tidy(run), SAMPLE).collect()
    langs = sorted({r["lang"] for r in sample})
    place = {x: k for k, x in enumerate(langs)}
    rows = []
    for r in sample:
        index = np.frombuffer(r["index"], dtype="<i4").astype(np.int64)
        rows.append((index, weighted(index, np.frombuffer(r["tf"], dtype="<i4"), idf), place[r["lang"]]))
    apart = learned = rows
    if len(rows) >= 50:
        # every fifth row of each language, so that four of its first rows at least are learned from
        seen = dict.fromkeys(range(len(langs)), 0)
        apart, learned = [], []
        for row in rows:
            seen[row[2]] += 1
            (learned if seen[row[2]] % 5 else apart).append(row)
    weights = fit(learned, 1 << BITS, len(langs), **({"alpha": 0.5, "l1": 0.02, "l2": 0.02} | options))
    logits = np.array([logits_of(weights, i, x) for i, x, _ in apart])
    return Model(langs, idf, weights, temperature(logits, np.array([y for _, _, y in apart])))


def predict(docs: DataFrame, model: Model, held_out: Column, more: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row, and its columns ``more``. Only the text decides."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # (buckets + 1) x languages weights

    def run(batches):
        m = shared.value
        for batch in batches:
            got = [m.predict(x) for x in grams_of([t or "" for t in batch.column(1).to_pylist()])]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array([x for x, _ in got], pa.string()),
                    pa.array([s for _, s in got], pa.float64()),
                    *batch.columns[3:],
                ],
                names=[*PREDICTED.fieldNames(), *more],
            )

    d = pick(docs, *dict.fromkeys(("doc_id", "text", *more)))
    own = [F.col(c).alias(f"_{c}") for c in more]
    d = d.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out.alias("held_out"), *own)
    schema = T.StructType([*PREDICTED.fields, *[T.StructField(c, d.schema[f"_{c}"].dataType) for c in more]])
    return d.mapInArrow(tidy(run), schema)


def learn(docs: DataFrame, folds: int = 4, held_out_fold: int = 2, **options) -> tuple[Model, Column]:
    """A model from all folds but one (without any language if no row has one to learn), and the fold held out."""
    held = in_fold(F.col("doc_id"), folds, held_out_fold)
    return train(docs.where(F.col("doc_id").isNotNull() & ~held), **options), held


def identify(docs: DataFrame, folds: int = 4, held_out_fold: int = 2, more: tuple[str, ...] = (), **options) -> DataFrame:
    """Learns from all folds but one, and predicts every row of ``docs``."""
    d = pick(docs, *dict.fromkeys(("doc_id", "text", "lang", *more)))
    model, held = learn(d, folds, held_out_fold, **options)
    return predict(d, model, held, more)
