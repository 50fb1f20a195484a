"""The training-data pipeline: five stages over the documents table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``. All stages but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricerisk.llm.common import TEXT_KEY, keep_rows, pick, prepare, read_table, with_text_key, written
from pricerisk.llm.langid import UNDETERMINED, learn, predict
from pricerisk.llm.lines import dedup_lines
from pricerisk.llm.packing import pack_documents
from pricerisk.llm.quality import judge
from pricerisk.llm.queries import tokenizer_file
from pricerisk.llm.simhash import first_of_groups

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A language counts as recognised from this calibrated probability on.
MIN_LANGUAGE_SCORE = 0.5


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and every cutoff of their language, certified jointly.

    Rows with equal doc_id and text stay if any of them does.
    """
    prepare(spark)
    d = with_text_key(pick(docs, *COLUMNS))
    verdicts = judge(d, read_table(spark, sf_dir, "labels"), more=TEXT_KEY, joint=True)
    return keep_rows(d, verdicts.where("kept")).select(*COLUMNS)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a recognised language: with a letter, and with a score of at least one half.

    Where no row has a language to learn from, none can be told from another,
    and all documents with a letter stay.
    """
    prepare(spark)
    d = pick(docs, *COLUMNS)
    model, held = learn(d)
    if not model.langs:
        return d.where(F.col("text").rlike(r"\p{L}"))
    found = predict(d, model, held, COLUMNS[1:])
    known = (F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= MIN_LANGUAGE_SCORE)
    return found.where(known).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without repeated three-line windows; n_chars follows the text."""
    prepare(spark)
    out = dedup_lines(pick(docs, *COLUMNS), "lang", "source", "n_chars")
    chars = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.select("doc_id", "text", "lang", "source", chars.alias("n_chars"))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest doc_id.

    Rows that repeat its doc_id and text are copies too, and one of them stays.
    """
    prepare(spark)
    d = with_text_key(pick(docs, *COLUMNS))
    kept = keep_rows(d, first_of_groups(d, TEXT_KEY))
    return kept.dropDuplicates(["doc_id", *TEXT_KEY]).select(*COLUMNS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents' pieces in sequences of at most 1024 ids."""
    prepare(spark)
    return pack_documents(docs, tokenizer_file("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", simhash_dedup),
    ("best-fit packing", best_fit_packing),
]

#: Language ID, SimHash and the tokenizer have no SQL form; the stages are tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written before the next reads it."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
