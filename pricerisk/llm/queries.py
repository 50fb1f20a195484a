"""Registered queries of the training-data operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricerisk.llm.common import prepare, read_table
from pricerisk.llm.langid import identify
from pricerisk.llm.lines import dedup_lines
from pricerisk.llm.mtree import top_k_of_table
from pricerisk.llm.oracle import ORACLE as ORACLE
from pricerisk.llm.packing import pack_documents
from pricerisk.llm.pieces import encode_digest
from pricerisk.llm.quality import judge
from pricerisk.llm.ranking import ranked_search
from pricerisk.llm.records import records_round_trip
from pricerisk.llm.sharding import shard_documents
from pricerisk.llm.simhash import near_duplicates
from pricerisk.llm.spelling import variant_groups
from pricerisk.llm.toxicity import judge_toxicity
from pricerisk.llm.urls import ALLOW, BLOCK, filter_urls

#: Rules of op12 (fixed by the task): verdict, host, path.
URL_RULES = (
    (ALLOW, "com", "/"),
    (BLOCK, "example.com", "/en/"),
    (ALLOW, "www.example.com", "/en/"),
    (BLOCK, "net", "/es/"),
    (BLOCK, "net", "/fr/"),
)


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer's file on this machine; every executor has the same one."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the risk-controlled verdict of every document, with strata by language."""
    prepare(spark)
    out = judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return out.select(
        "doc_id", *counts, "base_failed", "kept", F.array_join(F.sort_array("failed_rules"), ",").alias("failed_rules")
    )


def op2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text encoded into pieces of largest score, decoded again and compared."""
    prepare(spark)
    return encode_digest(read_table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 largest inner products of every 20th vector with all others."""
    prepare(spark)
    return top_k_of_table(read_table(spark, sf_dir, "embeddings"))


def op4_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the three-line windows that occur earlier in the corpus."""
    prepare(spark)
    return dedup_lines(read_table(spark, sf_dir, "documents"))


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole text, learned from three of four folds."""
    prepare(spark)
    return identify(read_table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents: 3-word shingles, at most 2 differing bits."""
    prepare(spark)
    return near_duplicates(read_table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every whole text after deobfuscation, learned from four of five folds."""
    prepare(spark)
    return judge_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rendezvous shards 0 to 39 of every document, under the law ``key``."""
    prepare(spark)
    out = shard_documents(read_table(spark, sf_dir, "documents"), 40)
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minimum-bin-slack packing of every document into sequences of at most 1024 ids."""
    prepare(spark)
    return pack_documents(read_table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op10_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids written as framed records in document order, and read back."""
    prepare(spark)
    return records_round_trip(read_table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op11_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    prepare(spark)
    return ranked_search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op12_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page's url, with its path template and that template's purity."""
    prepare(spark)
    return filter_urls(read_table(spark, sf_dir, "pages"), URL_RULES)


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form, root and number of near words of every word of all documents."""
    prepare(spark)
    return variant_groups(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_pieces": op2_pieces,
    "op3_topk": op3_topk,
    "op4_lines": op4_lines,
    "op5_langid": op5_langid,
    "op6_simhash": op6_simhash,
    "op7_toxicity": op7_toxicity,
    "op8_sharding": op8_sharding,
    "op9_packing": op9_packing,
    "op10_records": op10_records,
    "op11_ranked": op11_ranked,
    "op12_urls": op12_urls,
    "op13_spelling": op13_spelling,
}
