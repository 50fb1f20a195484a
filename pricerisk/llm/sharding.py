"""Sharding by rendezvous (highest random weight) hashing.

Every shard draws a pseudo-random number for every record key, and the shard
with the best weighted draw gets the record. A draw depends on the key and the
shard number alone, so a new shard takes records only into itself, and a
removed shard gives up only its own. Draws are ``-ln(u) / weight`` with ``u``
uniform in (0, 1): the smallest wins, and a shard wins in proportion to its
weight.

Defined results: a null key is a key like any other; repeated rows with one
key share a shard; an empty table gives an empty result; extra columns are
ignored by the assignment.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricerisk.llm.common import numbered, pick

SEED = 20240607


def rendezvous_shard(key: Column, weights: Sequence[float], seed: int = SEED) -> Column:
    """Shard number from 0 for ``key``; shards with weight 0 get nothing."""
    live = [(i, float(w)) for i, w in enumerate(weights) if w > 0]
    if not live or any(w < 0 for w in weights):
        raise ValueError("weights must not be negative, and one must be above 0")
    text = F.coalesce(key.cast("string"), F.lit("\x00null"))
    shards = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(w).alias("w")) for i, w in live])

    def draw(s: Column) -> Column:
        h = F.xxhash64(text, s["i"], F.lit(seed))
        # the upper 53 bits, moved off 0
        u = (F.shiftrightunsigned(h, 11).cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))
        return F.struct((-F.log(u) / s["w"]).alias("d"), s["i"].alias("i"))

    return F.array_min(F.transform(shards, draw))["i"].cast("int")


def shard_documents(
    docs: DataFrame, n_shards: int = 40, weights: Sequence[float] | None = None, seed: int = SEED
) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot, grown_shard for every row of ``docs``.

    ``slot`` numbers a shard's rows from 0 without gaps; ``grown_shard`` is the
    shard with one more shard of weight 1. Texts leave the plan before any
    shuffle: only the narrow result rows move.
    """
    weights = list(weights) if weights is not None else [1.0] * n_shards
    if len(weights) != n_shards:
        raise ValueError("one weight for each shard")
    d = pick(docs, "doc_id", "text")
    rows = d.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 16).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32"),
        rendezvous_shard(F.col("doc_id"), weights, seed).alias("shard"),
        rendezvous_shard(F.col("doc_id"), [*weights, 1.0], seed).alias("grown_shard"),
    )
    out = numbered(rows, "shard", ["doc_id", "text_crc32", "size"], "slot", "shards")
    return out.select("doc_id", "size", "text_crc32", "shard", F.col("slot").cast("long").alias("slot"), "grown_shard")
