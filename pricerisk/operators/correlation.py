"""Pairwise returns (R10) and the Pearson correlation matrix (R11).

The SQL formulation self-joins the returns on ``date`` with ``a.symbol <
b.symbol`` and sums per pair, which materialises one row per pair per date.
Here the sums are obtained as matrix products instead:

* returns are first reduced to one row per ``(symbol, date)`` holding the
  count, sum and sum of squares of that day's returns (this also collapses
  repeated ingests of a day, the only way one date can hold many rows of one
  symbol);
* symbols are numbered densely in their order; a tile is a range of
  ``tile_size`` numbers. Rows are grouped by ``(date block, tile pair)`` and
  each group computes the pair sums of its block with dense matrix products in
  ``applyInPandas``. A group holds at most ``block_days x 2 x tile_size``
  rows, whatever the data;
* where only some pairs are asked for, rows go to the tile pairs that these
  pairs fall into and to no others;
* the per-block partial sums are added per pair (a declarative aggregate)
  and turned into the correlation.

For a date shared by both symbols each statistic equals the self-join's:
``n = sum(c1*c2)``, ``Sx = sum(s1*c2)``, ``Sxy = sum(s1*s2)``,
``Sx2 = sum(q1*c2)`` and symmetrically for ``y``. Duplicates multiply exactly
as the join's row combinations do.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricerisk.functions.expressions import pearson
from pricerisk.operators.returns import clean_returns
from pricerisk.operators.scan import ordered_scan
from pricerisk.session import ship_code_to_workers

DEFAULT_BLOCK_DAYS = 1024
DEFAULT_TILE_SIZE = 256

_STATS = ["n", "sum_x", "sum_y", "sum_xy", "sum_x2", "sum_y2"]
_PAIR_SCHEMA = (
    "symbol_1 string, symbol_2 string, n long, sum_x double, sum_y double, "
    "sum_xy double, sum_x2 double, sum_y2 double"
)


def asked_pairs(pairs: DataFrame) -> DataFrame:
    """Distinct ``(symbol_1, symbol_2)`` with ``symbol_1 < symbol_2``, whichever way round they were asked for.

    Pairs with an unnamed symbol, or of a symbol with itself, are none.
    """
    one, two = F.col("symbol_1"), F.col("symbol_2")
    return pairs.filter(one != two).select(F.least(one, two).alias("symbol_1"), F.greatest(one, two).alias("symbol_2")).distinct()


def return_pairs(core: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """Same-date return pairs with ``symbol_1 < symbol_2``.

    One row per (date, symbol_1, symbol_2, x, y) with ``n_pairs``, the number
    of row combinations that give it (1 unless a day was ingested more than
    once). Each side is reduced to distinct (symbol, date, return) values
    first, so repeated ingests do not multiply rows.

    With ``pairs`` (symbol_1, symbol_2, either way round) only those are
    joined: the first side by symbol with the pairs, then by symbol and date
    with the second, so nothing is made that is not asked for. Without it the
    output is one row per pair per shared date, N^2 / 2 of them for a date of
    N symbols; that form is for few symbols.
    """
    r = (
        clean_returns(core)
        .groupBy("symbol", "date", F.col("daily_return").cast("double").alias("x"))
        .agg(F.count(F.lit(1)).alias("c"))
    )
    a = r.select(F.col("symbol").alias("symbol_1"), "date", "x", F.col("c").alias("c1"))
    b = r.select(F.col("symbol").alias("symbol_2"), "date", F.col("x").alias("y"), F.col("c").alias("c2"))
    if pairs is not None:
        joined = a.join(asked_pairs(pairs), "symbol_1").join(b, ["symbol_2", "date"])
    else:
        joined = a.join(b, "date").filter(F.col("symbol_1") < F.col("symbol_2"))
    return joined.select("date", "symbol_1", "symbol_2", "x", "y", (F.col("c1") * F.col("c2")).alias("n_pairs"))


def symbol_numbers(symbols: DataFrame) -> DataFrame:
    """``(symbol, number)``: the distinct named symbols numbered from 0 in their order, without gaps."""
    distinct = symbols.filter(F.col("symbol").isNotNull()).select("symbol").distinct()
    one = distinct.withColumn("_all", F.lit(0)).withColumn("_one", F.lit(1).cast("long"))
    counted = ordered_scan(one, "_all", ["symbol"], "_one", running_sum_as="_upto")
    return counted.select("symbol", (F.col("_upto") - 1).alias("number"))


def _block_pair_sums(pdf: pd.DataFrame) -> pd.DataFrame:
    """Pair sums of one (date block, tile pair) group via matrix products."""
    ta, tb = int(pdf["tile_a"].iat[0]), int(pdf["tile_b"].iat[0])
    dates, di = np.unique(pdf["d"].to_numpy(), return_inverse=True)
    numbers, at, si = np.unique(pdf["number"].to_numpy(), return_index=True, return_inverse=True)
    syms, tile_of = pdf["symbol"].to_numpy()[at], pdf["tile"].to_numpy()[at]
    nd, ns = len(dates), len(numbers)
    C = np.zeros((nd, ns))
    S = np.zeros((nd, ns))
    Q = np.zeros((nd, ns))
    C[di, si] = pdf["c"].to_numpy(dtype=float)
    S[di, si] = pdf["s"].to_numpy(dtype=float)
    Q[di, si] = pdf["q"].to_numpy(dtype=float)
    ia = np.flatnonzero(tile_of == ta)
    ib = np.flatnonzero(tile_of == tb)
    Ca, Sa, Qa, Cb, Sb, Qb = C[:, ia], S[:, ia], Q[:, ia], C[:, ib], S[:, ib], Q[:, ib]
    n = Ca.T @ Cb
    sx, sy = Sa.T @ Cb, Ca.T @ Sb
    sxy = Sa.T @ Sb
    sx2, sy2 = Qa.T @ Cb, Ca.T @ Qb
    # tiles and numbers are in the symbols' order, so a pair's first side is always the smaller symbol
    keep = (n > 0) & (numbers[ia][:, None] < numbers[ib][None, :])
    i, j = np.nonzero(keep)
    sums = (n, sx, sy, sxy, sx2, sy2)
    out = {"symbol_1": syms[ia][i], "symbol_2": syms[ib][j], **{k: m[i, j] for k, m in zip(_STATS, sums)}}
    out["n"] = np.rint(out["n"]).astype(np.int64)
    return pd.DataFrame(out)


def tiled_returns(
    core: DataFrame, *, pairs: DataFrame | None = None, block_days: int = DEFAULT_BLOCK_DAYS, tile_size: int = DEFAULT_TILE_SIZE
) -> DataFrame:
    """One row per (symbol, date) and tile pair it takes part in: block, tile_a, tile_b, tile, number, symbol, d, c, s, q."""
    named = clean_returns(core).filter(F.col("symbol").isNotNull())  # no pair has an unnamed side
    per = (
        named.withColumn("x", F.col("daily_return").cast("double"))
        .groupBy("symbol", "date")
        .agg(F.count(F.lit(1)).alias("c"), F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("q"))
    )
    if pairs is not None:
        pairs = asked_pairs(pairs)
        asked = pairs.select(F.col("symbol_1").alias("symbol")).union(pairs.select("symbol_2")).distinct()
        per = per.join(asked, "symbol", "left_semi")
        numbers = symbol_numbers(asked)
    else:
        numbers = symbol_numbers(named)
    tile = F.floor(F.col("number") / F.lit(tile_size)).cast("long")
    numbers = numbers.withColumn("tile", tile)
    rows = per.join(numbers, "symbol").withColumn("d", F.unix_date("date"))
    rows = rows.withColumn("block", F.floor(F.col("d") / F.lit(block_days)).cast("long"))
    if pairs is not None:
        of = [numbers.select(F.col("symbol").alias(f"symbol_{k}"), F.col("tile").alias(f"tile_{k}")) for k in (1, 2)]
        wanted = pairs.join(of[0], "symbol_1").join(of[1], "symbol_2").select("tile_1", "tile_2").distinct()
        # a tile and the tile pairs it is part of; a pair within one tile once
        either = wanted.select(F.col("tile_1").alias("tile"), F.col("tile_1").alias("tile_a"), F.col("tile_2").alias("tile_b"))
        other = wanted.filter("tile_1 <> tile_2").select(
            F.col("tile_2").alias("tile"), F.col("tile_1").alias("tile_a"), F.col("tile_2").alias("tile_b")
        )
        rows = rows.join(either.unionByName(other), "tile")
    else:
        last = F.floor((named.agg(F.countDistinct("symbol")).scalar() - 1) / F.lit(tile_size)).cast("long")
        rows = (
            rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), last)))
            .withColumn("tile_a", F.least("tile", "other"))
            .withColumn("tile_b", F.greatest("tile", "other"))
        )
    return rows.select("block", "tile_a", "tile_b", "tile", "number", "symbol", "d", "c", "s", "q")


def pair_statistics(
    core: DataFrame, *, pairs: DataFrame | None = None, block_days: int = DEFAULT_BLOCK_DAYS, tile_size: int = DEFAULT_TILE_SIZE
) -> DataFrame:
    """Per pair (of ``pairs``, or of all): n, Sx, Sy, Sxy, Sx2, Sy2 over the dates both symbols share."""
    tiled = tiled_returns(core, pairs=pairs, block_days=block_days, tile_size=tile_size)
    ship_code_to_workers()
    partial = tiled.groupBy("block", "tile_a", "tile_b").applyInPandas(_block_pair_sums, _PAIR_SCHEMA)
    if pairs is not None:
        partial = partial.join(asked_pairs(pairs), ["symbol_1", "symbol_2"], "left_semi")
    return partial.groupBy("symbol_1", "symbol_2").agg(*[F.sum(c).alias(c) for c in _STATS])


def correlation_matrix(
    core: DataFrame, *, pairs: DataFrame | None = None, block_days: int = DEFAULT_BLOCK_DAYS, tile_size: int = DEFAULT_TILE_SIZE
) -> DataFrame:
    """Pearson correlation of daily returns for every symbol pair sharing a date, or for those of ``pairs`` that do.

    ``round((n*Sxy - Sx*Sy) / nullif(sqrt(greatest((n*Sx2 - Sx^2)(n*Sy2 - Sy^2), 0)), 0), 4)``;
    NULL when either side has zero variance. Ordered by correlation desc.
    """
    st = pair_statistics(core, pairs=pairs, block_days=block_days, tile_size=tile_size)
    return st.select(
        "symbol_1", "symbol_2", pearson(*_STATS).alias("correlation")
    ).orderBy(F.col("correlation").desc_nulls_last())
