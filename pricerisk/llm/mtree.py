"""Exact top-k search by inner product with a paged M-tree, best first.

Integer vectors become points of a metric space by one more coordinate: with
M the largest norm, x' = (x, sqrt(M^2 - |x|^2)) and q' = (q, 0) have
|q' - x'|^2 = |q|^2 + M^2 - 2 q.x, so the nearest points are the largest inner
products.

The tree has routing objects with covering radii, and below them leaf pages of
at most ``page_rows`` vectors, each with its distance to its routing object.
Routing objects are picked by farthest-first traversal of a bounded sample
(``sample_rows``); every vector is indexed under its nearest one. Pages are
runs of the vectors in (routing object, parent distance) order, dealt by a
range shuffle, so that a node that holds a third of all rows, or a vector with
very many copies, spreads over many pages and tasks.

The search goes best first in two waves. A query first visits the nodes with
the smallest lower bound d(q, routing object) - radius until they hold more
than k vectors; the k-th score found bounds the rest: the second wave visits
only nodes whose lower bound is within it. In a page, vectors whose stored
parent distance differs from the query's by more than the bound are passed
over without computing (triangle inequality). What remains is computed for a
block of queries and a page at a time, in exact integers. Bounds have a slack
far above rounding, so no vector that could tie is passed over.

Defined results: rows with a null id or a vector that is null or holds a null
or non-finite component take no part; of rows with one vec_id the one with the
smallest vector counts; shorter vectors end in zeros; ties go to the smaller
vec_id; fewer than k candidates give all; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from pricerisk.llm.common import pick, shuffle_partitions, written

K = 20
SCALE = 64
N_NODES = 256
SAMPLE_ROWS = 4096
PAGE_ROWS = 512
BLOCK_QUERIES = 512
FIRST_NODES = 8

_L, _I, _D, _B = T.LongType(), T.IntegerType(), T.DoubleType(), T.BinaryType()


def _schema(**fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, False) for n, t in fields.items()])


ASSIGNED = _schema(vec_id=_L, node=_I, parent=_D, v=_B)
PAGES = _schema(node=_I, low=_D, high=_D, n=_I, ids=_B, parents=_B, vectors=_B)
REQUESTS = _schema(node=_I, query_id=_L, distance=_D, bound=_D, least=_L, v=_B)
BLOCKS = _schema(b_node=_I, nearest=_D, farthest=_D, b_ids=_B, distances=_B, bounds=_B, leasts=_B, queries=_B)
FOUND = _schema(query_id=_L, vec_id=_L, score=_L)
#: A bound below every score, for queries without one yet.
NO_SCORE = -(1 << 62)


def integer_vectors(df: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): floor(scale * x) of every component, one row for each vec_id."""
    x = F.col("embedding")
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
    d = pick(df, "vec_id", "embedding").select(F.col("vec_id").cast("long"), x.cast("array<double>").alias("embedding"))
    d = d.where(F.col("vec_id").isNotNull() & x.isNotNull() & ~F.exists(x, bad))
    d = d.select("vec_id", F.transform(x, lambda c: F.floor(c * scale)).alias("v"))
    return d.groupBy("vec_id").agg(F.min("v").alias("v"))


class Space:
    """The bounded facts that all tasks share: dimensions, M^2, and the nodes."""

    def __init__(self, dims: int, max_norm2: int, max_abs: int, centers: np.ndarray):
        self.dims, self.m2, self.centers = dims, float(max_norm2), centers
        self.exact = dims * max_abs * max_abs < 1 << 53
        self.slack = 1e-6 * (1.0 + np.sqrt(self.m2))
        self.center_up = np.sqrt(np.maximum(self.m2 - (centers.astype(np.float64) ** 2).sum(1), 0))
        self.radii = self.counts = np.zeros(0)

    def rows(self, column) -> np.ndarray:
        """A column of integer lists as a matrix, zeros behind short ones."""
        out = np.zeros((len(column), self.dims), dtype=np.int64)
        for k, v in enumerate(column):
            a = v.values.to_numpy(zero_copy_only=False)
            out[k, : len(a)] = a
        return out

    def scores(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Integer inner products of all rows of ``a`` and ``b``."""
        if self.exact:  # sums below 2^53 are whole numbers in doubles
            return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
        return (a.astype(object) @ b.astype(object).T).astype(np.int64)

    def to_nodes(self, v: np.ndarray, is_query: bool) -> np.ndarray:
        """Distances in the metric space from rows of ``v`` to the routing objects."""
        x, c = v.astype(np.float64), self.centers.astype(np.float64)
        n2 = (x**2).sum(1)
        up = np.zeros(len(x)) if is_query else np.sqrt(np.maximum(self.m2 - n2, 0))
        d2 = (n2 + up**2)[:, None] + self.m2 - 2 * (x @ c.T + up[:, None] * self.center_up[None])
        return np.sqrt(np.maximum(d2, 0))


def farthest_first(sample: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` distinct rows, each the farthest from those before."""
    x = sample.astype(np.float64)
    chosen, gap = [0], ((x - x[0]) ** 2).sum(1)
    while len(chosen) < min(n, len(x)) and gap.max() > 0:
        k = int(gap.argmax())
        chosen.append(k)
        gap = np.minimum(gap, ((x - x[k]) ** 2).sum(1))
    return sample[chosen]


def build(vectors: DataFrame, n_nodes: int, sample_rows: int, page_rows: int) -> tuple[Space, DataFrame]:
    """The nodes, and the pages as a written table."""
    facts = vectors.agg(
        F.max(F.size("v")).alias("dims"),
        F.max(F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))).alias("m2"),
        F.max(F.coalesce(F.array_max(F.transform("v", lambda c: F.abs(c))), F.lit(0))).alias("most"),
    ).first()
    dims = max(1, facts["dims"] or 1)
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).select("v").collect()
    points = np.zeros((len(sample), dims), dtype=np.int64)
    for k, r in enumerate(sample):
        points[k, : len(r.v)] = r.v
    space = Space(dims, facts["m2"] or 0, facts["most"] or 0, farthest_first(points, n_nodes) if len(points) else points)

    def assign(batches):
        for batch in batches:
            v = space.rows(batch.column(1))
            if not len(v):
                continue
            d = space.to_nodes(v, False)
            node = d.argmin(1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(node.astype(np.int32)),
                    pa.array(d[np.arange(len(v)), node]),
                    pa.array([r.tobytes() for r in v], type=pa.binary()),
                ],
                names=ASSIGNED.fieldNames(),
            )

    def paged(batches):
        def page(rows):
            node, parents = rows[0][1], np.array([r[2] for r in rows])
            ids = np.array([r[0] for r in rows], dtype=np.int64)
            blob = (ids.tobytes(), parents.tobytes(), b"".join(r[3] for r in rows))
            return (node, float(parents.min()), float(parents.max()), len(rows), *blob)

        def batch_of(pages):
            types = (pa.int32(), pa.float64(), pa.float64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(zip(*pages), types)], names=PAGES.fieldNames()
            )

        rows = []
        for batch in batches:
            for r in zip(*(c.to_pylist() for c in batch.columns)):
                if rows and (len(rows) == page_rows or rows[0][1] != r[1]):
                    yield batch_of([page(rows)])
                    rows = []
                rows.append(r)
        if rows:
            yield batch_of([page(rows)])

    ordered = (
        vectors.select("vec_id", "v")
        .mapInArrow(assign, ASSIGNED)
        .repartitionByRange(shuffle_partitions(vectors.sparkSession), "node", "parent", "vec_id")
        .sortWithinPartitions("node", "parent", "vec_id")
    )
    pages = written(ordered.mapInArrow(paged, PAGES), "pages")
    nodes = {r["node"]: r for r in pages.groupBy("node").agg(F.max("high").alias("r"), F.sum("n").alias("n")).collect()}
    held = range(len(space.centers))
    space.radii = np.array([nodes[k]["r"] if k in nodes else -1.0 for k in held])
    space.counts = np.array([nodes[k]["n"] if k in nodes else 0 for k in held])
    return space, pages


def _requests(queries: DataFrame, space: Space, k: int, first_nodes: int, second: bool) -> DataFrame:
    """(query, node) visits of a wave. ``queries``: vec_id, v and for the second wave ``least``, the k-th score."""

    def run(batches):
        for batch in batches:
            v = space.rows(batch.column(1))
            if not len(v):
                continue
            d = space.to_nodes(v, True)
            lower = np.maximum(d - space.radii[None], 0)
            lower[:, space.counts == 0] = np.inf
            order = np.argsort(lower, axis=1, kind="stable")
            # nodes in best-first order until they hold more than k vectors, and first_nodes at least
            before = np.cumsum(space.counts[order], axis=1) - space.counts[order]
            early = (before <= k) | (np.arange(d.shape[1])[None] < first_nodes)
            wanted = np.zeros_like(early)
            np.put_along_axis(wanted, order, early, axis=1)
            least = np.full(len(v), NO_SCORE, dtype=np.int64)
            bound = np.full(len(v), np.inf)
            if second:
                least = batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
                known = least > NO_SCORE
                d2 = (v.astype(np.float64) ** 2).sum(1) + space.m2 - 2.0 * least.astype(np.float64)
                bound = np.where(known, np.sqrt(np.maximum(d2, 0)) + space.slack, np.inf)
                wanted = ~wanted & (lower <= bound[:, None])
            wanted &= (space.counts > 0)[None]
            q, node = np.nonzero(wanted)
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for lo in range(0, len(q), 8192):
                a, b = q[lo : lo + 8192], node[lo : lo + 8192]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(b.astype(np.int32)),
                        pa.array(ids[a]),
                        pa.array(d[a, b]),
                        pa.array(bound[a]),
                        pa.array(least[a]),
                        pa.array([v[x].tobytes() for x in a], type=pa.binary()),
                    ],
                    names=REQUESTS.fieldNames(),
                )

    return queries.mapInArrow(run, REQUESTS)


def _blocks(requests: DataFrame) -> DataFrame:
    """Requests of a node in blocks of at most BLOCK_QUERIES, in order of their distance."""

    def run(batches):
        def batch_of(rows):
            _, ids, d, bound, least, v = zip(*rows)
            arrays = (np.array(ids, dtype=np.int64), np.array(d), np.array(bound), np.array(least, dtype=np.int64))
            reach = arrays[1] - arrays[2], arrays[1] + arrays[2]
            row = (rows[0][0], float(reach[0].min()), float(reach[1].max()), *[x.tobytes() for x in arrays], b"".join(v))
            types = (pa.int32(), pa.float64(), pa.float64(), *[pa.binary()] * 5)
            return pa.RecordBatch.from_arrays([pa.array([x], type=t) for x, t in zip(row, types)], names=BLOCKS.fieldNames())

        rows = []
        for batch in batches:
            for r in zip(*(c.to_pylist() for c in batch.columns)):
                if rows and (len(rows) == BLOCK_QUERIES or rows[0][0] != r[0]):
                    yield batch_of(rows)
                    rows = []
                rows.append(r)
        if rows:
            yield batch_of(rows)

    n = shuffle_partitions(requests.sparkSession)
    ordered = requests.repartitionByRange(n, "node", "distance", "query_id").sortWithinPartitions("node", "distance", "query_id")
    return ordered.mapInArrow(run, BLOCKS)


def _visit(blocks: DataFrame, pages: DataFrame, space: Space, k: int) -> DataFrame:
    """The up to k best of each page for each query that visits it, from its bound on."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                x = np.frombuffer(row["vectors"], dtype=np.int64).reshape(-1, space.dims)
                q = np.frombuffer(row["queries"], dtype=np.int64).reshape(-1, space.dims)
                ids, parents = np.frombuffer(row["ids"], dtype=np.int64), np.frombuffer(row["parents"])
                qids, d = np.frombuffer(row["b_ids"], dtype=np.int64), np.frombuffer(row["distances"])
                bounds, least = np.frombuffer(row["bounds"]), np.frombuffer(row["leasts"], dtype=np.int64)
                near = np.abs(d[:, None] - parents[None]) <= bounds[:, None] + space.slack
                cols, qs = np.flatnonzero(near.any(0)), np.flatnonzero(near.any(1))
                if not len(cols):
                    continue
                s = space.scores(q[qs], x[cols])
                ok = near[np.ix_(qs, cols)] & (s >= least[qs][:, None]) & (qids[qs][:, None] != ids[cols][None])
                out = ([], [], [])
                for r in np.flatnonzero(ok.any(1)):
                    c = np.flatnonzero(ok[r])
                    best = c[np.lexsort((ids[cols[c]], -s[r, c]))[:k]]
                    out[0].append(np.full(len(best), qids[qs[r]]))
                    out[1].append(ids[cols[best]])
                    out[2].append(s[r, best])
                if out[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(o)) for o in out], names=FOUND.fieldNames())

    met = blocks.join(
        pages,
        (F.col("b_node") == F.col("node"))
        & (F.col("low") <= F.col("farthest") + space.slack)
        & (F.col("high") >= F.col("nearest") - space.slack),
    )
    names = ["ids", "parents", "vectors", "b_ids", "distances", "bounds", "leasts", "queries"]
    # a pair is a page and a block of queries; few are in a batch
    return met.select(*names).mapInArrow(run, FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = K,
    n_nodes: int = N_NODES,
    sample_rows: int = SAMPLE_ROWS,
    page_rows: int = PAGE_ROWS,
    first_nodes: int = FIRST_NODES,
) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k largest inner products.

    ``vectors`` and ``queries`` are (vec_id, v) frames; a query's own vec_id is
    no candidate of it.
    """
    space, pages = build(vectors, n_nodes, sample_rows, page_rows)
    queries = queries.select("vec_id", "v")
    first = written(_best(_visit(_blocks(_requests(queries, space, k, first_nodes, False)), pages, space, k), k), "first")
    kth = first.where(F.col("rank") == k).select(F.col("query_id").alias("_q"), F.col("score").alias("_s"))
    bounded = queries.join(kth, F.col("vec_id") == F.col("_q"), "left").select(
        "vec_id", "v", F.coalesce("_s", F.lit(NO_SCORE)).alias("least")
    )
    rest = _visit(_blocks(_requests(bounded, space, k, first_nodes, True)), pages, space, k)
    out = _best(first.select("query_id", "vec_id", "score").union(rest), k)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def top_k_of_table(embeddings: DataFrame, every: int = 20, k: int = K, scale: int = SCALE, **options) -> DataFrame:
    """The search of every ``every``-th vec_id against all rows of ``embeddings``."""
    vectors = written(integer_vectors(embeddings, scale), "vectors")
    return top_k(vectors, vectors.where(F.col("vec_id") % every == 0), k, **options)
