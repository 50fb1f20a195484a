"""SimHash near-duplicate groups by anchor-point covering.

Fingerprints of 64 bits link if they differ in few bits. Anchors are the words
of a covering code: two perfect binary Golay codes [23, 12] on 46 of the 64
bits, together 2^24 anchors. Every 23-bit block is within 3 bits of exactly
one codeword, so a fingerprint has one nearest anchor, its home. A fingerprint
within ``max_bits`` of another is, block by block, at most ``max_bits`` further
from the other's home than the covering radius; so each fingerprint is
replicated to every anchor within covering radius plus threshold, where the
excess over the radius is summed over the blocks. There it meets every home
fingerprint that it may link to, and the full 64 bits decide.

Equal fingerprints are one node before any of this. Per anchor, links are
reduced to a star for each linked set, so a clique of n fingerprints gives
n - 1 edges and not n squared. Components come from rounds of mates over these
edges, each of which halves the nodes; every round is written to the shared
folder.

Defined results: null or wordless texts have fingerprint zero and link like
any other; repeated rows share a component; a null doc_id counts as larger
than all others, and a component of null ids alone has a null id; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricerisk.llm.common import pick, shuffle_partitions, tidy, written

SHINGLE = 3
MAX_BITS = 2
SEED = 42
#: Generator polynomial x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1 of the binary Golay code (fixed value).
GOLAY = 0b110001110101
BLOCK, RADIUS = 23, 3
#: Lowest bits of the blocks within a fingerprint; the other bits are compared but make no anchor.
BLOCKS = (0, 23)

FINGERPRINTS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("fp", T.LongType(), False)])
REPLICAS = T.StructType(
    [
        T.StructField("anchor", T.LongType(), False),
        T.StructField("fp", T.LongType(), False),
        T.StructField("home", T.BooleanType(), False),
    ]
)
EDGES = T.StructType([T.StructField("a", T.LongType(), False), T.StructField("b", T.LongType(), False)])


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash: a bit is 1 if it is set in over half of the shingles' XXH64 values."""
    import xxhash

    # bytes.lower and bytes.split know ASCII letters and the six ASCII spaces only
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*[words[k:] for k in range(shingle)]))
    digest = xxhash.xxh64_intdigest
    total, n = np.zeros(64, dtype=np.int64), 0
    part: list[int] = []
    for g in grams:
        part.append(digest(g, seed))
        if len(part) == 50_000:
            total, n, part = total + _set_bits(part), n + len(part), []
    if part:
        total, n = total + _set_bits(part), n + len(part)
    return int(np.packbits(2 * total > n, bitorder="little").view("<u8")[0])


def _set_bits(hashes: list[int]) -> np.ndarray:
    rows = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    return np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED, more: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, signed 64-bit fingerprint, and columns ``more`` of every row; no shuffle, whole texts."""

    def run(batches):
        for batch in batches:
            fps = [fingerprint(t.as_py(), shingle, seed) for t in batch.column(1)]
            signed = np.array(fps, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(signed), *batch.columns[2:]], names=["doc_id", "fp", *more]
            )

    d = pick(docs, "doc_id", "text", *more).withColumn("doc_id", F.col("doc_id").cast("long"))
    return d.mapInArrow(tidy(run), T.StructType([*FINGERPRINTS.fields, *[d.schema[c] for c in more]]))


@lru_cache(maxsize=4)
def _patterns(reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Error patterns of at most ``reach`` bits in a block, sorted by syndrome.

    Returns the patterns, their excess weight over the covering radius, and
    where each of the 2048 syndromes begins. XORing a block with the patterns
    of its own syndrome gives exactly the codewords within ``reach`` of it.
    """
    syndromes = []
    for k in range(BLOCK):
        r = 1 << k
        for top in range(BLOCK - 1, 10, -1):
            if r >> top & 1:
                r ^= GOLAY << (top - 11)
        syndromes.append(r)
    patterns, weights, found = [0], [0], [0]
    for w in range(1, reach + 1):
        for bits in combinations(range(BLOCK), w):
            p = s = 0
            for b in bits:
                p |= 1 << b
                s ^= syndromes[b]
            patterns.append(p)
            weights.append(w)
            found.append(s)
    order = np.lexsort((np.array(weights), np.array(found)))
    by = np.array(found)[order]
    first = np.searchsorted(by, np.arange((1 << 11) + 1))
    excess = np.maximum(np.array(weights)[order] - RADIUS, 0)
    return np.array(patterns, dtype=np.int64)[order], excess, first


def _syndrome(block: np.ndarray) -> np.ndarray:
    r = block.copy()
    for top in range(BLOCK - 1, 10, -1):
        r = np.where(r >> top & 1, r ^ (GOLAY << (top - 11)), r)
    return r


def anchors_of(fps: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, is_home) of every anchor within covering radius plus ``max_bits``."""
    patterns, excess, first = _patterns(RADIUS + max_bits)
    row = np.arange(len(fps), dtype=np.int64)
    anchor = np.zeros(len(fps), dtype=np.int64)
    spent = np.zeros(len(fps), dtype=np.int64)
    for k, low in enumerate(BLOCKS):
        block = (fps[row].view(np.uint64) >> np.uint64(low)).astype(np.int64) & ((1 << BLOCK) - 1)
        s = _syndrome(block)
        n = first[s + 1] - first[s]
        at = np.repeat(first[s] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        total = np.repeat(spent, n) + excess[at]
        keep = total <= max_bits
        word = (np.repeat(block, n) ^ patterns[at])[keep]
        row, spent = np.repeat(row, n)[keep], total[keep]
        anchor = np.repeat(anchor, n)[keep] | word << (BLOCK * k)
    return row, anchor, spent == 0


def replicas(nodes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Every fingerprint at each of its anchors; ``home`` marks the nearest."""

    def run(batches):
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for lo in range(0, len(fps), 4096):
                part = fps[lo : lo + 4096]
                row, anchor, home = anchors_of(part, max_bits)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array(part[row]), pa.array(home)], names=REPLICAS.fieldNames()
                )

    return nodes.select("fp").mapInArrow(tidy(run), REPLICAS)


def _roots(n: int, links) -> list[int]:
    parent = list(range(n))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    return [find(x) for x in range(n)]


def _star(fps: np.ndarray, home: np.ndarray, max_bits: int, rows: int = 256):
    """Edges of a star for each set that the links between homes and all fingerprints of one anchor join."""
    fps, index = np.unique(fps, return_index=True)
    at_home = np.flatnonzero(home[index])
    u = fps.view(np.uint64)
    links = []
    for lo in range(0, len(at_home), rows):
        h = at_home[lo : lo + rows]
        for start in range(0, len(u), 1 << 14):
            near = np.bitwise_count(u[h][:, None] ^ u[None, start : start + (1 << 14)]) <= max_bits
            i, j = np.nonzero(near)
            links.append(np.stack([h[i], j + start], axis=1))
    pairs = np.concatenate(links) if links else np.zeros((0, 2), dtype=np.int64)
    pairs = pairs[pairs[:, 0] != pairs[:, 1]]
    if not len(pairs):
        return ()
    roots = _roots(len(fps), pairs.tolist())
    return [(int(fps[x]), int(fps[r])) for x, r in enumerate(roots) if x != r]


def links(nodes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Edges (a, b) between fingerprints, b the smaller, that join exactly what links join.

    The replicas of an anchor meet in one task, sorted by anchor; a task
    streams over its anchors and holds one at a time. Anchors number 2^24, and
    a fingerprint comes to one of them once, whatever the number of its rows.
    """

    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        out: list[tuple[int, int]] = []

        def close(anchor, fps, home):
            """Compares within each anchor of the sorted arrays."""
            starts = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
            ends = np.append(starts[1:], len(anchor))
            homes = np.add.reduceat(home.astype(np.int64), starts)
            for a, b in zip(starts[(homes > 0) & (ends - starts > 1)], ends[(homes > 0) & (ends - starts > 1)]):
                out.extend(_star(fps[a:b], home[a:b], max_bits))

        def flush():
            pairs = list(dict.fromkeys(out))
            out.clear()
            a, b = (list(x) for x in zip(*pairs)) if pairs else ([], [])
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            now = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)]
            held.append(tuple(now))
            if held[0][0][0] == now[0][-1]:
                continue  # one anchor so far
            anchor, fps, home = (np.concatenate(x) for x in zip(*held))
            whole = np.searchsorted(anchor, anchor[-1])  # the last anchor may go on
            close(anchor[:whole], fps[:whole], home[:whole])
            held = [(anchor[whole:], fps[whole:], home[whole:])]
            if len(out) > 50_000:
                yield flush()
        if held:
            close(*(np.concatenate(x) for x in zip(*held)))
        yield flush()

    spread = replicas(nodes, max_bits)
    n = shuffle_partitions(nodes.sparkSession)
    return spread.repartition(n, "anchor").sortWithinPartitions("anchor").mapInArrow(tidy(run), EDGES).distinct()


def _mates(live: DataFrame) -> DataFrame:
    """(a, to): every node with an edge points into its tree, whose root points to itself.

    A node points to its smallest neighbour, which is its least edge in the
    order of (smaller end, larger end). Least edges make no circle but between
    two nodes that chose each other; of these the smaller is the root. So each
    tree has two nodes or more, whatever the names of the nodes.
    """
    both = live.select("a", "b").union(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
    hop = written(both.groupBy("a").agg(F.min("b").alias("to")), "hop")
    back = hop.select(F.col("a").alias("to"), F.col("to").alias("again"))
    root = (F.col("again") == F.col("a")) & (F.col("a") < F.col("to"))
    return hop.join(back, "to").select("a", F.when(root, F.col("a")).otherwise(F.col("to")).alias("to"))


def _to_roots(hop: DataFrame) -> DataFrame:
    """(a, to) with ``to`` the root of each tree: pointers double until none moves."""
    hop = written(hop, "hop")
    while True:
        ahead = hop.select(F.col("a").alias("to"), F.col("to").alias("next"))
        moved = hop.join(ahead, "to").select("a", F.col("next").alias("to"), (F.col("next") != F.col("to")).alias("moved"))
        moved = written(moved, "hop")
        hop = moved.select("a", "to")
        if moved.where("moved").isEmpty():
            return hop


def components(edges: DataFrame) -> DataFrame:
    """(fp, root) of every fingerprint with an edge: root is the smallest fingerprint it reaches.

    Rounds of mates: each round makes one node of every tree, which has two
    nodes at least, so the nodes that are left halve and rounds grow with the
    logarithm of their number; within a round, pointers double, so steps grow
    with the logarithm of a tree's depth. Both hold for any names and shapes.
    """
    live = written(edges.where("a <> b"), "edges")
    nodes = written(live.select(F.col("a").alias("fp")).union(live.select("b")).distinct().select("fp", F.col("fp").alias("root")), "roots")
    while not live.isEmpty():
        hop = _to_roots(_mates(live))
        nodes = written(
            nodes.join(hop, nodes["root"] == hop["a"], "left").select("fp", F.coalesce("to", "root").alias("root")), "roots"
        )
        left = hop.select(F.col("a").alias("x"), F.col("to").alias("ra"))
        right = hop.select(F.col("a").alias("y"), F.col("to").alias("rb"))
        moved = live.join(left, live["a"] == left["x"]).join(right, live["b"] == right["y"])
        live = written(moved.where("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "edges")
    least = nodes.groupBy("root").agg(F.min("fp").alias("least"))
    return nodes.join(least, "root").select("fp", F.col("least").alias("root"))


def grouped(
    docs: DataFrame,
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    seed: int = SEED,
    more: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id, fp, ``more``, root (the smallest fingerprint of the component), component_id of every row."""
    prints = written(fingerprints(docs, shingle, seed, more), "fingerprints")
    # one row for each fingerprint: copies meet by partial aggregation
    nodes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "nodes")
    rooted = components(links(nodes, max_bits))
    joined = nodes.join(rooted, "fp", "left").select("fp", "least_id", F.coalesce("root", "fp").alias("root"))
    least = joined.groupBy("root").agg(F.min("least_id").alias("component_id"))
    # a component's fingerprints, not its rows, meet here
    by_print = joined.join(least, "root").select("fp", "root", "component_id")
    return prints.join(by_print, "fp").select("doc_id", "fp", *more, "root", "component_id")


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, seed: int = SEED
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable) of every row."""
    rows = grouped(docs, shingle, max_bits, seed)
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def first_of_groups(docs: DataFrame, key: tuple[str, ...], **options) -> DataFrame:
    """doc_id and ``key`` of one row for each group: the smallest doc_id, then the smallest key; null ids last."""
    rows = grouped(docs, more=key, **options)
    place = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", *key)
    return rows.groupBy("root").agg(F.min(place).alias("p")).select("p.doc_id", *[f"p.{k}" for k in key])
