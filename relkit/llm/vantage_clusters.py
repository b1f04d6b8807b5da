"""k-means in exact integers, with a vantage-point tree over the centroids.

Vectors become integers, floor(1024 * x).  In every round a tree over the
centroids is built anew and broadcast; its size depends on the number of
centroids alone.  Every vector walks the tree best-first: of the nodes in
its queue it visits the one with the least lower bound of distance, and it
stops when that bound exceeds its best distance.  Lower bounds come from
distances to the vantage points by the triangle inequality, with integer
square roots rounded outwards, so all comparisons are of integers.  The
pruning radius is inclusive: a node that may hold a centroid at exactly
the best distance is visited, since a smaller number wins a tie.  The
vectors of a batch walk together, each with its own queue.

Each task sends one row per cluster (count and sums), added up in
decimals; only the centroids reach the driver.  All sums are exact, so
partitioning and reruns do not change any result.  The rows are read once
a round; they should come from a table.

Defined results: vectors that are null, of another length or with null or
non-finite components are left out.  Rows that repeat an id are vectors of
their own.  A vector with a null id is clustered, but is a first centroid
only if too few vectors have an id.  Equal vectors tie towards the smaller
centroid number; first centroids of one hash are ordered by their
components.  With fewer vectors than centroids there are fewer centroids.
An empty table gives an empty result.  A distance beyond a long is an
error.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relkit.llm.common import pinned, slices

K = 8
ROUNDS = 10
DIM = 64
SCALE = 1024
SEED = "3"
LEAF = 2                           # centroids of a leaf, at most
ROWS = 4096                        # vectors that walk together


def exact_limit(dim: int) -> int:
    """Components up to here have squared distances that doubles hold
    exactly, dim * (2 * limit)**2 <= 2**53; larger ones are computed as
    Python ints."""
    return math.isqrt((1 << 53) // max(dim, 1)) // 2


class Tree:
    """A vantage-point tree over the rows of a list of integer vectors."""

    def __init__(self, centroids: list[tuple[int, ...]], leaf: int = LEAF):
        self.rows = centroids
        #: node -> (vantage row, [(child, least, most distance)]) or the rows of a leaf
        self.inner: dict[int, tuple[int, list[tuple[int, int, int]]]] = {}
        self.leaves: dict[int, list[int]] = {}
        self.nodes = 0
        self._build(list(range(len(centroids))), leaf)

    def _squared(self, a: int, b: int) -> int:
        return sum((x - y) ** 2 for x, y in zip(self.rows[a], self.rows[b]))

    def _build(self, rows: list[int], leaf: int) -> int:
        node, self.nodes = self.nodes, self.nodes + 1
        if len(rows) <= leaf:
            self.leaves[node] = rows
            return node
        # The row farthest from the first one spreads the distances most.
        vantage = max(rows, key=lambda r: (self._squared(rows[0], r), -r))
        far = sorted((self._squared(vantage, r), r) for r in rows if r != vantage)
        half = len(far) // 2
        children = []
        for part in (far[:half], far[half:]):
            if part:
                least, most = math.isqrt(part[0][0]), _ceil_root(part[-1][0])
                children.append((self._build([r for _, r in part], leaf), least, most))
        self.inner[node] = (vantage, children)
        return node


def _ceil_root(n: int) -> int:
    r = math.isqrt(n)
    return r if r * r == n else r + 1


def _roots(squared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Integer square roots, rounded down and up."""
    if squared.dtype == object:
        down = np.array([math.isqrt(x) for x in squared], object)
        return down, np.array([_ceil_root(x) for x in squared], object)
    down = np.sqrt(squared.astype(np.float64)).astype(np.int64)
    down -= down * down > squared
    down += (down + 1) * (down + 1) <= squared
    return down, down + (down * down < squared)


def nearest(vectors: np.ndarray, tree: Tree) -> tuple[np.ndarray, np.ndarray, int]:
    """(centroid, squared distance) of every row of an integer matrix, and
    the number of distances computed."""
    limit = exact_limit(vectors.shape[1])
    small = vectors.dtype != object and max((abs(x) for row in tree.rows for x in row), default=0) <= limit
    centroids = np.array(tree.rows, np.float64 if small else object)
    own = vectors.astype(np.float64 if small else object)
    whole = np.int64 if small else object
    n, never = len(own), (1 << 62 if small else 1 << 1200)
    best = np.full(n, never, whole)
    cluster = np.full(n, len(tree.rows), np.int64)
    queue = np.full((n, tree.nodes), never, whole)          # squared lower bounds; never: not queued
    queue[:, 0] = 0
    computed = 0

    def measured(rows: np.ndarray, c: int) -> np.ndarray:
        nonlocal best, cluster, computed
        computed += len(rows)
        away = own[rows] - centroids[c]
        squared = (away * away).sum(1).astype(whole)
        better = (squared < best[rows]) | ((squared == best[rows]) & (c < cluster[rows]))
        best[rows[better]], cluster[rows[better]] = squared[better], c
        return squared

    walking = np.arange(n)
    while len(walking):
        at = queue[walking].argmin(1)
        bound = queue[walking, at]
        on = (bound < never) & (bound <= best[walking])
        walking, at, bound = walking[on], at[on], bound[on]
        for node in np.unique(at).tolist():
            here = at == node
            rows, low = walking[here], bound[here]
            queue[rows, node] = never
            if node in tree.leaves:
                for c in tree.leaves[node]:
                    measured(rows, c)
                continue
            vantage, children = tree.inner[node]
            down, up = _roots(measured(rows, vantage))
            for child, least, most in children:
                gap = np.maximum(np.maximum(down - most, least - up), 0)
                queue[rows, child] = np.maximum(low, gap * gap)
    return cluster, best, computed


def _kept(batch: pa.RecordBatch, dim: int, scale: int) -> tuple[pa.Array, np.ndarray]:
    """ids and integer components (int64, or Python ints if large) of the
    vectors of a batch that are kept."""
    batch = batch.filter(pc.fill_null(pc.equal(pc.list_value_length(batch.column("v")), dim), False))
    flat = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    finite = np.isfinite(flat).all(1)
    whole = np.floor(flat[finite] * scale)
    if len(whole) and np.abs(whole).max() > exact_limit(dim):
        whole = np.array([[int(x) for x in row] for row in whole], object)
    else:
        whole = whole.astype(np.int64)
    return batch.column("id").filter(pa.array(finite)), whole


def _assigned(tree, dim: int, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, ROWS):
            ids, own = _kept(batch, dim, scale)
            cluster, squared, _ = nearest(own, tree.value)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(cluster, pa.int32()), pa.array(squared.tolist(), pa.int64())],
                ["id", "cluster", "distance"])
    return run


def _summed(tree, k: int, dim: int, scale: int):
    """One row per cluster of a task: count and component sums."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = [0] * k, [[0] * dim for _ in range(k)]
        for batch in slices(batches, ROWS):
            _, own = _kept(batch, dim, scale)
            cluster, _, _ = nearest(own, tree.value)
            for c in np.unique(cluster).tolist():
                mine = own[cluster == c]
                count[c] += len(mine)
                total[c] = [x + y for x, y in zip(total[c], mine.sum(0).tolist())]
        some = [c for c in range(k) if count[c]]
        if some:
            decimal = pa.decimal128(38, 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int32()), pa.array([count[c] for c in some], pa.int64()),
                 *(pa.array([Decimal(total[c][j]) for c in some], decimal) for j in range(dim))],
                ["cluster", "n", *(f"s{j}" for j in range(dim))])
    return run


def _first(own: DataFrame, k: int, dim: int, scale: int, seed: str) -> list[tuple[int, ...]]:
    """The kept vectors whose seeded ids have the smallest hashes."""
    x = F.col("v")
    kept = own.where((F.size(x) == dim) & F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(math.inf))))
    named = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    rows = kept.select(named.alias("h"), "v").orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect()
    return [tuple(math.floor(c * scale) for c in r.v) for r in rows]


def clusters(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K,
             rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, seed: str = SEED) -> DataFrame:
    """One row per vector: id_col, cluster, distance (squared),
    cluster_inertia, inertia and centroid_sha256 (of the centroid's
    components, as decimal integers joined by commas)."""
    spark = rows.sparkSession
    own = rows.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    schema = f"id {own.schema['id'].dataType.simpleString()}, cluster int, distance bigint"
    centroids = _first(own, k, dim, scale, seed)
    sums = [f"s{j}" for j in range(dim)]
    for _ in range(rounds if centroids else 0):
        tree = spark.sparkContext.broadcast(Tree(centroids))
        per_task = own.mapInArrow(
            _summed(tree, len(centroids), dim, scale),
            "cluster int, n bigint, " + ", ".join(f"{s} decimal(38,0)" for s in sums))
        moved = per_task.groupBy("cluster").agg(F.sum("n").alias("n"), *(F.sum(s).alias(s) for s in sums)).collect()
        before = list(centroids)
        for r in moved:                                  # a row per centroid, at most
            centroids[r.cluster] = tuple(int(r[s]) // r.n for s in sums)
        if centroids == before:                          # further rounds would change nothing
            break
    tree = spark.sparkContext.broadcast(Tree(centroids))
    found = pinned(own.mapInArrow(_assigned(tree, dim, scale), schema))
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    totals = {r.cluster: int(r.d) for r in found.groupBy("cluster").agg(exact.alias("d")).collect()}
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    told = spark.createDataFrame(
        [(c, totals[c], sum(totals.values()), names[c]) for c in sorted(totals)],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return (found.join(F.broadcast(told), "cluster")     # a row per centroid
                 .select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))
