"""Clusters by the tree against a plain version that compares everything."""

import hashlib
import math
import random

import numpy as np
import pytest

from relkit.llm import vantage_clusters as V


def plain(rows, k=V.K, rounds=V.ROUNDS, dim=V.DIM):
    """(id, cluster, distance, cluster_inertia, inertia, centroid hash)."""
    kept = [(i, tuple(math.floor(1024 * x) for x in v)) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "")
    centroids = [v for _, v in sorted(kept, key=lambda r: (name(r), r[1]))[:k]]
    away = lambda v, c: sum((x - y) ** 2 for x, y in zip(v, c))
    assign = lambda: [min((away(v, c), n) for n, c in enumerate(centroids)) for _, v in kept]
    for _ in range(rounds):
        near = assign()
        for n in range(len(centroids)):
            own = [v for (_, v), (_, m) in zip(kept, near) if m == n]
            if own:
                centroids[n] = tuple(sum(x) // len(own) for x in zip(*own))
    near = assign()
    of = {n: sum(d for d, m in near if m == n) for n in range(len(centroids))}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, m, d, of[m], sum(of.values()), sha[m]) for (i, _), (d, m) in zip(kept, near)), key=str)


def got(spark, rows, schema="vec_id bigint, embedding array<float>, label int", **options):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], schema)
    return sorted((tuple(r) for r in V.clusters(df, **options).collect()), key=str)


def made(seed, n, dim=V.DIM, step=None):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((9, dim))
    v = centres[rng.integers(9, size=n)] + rng.standard_normal((n, dim)) * 0.7
    if step:
        v = np.round(v / step) * step                 # many ties
    return [(i, [float(x) for x in np.float32(row)]) for i, row in enumerate(v)]


@pytest.mark.parametrize("seed,step", [(1, None), (2, 1.0)])
def test_equals_plain_version(spark, seed, step):
    rows = made(seed, 400, step=step)
    assert got(spark, rows) == plain(rows)


def test_odd_rows(spark):
    good = made(3, 40)
    v = good[0][1]
    bad = [(100, None), (101, []), (102, v[:-1]), (103, [*v, 0.0]), (104, [*v[:-1], None]),
           (105, [*v[:-1], math.nan]), (106, [*v[:-1], -math.inf])]
    rows = [*good, *bad, (None, good[1][1]), (7, good[2][1]), (7, good[7][1]), (None, good[3][1])]
    assert got(spark, rows) == plain(rows)
    assert got(spark, rows, k=100, rounds=3) == plain(rows, k=100, rounds=3)      # more centroids than vectors
    assert got(spark, bad) == [] and got(spark, []) == []
    few = [(None, v), (1, good[4][1])]
    assert got(spark, few) == plain(few)
    equal = [(i, v) for i in range(30)]
    assert {r[1:3] for r in got(spark, equal)} == {(0, 0)}


def test_clashing_names_and_other_columns(spark):
    rows = made(4, 30)
    df = spark.createDataFrame([(str(i), v, 1, 2.0) for i, v in rows], "id string, v array<double>, cluster int, distance double")
    out = V.clusters(df, "id", "v")
    assert out.columns == ["id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted((tuple(r) for r in out.collect()), key=str) == plain([(str(i), v) for i, v in rows])


def test_large_components_are_exact(spark):
    rng = random.Random(5)
    rows = [(i, [float(rng.randrange(-2**27, 2**27)) / 1024 for _ in range(V.DIM)]) for i in range(30)]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    assert got(spark, rows) == plain(rows)


@pytest.mark.parametrize("seed", range(6))
def test_tree_finds_the_nearest_with_ties(seed):
    rng = np.random.default_rng(seed)
    dim, k = int(rng.integers(1, 5)), int(rng.integers(1, 60))
    centroids = [tuple(int(x) for x in row) for row in rng.integers(-4, 5, (k, dim))]     # many equal ones
    own = rng.integers(-6, 7, (500, dim))
    cluster, squared, _ = V.nearest(own, V.Tree(centroids))
    for v, c, d in zip(own.tolist(), cluster.tolist(), squared.tolist()):
        assert (d, c) == min((sum((x - y) ** 2 for x, y in zip(v, m)), n) for n, m in enumerate(centroids))
    same = V.nearest(own.astype(object), V.Tree(centroids))
    assert same[0].tolist() == cluster.tolist() and same[1].tolist() == squared.tolist()


def test_tree_prunes():
    rng = np.random.default_rng(0)
    centroids = [tuple(int(x) for x in row) for row in rng.integers(0, 100_000, (200, 2))]
    own = rng.integers(0, 100_000, (1000, 2))
    assert V.nearest(own, V.Tree(centroids))[2] < 1000 * 200 / 4
