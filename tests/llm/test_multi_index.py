"""The multi-index against brute force."""

import numpy as np
from pyspark.sql import functions as F

from relkit.llm import multi_index as M


def brute(rows, threshold=M.THRESHOLD):
    """(id, n_links, component) by comparing all pairs."""
    def vec(r):
        v = r[1]
        if r[0] is None or r[2] is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        return np.asarray(v, np.float64) / np.linalg.norm(np.asarray(v, np.float64))

    vs = [vec(r) for r in rows]
    n = len(rows)
    linked = [[j for j in range(n) if j != i and vs[i] is not None and vs[j] is not None and rows[i][2] == rows[j][2]
               and len(vs[i]) == len(vs[j]) and vs[i] @ vs[j] >= threshold] for i in range(n)]
    comp = [r[0] for r in rows]
    for _ in range(n):
        new = [min([comp[i], *[comp[j] for j in linked[i]]], key=lambda x: (x is None, x)) for i in range(n)]
        if new == comp:
            break
        comp = new
    return sorted(((r[0], len(l), c) for r, l, c in zip(rows, linked, comp)), key=str)


def made(seed, n=400, dim=16):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, dim))
    out = []
    for i in range(n):
        v = centres[rng.integers(12)] + rng.standard_normal(dim) * rng.choice([0.05, 0.25, 0.6])
        out.append((i, [float(x) for x in np.float32(v)], int(rng.integers(3))))
    return out


def check(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int") \
              .withColumns({"n": F.lit(1), "cell": F.lit("clash"), "rep": F.lit(2)})
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in M.near_duplicates(df, **options).collect()), key=str)
    assert got == brute(rows)


def test_matches_brute_force_with_small_blocks(spark):
    rows = made(1)
    rows += [(1000 + i, rows[i % 3][1], rows[i % 3][2]) for i in range(30)]       # copies
    check(spark, rows, block=16, target_recall=1.0)
    assert sum(n for _, n, _ in brute(rows)) > 500


def test_recall_of_the_default_stop(spark):
    rows = made(2, 600, 32)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sum(r.n_links for r in M.near_duplicates(df).collect())
    want = sum(n for _, n, _ in brute(rows))
    assert got >= 0.99 * want > 0


def test_hot_group_of_near_copies(spark):
    rng = np.random.default_rng(3)
    c = rng.standard_normal(16)
    rows = made(4, 100) + [(500 + i, [float(x) for x in np.float32(c + 0.02 * rng.standard_normal(16))], 7)
                           for i in range(200)]
    check(spark, rows, block=32)


def test_long_vectors_cost_no_more_than_themselves(spark, monkeypatch):
    rng = np.random.default_rng(9)
    long = [[float(x) for x in rng.standard_normal(6000)] for _ in range(3)]
    near = [[x + 0.05 * float(e) for x, e in zip(v, rng.standard_normal(6000))] for v in long]
    rows = made(7, 200, 8) + [(700 + i, v, 1) for i, v in enumerate(long + near)] + [(800, [1.0], 1), (801, [2.0], 1)]
    built = []
    build = M.build
    monkeypatch.setattr(M, "build", lambda sample, *rest: built.append(sample.shape) or build(sample, *rest))
    check(spark, rows)
    assert built[0][1] == 8
    assert [n for i, n, _ in brute(rows) if 700 <= (i or 0) < 706] == [1] * 6
    # all vectors long: the codebooks are folded
    monkeypatch.setattr(M, "MAX_DIM", 16)
    monkeypatch.setattr(M, "SAMPLE_BYTES", 8 * 40 * 150)
    built.clear()
    check(spark, made(8, 200, 40))
    assert built == [(150, 16)]


def test_one_component(spark):
    check(spark, [(i, [float(1 + i % 3)], 1) for i in range(9)] + [(20, [-1.0], 1)])


def test_bad_vectors_repeats_and_empty_tables(spark):
    one = [1.0, 0.0, 0.0, 0.0]
    rows = [(1, one, 0), (2, one, 0), (2, one, 0), (3, None, 0), (4, [0.0] * 4, 0), (5, [float("nan"), 1.0, 0.0, 0.0], 0),
            (6, [float("inf"), 1.0, 0.0, 0.0], 0), (7, [None, 1.0, 0.0, 0.0], 0), (8, one, None), (9, [1.0, 0.0], 0),
            (10, [], 0), (11, [2.0, 0.0, 0.0, 0.0], 0), (12, one, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in M.near_duplicates(df).collect())
    assert got == [(1, 3, 1), (2, 3, 1), (2, 3, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5), (6, 0, 6), (7, 0, 7), (8, 0, 8),
                   (9, 0, 9), (10, 0, 10), (11, 3, 1), (12, 0, 12)]
    assert M.near_duplicates(df.limit(0)).count() == 0


def test_visitors_of_a_sparse_cell_are_dealt(spark, monkeypatch):
    rng = np.random.default_rng(5)
    # The halves go together: two dense cells, and two sparse ones beside them.
    side = np.where(rng.random(900) < 0.5, -0.2, 0.2)[:, None]
    half = np.array([1.0, 0.0, 0.0, 0.0]) + side * np.array([0.0, 1.0, 0.0, 0.0])
    x = np.concatenate([half, half], 1) + 0.03 * rng.standard_normal((900, 8))
    x[:4, 5] *= -1
    rows = [(i, [float(e) for e in np.float32(v)], 0) for i, v in enumerate(x)]
    check(spark, rows, block=8, target_recall=1.0)
    true = M._verify

    def bounded(threshold):
        def run(batches):
            import pandas as pd
            got = list(batches)
            if got:
                size = pd.concat(got).groupby(["unit_a", "unit_b", "role"]).size()
                assert size.max() <= 3 * 8 * 8, size.max()
            yield from true(threshold)(iter(got))
        return run

    monkeypatch.setattr(M, "_verify", bounded)
    check(spark, rows, block=8, target_recall=1.0)
