"""Ordered patterns and exact-size samples against plain versions: ties,
nulls, repeated rows, hot keys, empty tables, plans."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF001, SF0001
from oracle import compare, duck
from relkit.catalog import BY_NAME
from relkit.operators import patterns as M
from relkit.operators import sampling as G
from relkit.sources import Tables

ZERO = dt.datetime(2024, 3, 30)


def plain_pattern(rows, steps, within):
    fit = sorted((r for r in rows if None not in r[:3]), key=lambda r: (r[2], r[1]))
    out = []
    for u, i, x, kind in rows:
        if kind != steps[0]:
            continue
        found, at = [], (x, i)
        for step in steps[1:]:
            later = None if None in (u, i, x) or len(found) and found[-1] is None else next(
                ((x2, i2) for u2, i2, x2, k2 in fit if u2 == u and k2 == step and (x2, i2) > at), None)
            if later and (later[0] - x).total_seconds() > within:
                later = None
            found.append(later)
            at = later or at
        flat = [v for f in found for v in ((f[1], f[0]) if f else (None, None))]
        out.append((u, i, x, *flat, 1 + sum(f is not None for f in found)))
    return sorted(out, key=str)


@pytest.mark.parametrize("steps", [("a", "b"), ("a", "b", "c"), ("a", "b", "a", "c")])
@pytest.mark.parametrize("split", [0, 5])
def test_patterns_match_a_plain_version(spark, steps, split):
    rng = random.Random(4)
    rows = [(rng.choice([None, 1, 1, 1, 1, 2, 3]), None if rng.random() < 0.05 else i,
             None if rng.random() < 0.05 else ZERO + dt.timedelta(seconds=rng.randrange(90)),
             rng.choice(["a", "b", "c", "d", None])) for i in range(300)]
    df = spark.createDataFrame(rows, "u int, id long, ts timestamp_ntz, kind string").withColumn("clash", F.lit(1))
    got = M.ordered_pattern(df, ["u"], "ts", "id", "kind", steps, 20 * 1_000_000, split)
    want = plain_pattern(rows, steps, 20)
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert max(r[-1] for r in want) == len(steps)
    assert M.ordered_pattern(df.limit(0), ["u"], "ts", "id", "kind", steps, 1, split).count() == 0


def test_patterns_name_their_steps(spark):
    df = spark.createDataFrame([], "u int, id long, ts timestamp_ntz, kind string")
    for steps in (["a"], ["a", "a"], []):
        with pytest.raises(ValueError):
            M.ordered_pattern(df, ["u"], "ts", "id", "kind", steps, 1)


def test_split_funnel_matches_duckdb(spark):
    ok, msg = compare(M.funnel(Tables.from_dir(spark, SF001), split=4), duck(SF001), BY_NAME["t7_event_funnel"].sql)
    assert ok, msg


def test_funnel_shuffles_once(spark):
    plan = M.funnel(Tables.from_dir(spark, SF0001), split=0)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def sampled(df, size, seed=1):
    return Counter(map(tuple, G.stratified_sample(df, ["s"], ["id"], size, seed).collect()))


def test_samples_have_exact_sizes(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["hot"] * 6 + ["b", "c", None]), rng.choice([None, 1, i, i]), rng.choice([None, 0.5])) for i in range(3000)]
    rows += [("hot", 77, 1.0)] * 900 + [("few", i, None) for i in range(3)]
    df = spark.createDataFrame(rows, "s string, id long, v double")
    per = Counter(r[0] for r in rows)
    for size in (0, 1, 50, 2000, 10_000):
        got = sampled(df, size)
        assert Counter(r[0] for r in got.elements()) == Counter({s: min(n, size) for s, n in per.items() if size})
        assert not got - Counter(rows)                     # no row more often than it stands in the table
        assert got == sampled(df.repartition(7), size)     # reruns and other partitions agree
        assert not got - sampled(df, size + 10)            # samples grow by rows
    assert sampled(df, 50) != sampled(df, 50, seed=2)
    share = sampled(df, F.ceil(F.col("n_rows") / 10))
    assert Counter(r[0] for r in share.elements()) == Counter({s: -(-n // 10) for s, n in per.items()})
    assert not sampled(df, F.lit(None).cast("int")) and not sampled(df.limit(0), 5)


def test_samples_are_fair(spark):
    df = spark.range(4000).select(F.lit("x").alias("s"), "id")
    taken = sorted(i for (_, i) in sampled(df, 1000))
    assert abs(sum(taken) / 1000 - 2000) < 150 and 400 < sum(i < 2000 for i in taken) < 600


def test_samples_gather_no_stratum(spark):
    """Windows run over counted cells and the last cell only, and raw rows
    are not shuffled by stratum."""
    t = Tables.from_dir(spark, SF001)
    plan = G.order_sample(t)._jdf.queryExecution().optimizedPlan().toString()
    part = plan.split("Window")[1:]
    assert part and all("Aggregate" in p for p in part)
    assert plan.count("rightHint=(strategy=broadcast)") == 2
