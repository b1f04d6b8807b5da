"""Mixing: quotas, the flow against a linear search, and exact sums."""

import itertools
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from relkit.llm import mix_flow as X


def cost(taken, cap):
    """Convex repetition cost of a pattern's words."""
    return sum(max(0, min(taken - k * cap, cap)) * k for k in range(9))


def best_by_search(cap, quota, copies):
    """Largest flow and its least cost, over all whole-number flows."""
    arcs = [(p, s) for p in cap for s in p]
    best = (0, 0)
    for amounts in itertools.product(*[range(min(copies * cap[p], quota[s]) + 1) for p, s in arcs]):
        by_p, by_s = dict.fromkeys(cap, 0), dict.fromkeys(quota, 0)
        for (p, s), a in zip(arcs, amounts):
            by_p[p] += a
            by_s[s] += a
        if all(by_p[p] <= copies * cap[p] for p in cap) and all(by_s[s] <= quota[s] for s in quota):
            best = max(best, (sum(amounts), -sum(cost(by_p[p], cap[p]) for p in cap)))
    return best


@pytest.mark.parametrize("seed", range(12))
def test_route_is_a_min_cost_flow(seed):
    rng = random.Random(seed)
    cap = {p: rng.randrange(1, 4) for p in rng.sample([("a",), ("b",), ("a", "b"), ("b", "c"), ("c",)], 3)}
    quota = {s: rng.randrange(0, 5) for p in cap for s in p}
    got = X.route(cap, quota, 2)
    assert all(got[p] <= 2 * cap[p] for p in cap)
    assert (sum(got.values()), -sum(cost(got[p], cap[p]) for p in cap)) == best_by_search(cap, quota, 2)


def test_single_sources_come_to_their_targets(spark):
    rng = random.Random(2)
    docs = [(i, " ".join("w" * rng.randrange(1, 4) for _ in range(rng.choice([0, 3, 40, 900]))),
             rng.choice(["a", "a", "a", "b", "c", "d", None])) for i in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumns(
        {"size": F.lit("clash"), "hash": F.lit(0), "key": F.lit(1)})
    rows = X.mixed_table(df).collect()
    assert len(rows) == len(docs) and sorted(map(tuple, X.mixed_table(df).collect())) == sorted(map(tuple, rows))
    source = {d: s for d, _, s in docs}
    taken, target, size = {}, {}, {}
    for r in rows:
        s = source[r.doc_id]
        taken[s] = taken.get(s, 0) + r.taken
        size[s] = size.get(s, 0) + r.size
        target[s] = r.target
        assert 0 <= r.taken <= 2 * r.size
        assert r.size == len(docs[r.doc_id][1].split())
    total = sum(size.values())
    assert abs(sum(target.values()) - 1.5 * total) < 1e-6
    for s in target:
        assert taken[s] == int(target[s] + 0.5) and target[s] <= 2 * size[s]
    free = [s for s in target if target[s] < 2 * size[s]]
    weight = dict(zip(["a", "b", "c", "d", None], [5, 2, 1, 5, 2]))
    assert len({round(target[s] / weight[s], 6) for s in free}) == 1


def test_overlapping_sources(spark):
    docs = [(i, "x " * 10, ["a"] if i % 3 else ["a", "b"]) for i in range(60)] + [(99, "y " * 10, []), (98, "z", None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source array<string>")
    got = X.mix(df, weights=(1,), share=Fraction(1))
    target = {r.source: r.target for r in got.targets.collect()}
    taken = {}
    for r in got.documents.collect():
        taken[tuple(r.members or ())] = taken.get(tuple(r.members or ()), 0) + r.taken
    assert taken[()] == 0
    assert sum(taken.values()) == sum(int(t + 0.5) for t in target.values())


def test_route_of_many_memberships():
    """A network of over 100,000 memberships, against the bound of its cuts."""
    rng = random.Random(1)
    sources = range(300)
    cap = {}
    while sum(map(len, cap)) <= 110_000:
        cap[tuple(sorted(rng.sample(sources, rng.choice([1, 2, 3, 4]))))] = rng.randrange(1, 50)
    total = sum(cap.values())
    quota = {s: total * 3 // 2 // 300 for s in sources}
    got = X.route(cap, quota, 2)
    assert all(got[p] <= 2 * cap[p] for p in cap) and sum(got.values()) == sum(quota.values())
    assert sum(min(got[p], cap[p]) for p in cap) == total              # nothing is repeated before all is taken


def test_components_of_sources_are_solved_apart(spark):
    rng = random.Random(4)
    docs = []
    for i in range(600):
        block = i % 6
        docs.append((i, "x " * rng.randrange(1, 30), rng.sample([f"{block}{c}" for c in "abc"], rng.choice([1, 1, 2]))))
    df = spark.createDataFrame(docs, "doc_id long, text string, source array<string>")
    got = X.mix(df, weights=(1, 2), share=Fraction(1))
    cap, taken = {}, {}
    for r in got.documents.collect():
        cap[tuple(r.members)] = cap.get(tuple(r.members), 0) + r.size
        taken[tuple(r.members)] = taken.get(tuple(r.members), 0) + r.taken
    quota = {r.source: int(r.target + 0.5) for r in got.targets.collect()}
    want = X.route(cap, quota, 2)
    assert sum(want.values()) == sum(taken.values())
    assert sum(cost(want[p], cap[p]) for p in cap) == sum(cost(taken[p], cap[p]) for p in cap)


def test_documents_without_an_id_meet_the_target(spark):
    rows = [(None, f"w{i} " * 10, "a") for i in range(100)] + [(None, "same " * 10, "b")] * 40 + [(1, "one " * 10, "c")] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {}
    for r in X.mixed_documents(df).collect():
        out[r.source] = out.get(r.source, 0) + len(r.text.split())
    target = {r.source: r.target for r in X.mix(df).targets.collect()}
    assert all(abs(out[s] - target[s]) <= 10 for s in target)


def test_nulls_repeats_and_empty_tables(spark):
    rows = [(None, "a b", "s"), (1, None, "s"), (1, "a b c", "s"), (1, "a b c", "s"), (2, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = X.mixed_table(df).collect()
    assert sorted((r.doc_id or 0, r.size) for r in got) == [(0, 2), (1, 0), (1, 3), (1, 3), (2, 0)]
    assert sum(r.taken for r in got) == 12
    assert X.mixed_table(df.limit(0)).count() == 0
    mixed = X.mixed_documents(df)
    assert mixed.columns == df.columns and X.mixed_documents(df.limit(0)).count() == 0
