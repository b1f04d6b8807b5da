"""Operators over time: ties, nulls, empty tables, the split forms, plans;
and the stream against the batch."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF001, SF0001
from oracle import compare, duck
from relkit.catalog import BY_NAME
from relkit.operators import activity as T
from relkit.operators import timeline as L
from relkit.plans import streams as R
from relkit.sources import Tables, summary
from relkit.plans import procedures as P

SPLIT = {"t1_as_of_join": T.errors_after_purchases, "t2_trailing_window": T.trailing_spend,
         "t3_open_orders": T.open_orders, "t4_sessions": T.user_sessions}


@pytest.mark.parametrize("name", sorted(SPLIT))
def test_split_forms_match_duckdb(spark, name):
    ok, msg = compare(SPLIT[name](Tables.from_dir(spark, SF001), split=5), duck(SF001), BY_NAME[name].sql, 1e-9)
    assert ok, msg


@pytest.mark.parametrize("name", sorted(SPLIT))
@pytest.mark.parametrize("split", [0, 4])
def test_empty_tables(spark, name, split):
    t = Tables.from_dir(spark, SF0001)
    empty = Tables.from_frames(spark, **{n: t.table(n).limit(0) for n in ("events", "orders", "lineitem")})
    assert SPLIT[name](empty, split=split).count() == 0


def times(rng, n, span):
    return [rng.choice([None, *range(span)]) if rng.random() < 0.1 else rng.randrange(span) for _ in range(n)]


@pytest.mark.parametrize("split", [0, 7])
def test_as_of_join_with_ties_and_a_hot_key(spark, split):
    rng = random.Random(1)
    left = [(i, rng.choice([None, 1, 1, 1, 2, 3]), x) for i, x in enumerate(times(rng, 300, 60))]
    right = [(rng.choice([None, 1, 1, 1, 2]), x, rng.choice([None, i]), rng.choice([None, f"v{i}"]))
             for i, x in enumerate(times(rng, 200, 60))]
    l = spark.createDataFrame(left, "id int, k int, at int")
    r = spark.createDataFrame(right, "k int, seen int, n int, v string")
    got = sorted(map(tuple, L.as_of_join(l, r, ["k"], "at", "seen", "n", ["n", "v"], split).collect()), key=str)
    want = []
    for i, k, x in left:
        past = [(s, n, v) for rk, s, n, v in right if None not in (k, x, rk, s, n) and rk == k and s <= x]
        best = max(past, key=lambda p: p[:2], default=(None, None, None))
        want.append((i, k, x, best[1], best[2]))
    assert got == sorted(want, key=str)


@pytest.mark.parametrize("split", [0, 3])
def test_trailing_sums(spark, split):
    rng = random.Random(2)
    rows = [(i, rng.choice([None, 1, 1, 2]), x, rng.choice([None, 1, 5])) for i, x in enumerate(times(rng, 200, 40))]
    rows += [(900, 3, -7, 1), (901, 3, -10, 1), (902, 3, 0, 1)]
    df = spark.createDataFrame(rows, "id int, k int, x long, v long")
    got = {r.id: r.s for r in L.trailing_sums(df, ["k"], "x", 5, {"s": F.col("v")}, split).collect()}
    for i, k, x, _ in rows:
        own = [v for _, k2, x2, v in rows if k2 == k and (x2 is None if x is None else x2 is not None and x - 5 <= x2 <= x)]
        own = [v for v in own if v is not None]
        assert got[i] == (sum(own) if own else None)


@pytest.mark.parametrize("split", [0, 4])
def test_concurrent(spark, split):
    rows = [(1, 5), (1, 5), (2, 3), (5, 6), (4, None), (None, 9), (7, 7), (8, 2), (None, None)]
    got = sorted(map(tuple, L.concurrent(spark.createDataFrame(rows, "a int, b int"), "a", "b", split=split).collect()))
    assert got == [(1, 2, 0, 2), (2, 1, 0, 3), (3, 0, 1, 2), (4, 1, 0, 3), (5, 1, 2, 2), (6, 0, 1, 1)]


@pytest.mark.parametrize("split", [0, 6])
def test_sessions(spark, split):
    zero = dt.datetime(2024, 3, 31)
    rng = random.Random(3)
    rows = [(i, rng.choice([None, "u", "u", "u", "w"]), zero + dt.timedelta(seconds=rng.randrange(4000))) for i in range(120)]
    rows += [(500 + i, "x", zero + dt.timedelta(seconds=s)) for i, s in enumerate([0, 60, 120, 181, 181])] + [(600, "u", None)]
    df = spark.createDataFrame(rows, "id int, u string, ts timestamp_ntz")
    got = sorted(((r.u, r.session_start, r.session_end, r.n) for r in
                  L.sessions(df, ["u"], "ts", 60, [F.count(F.lit(1)).alias("n")], "id", split).collect()), key=str)
    want = []
    for u in {r[1] for r in rows}:
        run = []
        for x in sorted(r[2] for r in rows if r[1] == u and r[2] is not None):
            if run and (x - run[-1]).total_seconds() > 60:
                want.append((u, run[0], run[-1], len(run)))
                run = []
            run.append(x)
        want.append((u, run[0], run[-1], len(run)))
    assert got == sorted(want, key=str)


def test_microseconds_do_not_depend_on_the_zone(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 31, 2, 30, 0, 5),), (dt.datetime(1960, 1, 2, 3, 4, 5, 6),)], "ts timestamp_ntz")
    epoch = dt.datetime(1970, 1, 1)
    want = {(r.ts - epoch) // dt.timedelta(microseconds=1) for r in df.collect()}
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        assert {r[0] for r in df.select(L.micros("ts")).collect()} == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_properties_of_any_shape(spark):
    rows = [("a", '{"k": 1}'), ("a", '{"k": "2.5", "m": {"deep": [1, 2]}}'), ("a", None), ("a", "{broken"), ("a", ""),
            ("a", "[1, 2]"), ("a", "{}"), ("a", '{"k": null}'), (None, '{"k": true}'), ("b", "5")]
    t = Tables.from_frames(spark, events=spark.createDataFrame(rows, "event_type string, props string"))
    got = {(r.event_type, r.key): (r.n_events, r.n_missing, r.n_malformed, r.n_numbers, r.total) for r in T.event_properties(t).collect()}
    assert got == {("a", "k"): (3, 0, 0, 2, 3.5), ("a", "m"): (1, 0, 0, 0, None), ("a", None): (5, 1, 3, 0, None),
                   (None, "k"): (1, 0, 0, 0, None), ("b", None): (1, 0, 1, 0, None)}


def event(i, day, hour, value=1.0):
    return (i, dt.datetime(2024, 1, 1) + dt.timedelta(days=day, hours=hour), 1, "view", value, None)


def test_stream_takes_late_rows_within_the_watermark_and_restarts(spark, tmp_path):
    source, out, state = (f"{tmp_path}/{x}" for x in ("in", "out", "state"))
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"

    def arrive(*rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(source)

    def told():
        return sorted((r.day.day, r.n_events) for r in R.stream_totals(spark, source, out, state, files_per_batch=1).collect())

    arrive(event(1, 0, 1), event(2, 0, 23), event(3, 1, 0.5))
    assert told() == []                                       # day 1 may still get late rows
    arrive(event(4, 0, 23.9), event(5, 1, 2), (9, None, 1, "view", 1.0, None))
    assert told() == [(1, 3)]                                 # a late row within the delay is in
    assert told() == [(1, 3)]                                 # nothing new: nothing is counted twice
    arrive(event(6, 0, 5), event(7, 2, 3))
    assert told() == [(1, 3), (2, 2)]                         # a row behind the watermark is not


def test_no_raw_shuffle_by_few_keys(spark):
    """With automatic broadcasts off, J8 and S7 deal no customers by a
    handful of keys."""
    t = Tables.from_dir(spark, SF001)
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        for k in old:
            spark.conf.set(k, "-1")
        for name in ("j8_range_join", "s7_correlated_subquery"):
            plan = BY_NAME[name].build(t)._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan, name
        for name in ("t1_as_of_join", "t3_open_orders"):
            assert "NestedLoop" not in BY_NAME[name].build(t)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_overlapping_refreshes_of_one_year(spark, tmp_path, monkeypatch):
    t, base = Tables.from_dir(spark, SF0001), f"{tmp_path}/summary"
    P.refresh_order_summary(t, base)
    seen = {}
    plain = summary.versions

    def overlapped(spark, b):
        found = plain(spark, b)
        if not seen:                      # another refresh runs right after this one has read its base
            seen["v"] = found
            P.refresh_order_summary(t, base, 1996)
        return found

    monkeypatch.setattr(P, "versions", overlapped)
    with pytest.raises(summary.ConcurrentWrite):
        P.refresh_order_summary(t, base, 1995)
    assert len(plain(spark, base)) == 2
    monkeypatch.setattr(P, "versions", plain)
    got = P.refresh_order_summary(t, base, 1995)
    assert sorted(map(str, got.collect())) == sorted(map(str, P.order_summary(t).select(got.columns).collect()))
