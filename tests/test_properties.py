"""Property tests: the custom operators against brute force on random
small inputs (nulls, NaN, duplicates, hot keys, empty tables)."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from relkit.operators.scan import exact_median, running_sum
from relkit.plans.strategies import band_join

SETTINGS = settings(max_examples=12, deadline=None, derandomize=True,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

money = st.one_of(st.none(),
                  st.integers(min_value=-5000, max_value=5000).map(lambda c: c / 100))


@SETTINGS
@given(xs=st.lists(money, max_size=40), ys=st.lists(money, max_size=15),
       width=st.sampled_from([0.5, 1.0, 5.0, 12.5]))
def test_band_join_is_the_brute_force_pairs(spark, xs, ys, width):
    l = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "li int, x double")
    r = spark.createDataFrame([(j, y) for j, y in enumerate(ys)], "rj int, y double")
    got = sorted((row.li, row.rj) for row in band_join(l, r, "x", "y", width).collect())
    want = sorted((i, j) for i, x in enumerate(xs) for j, y in enumerate(ys)
                  if x is not None and y is not None and abs(x - y) <= width)
    assert got == want


rows = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)),        # key, often repeated
                          st.one_of(st.none(), st.integers(-50, 50))),    # value
                max_size=60)


@SETTINGS
@given(data=rows, chunks=st.integers(1, 6), split=st.booleans())
def test_running_sum_is_the_prefix_sum(spark, data, chunks, split):
    df = spark.createDataFrame([(k, i, v) for i, (k, v) in enumerate(data)],
                               "k int, seq int, v bigint")
    got = {r.seq: r.run for r in
           running_sum(df, ["k"], ["seq"], "v", "run", chunks=chunks, split=split).collect()}
    want, acc, seen = {}, {}, {}
    for i, (k, v) in enumerate(data):
        if v is not None:
            acc[k] = acc.get(k, 0) + v
            seen[k] = True
        want[i] = acc[k] if seen.get(k) else None
    assert got == want


@SETTINGS
@given(data=st.lists(st.tuples(st.sampled_from(["a", "b", None]),
                               st.one_of(st.none(), st.integers(-20, 20).map(float),
                                         st.just(math.nan))),
                     max_size=50),
       split=st.booleans())
def test_exact_median_is_the_middle(spark, data, split):
    df = spark.createDataFrame(data, "g string, v double")
    got = {r.g: r.m for r in exact_median(df, ["g"], "v", "m", chunks=3, split=split).collect()}
    groups = {g for g, _ in data}
    # NaN sorts above every number, as in Spark
    key = lambda v: (math.isnan(v), v)
    want = {}
    for g in groups:
        vals = sorted((v for gg, v in data if gg == g and v is not None), key=key)
        if not vals:
            want[g] = None
        else:
            n = len(vals)
            want[g] = (vals[(n - 1) // 2] + vals[n // 2]) / 2
    assert set(got) == set(want)
    for g in want:
        a, b = got[g], want[g]
        assert (a is None and b is None) or (a == b) or (math.isnan(a) and math.isnan(b))
    builtin = {r.g: r.m for r in df.groupBy("g").agg(F.median("v").alias("m")).collect()}
    for g in want:
        a, b = got[g], builtin[g]
        assert (a is None and b is None) or (a == b) or (math.isnan(a) and math.isnan(b))
