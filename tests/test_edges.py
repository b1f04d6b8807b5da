"""Null keys, null values, duplicate keys, hot keys and empty inputs on
hand-made tables, with the expected rows worked out independently
(Spark's plain operators, or a brute-force Python check)."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from oracle import rows_of
from relkit.operators import analytics as A
from relkit.operators import joins as J
from relkit.operators import select as S
from relkit.operators.scan import exact_median, ntile_within, rank_within, running_sum
from relkit.plans.skew import hot_keys
from relkit.plans.strategies import band_join, left_outer_join, not_in, right_outer_join
from relkit.sources import Tables


def same(a, b):
    return rows_of(a.toPandas()) == rows_of(b.toPandas())


CUST = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
ORD = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
       "o_orderdate timestamp_ntz, o_orderpriority string")
D = dt.datetime


@pytest.fixture()
def small(spark):
    customer = spark.createDataFrame([
        (1, "a", 0, 100.0, "AUTO"),
        (2, "b", 0, -5.0, "AUTO"),
        (3, "c", 1, None, None),
        (None, "nullkey", 1, 50.0, "HOUSE"),
        (4, "d", None, 10.0, "HOUSE"),
    ], CUST)
    orders = spark.createDataFrame([
        (10, 1, "O", 400000.0, D(1996, 1, 1), "1-URGENT"),
        (11, 1, "F", 500000.0, D(1996, 2, 1), "2-HIGH"),
        (12, 2, "O", 10.0, D(1996, 2, 1), "1-URGENT"),
        (13, None, "P", 350000.0, D(1997, 3, 1), "1-URGENT"),
        (14, 9, "O", 310000.0, D(1997, 3, 1), "3-MEDIUM"),   # no such customer
    ], ORD)
    return Tables.from_frames(spark, customer=customer, orders=orders)


# ---- join strategies against Spark's own joins --------------------------

def test_left_outer_join_matches_native(spark):
    l = spark.createDataFrame([(1, "x"), (1, "y"), (None, "n"), (2, "z"), (5, "w")], "lk int, lv string")
    r = spark.createDataFrame([(1, "p"), (1, "q"), (None, "rn"), (3, "s")], "rk int, rv string")
    got = left_outer_join(l, r, [("lk", "rk")])
    want = l.join(r, F.col("lk") == F.col("rk"), "left")
    assert got.count() == 7
    assert same(got, want)


def test_left_outer_join_empty_right(spark):
    l = spark.createDataFrame([(1, "x"), (None, "n")], "lk int, lv string")
    r = spark.createDataFrame([], "rk int, rv string")
    assert same(left_outer_join(l, r, [("lk", "rk")]), l.join(r, F.col("lk") == F.col("rk"), "left"))


def test_right_outer_join_matches_native(spark):
    l = spark.createDataFrame([(1, "x"), (1, "y"), (None, "n")], "lk int, lv string")
    r = spark.createDataFrame([(1, "p"), (None, "rn"), (3, "s")], "rk int, rv string")
    got = right_outer_join(l, r, [("lk", "rk")])
    assert got.columns == ["lk", "lv", "rk", "rv"]
    assert same(got, l.join(r, F.col("lk") == F.col("rk"), "right"))


def test_left_outer_join_refuses_clashing_names(spark):
    l = spark.createDataFrame([(1,)], "k int")
    with pytest.raises(ValueError):
        left_outer_join(l, l, [("k", "k")])


@pytest.mark.parametrize("width", [5.0, 0.5, 7.25])
def test_band_join_matches_brute_force(spark, width):
    rnd = random.Random(7)
    xs = [round(rnd.uniform(-30, 30), 2) for _ in range(120)] + [0.0, 5.0, -5.0, 10.0, None]
    ys = [round(rnd.uniform(-30, 30), 2) for _ in range(40)] + [0.0, 5.0, -10.0, None]
    l = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "li int, x double")
    r = spark.createDataFrame([(j, y) for j, y in enumerate(ys)], "rj int, y double")
    got = sorted((row.li, row.rj) for row in band_join(l, r, "x", "y", width).collect())
    want = sorted((i, j) for i, x in enumerate(xs) for j, y in enumerate(ys)
                  if x is not None and y is not None and abs(x - y) <= width)
    assert got == want


def test_band_join_rejects_bad_width(spark):
    l = spark.createDataFrame([(1.0,)], "x double")
    with pytest.raises(ValueError):
        band_join(l, l.withColumnRenamed("x", "y"), "x", "y", 0)


# ---- distributed scans against the plain window / aggregate -------------

def _hot_rows(spark, n=3000, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        # key 0 holds a third of the rows; some null keys and null values
        k = 0 if i % 3 == 0 else (None if i % 97 == 0 else rnd.randint(1, 40))
        v = None if i % 53 == 0 else round(rnd.uniform(-100, 100), 2)
        rows.append((k, i, v))
    return spark.createDataFrame(rows, "k int, seq int, v double")


@pytest.mark.parametrize("chunks", [1, 3, 8, 13])
def test_running_sum_matches_window(spark, chunks):
    df = _hot_rows(spark)
    w = Window.partitionBy("k").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("run", F.round(F.sum("v").over(w), 6))
    got = running_sum(df, ["k"], ["seq"], "v", "run", chunks=chunks, split=True) \
        .withColumn("run", F.round("run", 6))
    assert same(got.select(*want.columns), want)


@pytest.mark.parametrize("chunks", [2, 5, 8])
def test_running_sum_two_keys_with_nulls(spark, chunks):
    rnd = random.Random(5)
    rows = []
    for i in range(2000):
        k1 = "hot" if i % 2 == 0 else rnd.choice(["a", "b", None])
        k2 = None if i % 7 == 0 else rnd.randint(0, 3)
        rows.append((k1, k2, rnd.randint(0, 50), i, float(rnd.randint(-9, 9))))
    df = spark.createDataFrame(rows, "k1 string, k2 int, day int, seq int, v double")
    w = (Window.partitionBy("k1", "k2").orderBy(F.col("day").desc(), "seq")
         .rowsBetween(Window.unboundedPreceding, 0))
    want = df.withColumn("run", F.sum("v").over(w))
    got = running_sum(df, ["k1", "k2"], [F.col("day").desc(), "seq"], "v", "run", chunks=chunks,
                      split=True)
    assert same(got.select(*want.columns), want)


def test_running_sum_splits_hot_key(spark):
    df = _hot_rows(spark)
    got = running_sum(df, ["k"], ["seq"], "v", "run", chunks=8, split=True)
    # the hot key's rows land in several range chunks
    chunks = (df.repartitionByRange(8, "k", "seq")
                .where(F.col("k") == 0)
                .select(F.spark_partition_id().alias("p")).distinct().count())
    assert chunks >= 3
    assert got.count() == df.count()


def test_hot_keys_exact(spark):
    df = _hot_rows(spark)           # key 0: a third of the rows
    assert [r.k for r in hot_keys(df, ["k"], max_rows=df.count() // 8)] == [0]
    assert hot_keys(df, ["k"], max_rows=df.count() // 2) == []
    # a key above its share but below a task's worth of rows is not hot
    assert hot_keys(df, ["k"], max_rows=1000) == []
    assert hot_keys(df, ["k"]) == []
    nulls = spark.createDataFrame([(None, 1)] * 6 + [(1, 2)] * 2, "k int, v int")
    assert [r.k for r in hot_keys(nulls, ["k"], max_rows=nulls.count() // 2)] == [None]


def test_running_sum_auto_picks_form(spark, monkeypatch):
    import relkit.plans.skew as skew
    monkeypatch.setattr(skew, "TASK_ROWS", 50)
    hot = _hot_rows(spark)
    assert "_rk_chunk" in _plan(running_sum(hot, ["k"], ["seq"], "v", "run", chunks=8))
    even = spark.range(4000).select((F.col("id") % 500).alias("k"), F.col("id").alias("seq"),
                                    F.col("id").cast("double").alias("v"))
    assert "_rk_chunk" not in _plan(running_sum(even, ["k"], ["seq"], "v", "run", chunks=8))
    # both forms agree
    a = running_sum(even, ["k"], ["seq"], "v", "run", chunks=8)
    b = running_sum(even, ["k"], ["seq"], "v", "run", chunks=8, split=True)
    assert same(a, b.select(*a.columns))


def _plan(df):
    return df._jdf.queryExecution().analyzed().toString()


def test_running_sum_all_null_values(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, None), (2, 1, 3.0)], "k int, seq int, v double")
    got = {(r.k, r.seq): r.run
           for r in running_sum(df, ["k"], ["seq"], "v", "run", chunks=3, split=True).collect()}
    assert got == {(1, 1): None, (1, 2): None, (2, 1): 3.0}


def test_running_sum_integer_values_stay_integer(spark):
    df = spark.createDataFrame([(1, i, i) for i in range(10)], "k int, seq int, v bigint")
    out = running_sum(df, ["k"], ["seq"], "v", "run", chunks=4, split=True)
    assert dict(out.dtypes)["run"] == "bigint"
    assert sorted(r.run for r in out.collect()) == [sum(range(i + 1)) for i in range(10)]


def test_exact_median_matches_builtin(spark):
    rnd = random.Random(11)
    rows = [("hot", float(rnd.randint(0, 50))) for _ in range(900)]
    rows += [("odd", v) for v in (3.0, 1.0, 2.0)]
    rows += [("even", v) for v in (4.0, 1.0, 3.0, 2.0)]
    rows += [("dups", 5.0)] * 4 + [("dups", 7.0)]
    rows += [("nulls", None), ("nulls", None)]
    rows += [(None, 1.0), (None, 9.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    want = {r.g: r.m for r in df.groupBy("g").agg(F.median("v").alias("m")).collect()}
    for split in (True, False, None):
        got = {r.g: r.m for r in exact_median(df, ["g"], "v", "m", chunks=5, split=split).collect()}
        assert got == want
    assert got["even"] == 2.5 and got["odd"] == 2.0 and got["nulls"] is None and got[None] == 5.0


# ---- the queries on hand-made tables with nulls ---------------------------

def test_semi_and_anti_join_with_null_keys(small):
    have = {r.c_custkey for r in J.customers_with_big_order(small).collect()}
    lack = {r.c_custkey for r in J.customers_without_big_order(small).collect()}
    assert have == {1}
    # NOT EXISTS keeps the customer whose key is null
    assert lack == {2, 3, 4, None}


def test_left_and_right_join_queries_keep_unmatched_customers(small):
    left = sorted((r.c_custkey or -1, r.o_orderkey or -1)
                  for r in J.customers_left_join_big_orders(small).collect())
    assert left == [(-1, -1), (1, 10), (1, 11), (2, -1), (3, -1), (4, -1)]
    right = sorted((r.c_custkey or -1, r.o_orderkey or -1)
                   for r in J.big_orders_right_join_customers(small).collect())
    assert right == left


def test_count_if_and_distinct_with_nulls(small):
    got = {r.c_mktsegment: (r.n_negative, r.n_customers)
           for r in A.negative_balances(small).collect()}
    assert got == {"AUTO": (1, 2), None: (0, 1), "HOUSE": (0, 2)}


def test_scalar_subquery_ignores_null_balance(small):
    # avg over non-null balances = (100 - 5 + 50 + 10) / 4 = 38.75
    got = {r.c_custkey for r in S.above_average_balance(small).collect()}
    assert got == {1, None}


def test_top_orders_tie_break(spark, small):
    o = small.orders.union(spark.createDataFrame(
        [(9, 1, "O", 500000.0, D(1996, 2, 1), "2-HIGH")], ORD))
    t = Tables.from_frames(spark, orders=o)
    keys = [r.o_orderkey for r in S.top_orders(t, 3).collect()]
    assert keys == [9, 11, 10]


def test_running_total_query_on_small_orders(small):
    got = {r.o_orderkey: r.running_total for r in A.running_customer_spend(small).collect()}
    assert got == {10: 400000.0, 11: 900000.0, 12: 10.0, 13: 350000.0, 14: 310000.0}


def test_empty_orders(spark):
    t = Tables.from_frames(spark, orders=spark.createDataFrame([], ORD))
    assert A.order_totals(t).collect()[0].n_orders == 0
    assert A.order_totals(t).collect()[0].total_price is None
    assert A.monthly_totals(t).count() == 0
    assert A.running_customer_spend(t).count() == 0


@pytest.mark.parametrize("split", [True, False])
@pytest.mark.parametrize("descending", [True, False])
def test_rank_within_matches_window_functions(spark, split, descending):
    rnd = random.Random(21)
    rows = []
    for i in range(600):
        k = "hot" if i % 2 == 0 else rnd.choice(["a", "b", None])
        v = None if i % 41 == 0 else float(rnd.randint(0, 30))      # many ties
        rows.append((i, k, v))
    df = spark.createDataFrame(rows, "id int, k string, v double")
    order = F.col("v").desc() if descending else F.col("v").asc()
    w = Window.partitionBy("k").orderBy(order)
    want = df.select("id", "k", "v", F.rank().over(w).cast("bigint").alias("rank"),
                     F.dense_rank().over(w).cast("bigint").alias("dense_rank"),
                     F.percent_rank().over(w).alias("percent_rank"),
                     F.cume_dist().over(w).alias("cume_dist"))
    got = rank_within(df, ["k"], "v", descending=descending, chunks=4, split=split)
    assert same(got.select(*want.columns), want)


def test_rank_within_single_row_group(spark):
    df = spark.createDataFrame([(1, "x", 5.0)], "id int, k string, v double")
    r = rank_within(df, ["k"], "v", split=True, chunks=2).collect()[0]
    assert (r["rank"], r["dense_rank"], r["percent_rank"]) == (1, 1, 0.0)


def test_running_sum_several_values(spark):
    df = _hot_rows(spark).withColumn("one", F.lit(1))
    w = Window.partitionBy("k").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumns({"run": F.round(F.sum("v").over(w), 6), "cnt": F.sum("one").over(w)})
    for split in (True, False):
        got = running_sum(df, ["k"], ["seq"], ["v", "one"], ["run", "cnt"], chunks=5, split=split) \
            .withColumn("run", F.round("run", 6))
        assert same(got.select(*want.columns), want)


@pytest.mark.parametrize("right_rows", [
    [(1,), (2,)],                 # no null
    [(1,), (None,)],              # a null: nothing passes
    [],                           # empty: everything passes, null included
    [(None,)],
])
def test_not_in_matches_sql_not_in(spark, right_rows):
    left = spark.createDataFrame([(1,), (3,), (None,), (4,)], "a int")
    right = spark.createDataFrame(right_rows, "b int")
    left.createOrReplaceTempView("not_in_left")
    right.createOrReplaceTempView("not_in_right")
    want = spark.sql("SELECT a FROM not_in_left WHERE a NOT IN (SELECT b FROM not_in_right)")
    got = not_in(left, "a", right, "b")
    assert same(got, want)


def test_not_in_query_with_null_order_key(spark, small):
    # an order above 300000 without a customer key: NOT IN keeps nobody,
    # NOT EXISTS still keeps the customers without big orders
    assert J.customers_not_in_big_order_keys(small).count() == 0
    assert J.customers_without_big_order(small).count() == 4


@pytest.mark.parametrize("buckets", [1, 3, 4, 7, 50])
@pytest.mark.parametrize("split", [True, False])
def test_ntile_matches_window_function(spark, buckets, split):
    rnd = random.Random(buckets)
    rows = [(i, "hot" if i % 2 else rnd.choice(["a", "b", None]), float(rnd.randint(0, 9)))
            for i in range(203)]
    df = spark.createDataFrame(rows, "id int, k string, v double")
    order = [F.col("v").desc(), F.col("id")]
    w = Window.partitionBy("k").orderBy(*order)
    want = df.withColumn("ntile", F.ntile(buckets).over(w).cast("bigint"))
    got = ntile_within(df, ["k"], order, buckets, chunks=4, split=split)
    assert same(got.select(*want.columns), want)


def test_band_join_non_finite_and_huge_values(spark):
    inf, nan = float("inf"), float("nan")
    xs = [nan, 1.0, inf, -inf, 1e300, 1e300 + 0.0, -1e300, 9.3e18 * 5, None]
    ys = [nan, 3.0, inf, -inf, 1e300, -1e300, 9.3e18 * 5 + 4096]
    l = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "li int, x double")
    r = spark.createDataFrame([(j, y) for j, y in enumerate(ys)], "rj int, y double")
    l.createOrReplaceTempView("band_l")
    r.createOrReplaceTempView("band_r")
    want = sorted(tuple(x) for x in spark.sql(
        "SELECT li, rj FROM band_l JOIN band_r ON abs(x - y) <= 5000").collect())
    got = sorted((row.li, row.rj) for row in band_join(l, r, "x", "y", 5000.0).collect())
    assert got == want
    assert (1, 1) in got and (4, 4) in got


@pytest.mark.parametrize("split", [True, False])
def test_running_sum_without_keys(spark, split):
    df = spark.range(500).select(F.col("id").alias("seq"),
                                 F.when(F.col("id") % 11 == 0, None)
                                  .otherwise((F.col("id") % 7).cast("double")).alias("v"))
    w = Window.orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("run", F.sum("v").over(w))
    got = running_sum(df, [], ["seq"], "v", "run", chunks=5, split=split)
    assert same(got.select(*want.columns), want)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_pivot_counts_other_statuses(spark):
    t = Tables.from_frames(spark, orders=spark.createDataFrame(
        [(1, 1, s, 1.0, None, "x") for s in ("F", "O", "X", None, "X")],
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"))
    r = A.orders_by_year_and_status(t).collect()[0]
    assert (r.n_f, r.n_o, r.n_p, r.n_other) == (1, 1, 0, 3)
    r = A.orders_by_year_and_status(t, ["X"]).collect()[0]
    assert (r.n_x, r.n_other) == (2, 3)


def test_band_join_keeps_pairs_at_bucket_edges(spark):
    import itertools
    import math
    width = 5.0
    base = [0.0, 5.0, 7.5, 15.0, 1e6, 12345.67]
    near = sorted({f(b + d) for b in base for d in (-width, 0.0, width) for f in (
        lambda x: x, lambda x: math.nextafter(x, -math.inf), lambda x: math.nextafter(x, math.inf))} | {-1e-17, 1e-17})
    left = spark.createDataFrame([(i, v) for i, v in enumerate(near)], "li long, x double")
    right = spark.createDataFrame([(i, v) for i, v in enumerate(near)], "rj long, y double")
    got = sorted((r.li, r.rj) for r in band_join(left, right, "x", "y", width).collect())
    want = sorted((i, j) for (i, x), (j, y) in itertools.product(enumerate(near), repeat=2) if abs(x - y) <= width)
    assert got == want


def test_bracket_join_is_linear_and_exact(spark):
    import math
    edge = [1000.0, math.nextafter(1000.0, 0), math.nextafter(1000.0, 2000), -0.0, -1e-17, 1999.99, None]
    t = Tables.from_frames(
        spark, customer=spark.createDataFrame([(i, v) for i, v in enumerate(edge)], "c_custkey long, c_acctbal double"),
        supplier=spark.createDataFrame([(i, v) for i, v in enumerate([5.0, 10.0, 1500.0, -3.0, None])],
                                       "s_suppkey long, s_acctbal double"))
    got = {r.c_custkey: (r.bracket_low, r.n_suppliers) for r in J.balance_brackets(t).collect()}
    assert got == {0: (1000.0, 1), 1: (0.0, 2), 2: (1000.0, 1), 3: (0.0, 2), 4: (-1000.0, 1), 5: (1000.0, 1)}


def _filled(spark, *rows):
    t = Tables.from_frames(spark, orders=spark.createDataFrame(
        [(i, 1, "O", total, day, "1-URGENT") for i, (day, total) in enumerate(rows)], ORD))
    return sorted(tuple(r) for r in A.filled_months(t, 100.0).collect())


def test_filled_months_hold_the_months_without_orders(spark):
    got = _filled(spark, (D(2020, 11, 30, 23, 59), 150.0), (D(2021, 2, 1), 200.0), (D(2021, 2, 28), 101.5),
                  (D(2021, 1, 5), 100.0), (D(2021, 9, 1), 3.0), (None, 900.0), (D(2025, 1, 1), None))
    assert got == [(2020, 11, 1, 150.0), (2020, 12, 0, 0.0), (2021, 1, 0, 0.0), (2021, 2, 2, 301.5)]


def test_filled_months_without_orders_and_of_one_month(spark):
    assert _filled(spark) == []
    assert _filled(spark, (D(2021, 2, 1), 100.0), (None, 900.0)) == []
    assert _filled(spark, (D(2021, 12, 1), 101.0), (D(2021, 12, 1), 101.0)) == [(2021, 12, 2, 202.0)]


def test_filled_months_of_a_long_span_end(spark):
    # 4000 years: 16 levels, far below Spark's limit of 100
    got = _filled(spark, (D(3, 1, 1), 101.0), (D(4002, 12, 1), 102.0))
    assert [(y, m) for y, m, _, _ in got] == [(y, m) for y in range(3, 4003) for m in range(1, 13)]
    assert sum(n for _, _, n, _ in got) == 2
