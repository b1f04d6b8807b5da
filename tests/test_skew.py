"""The queries on data with one hot key: a third of all orders moved to
one customer (derived from the test tables by Spark).  Results must
equal the plain forms; the split path is forced by lowering the
task-size bound."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF001
from oracle import rows_of
from relkit.operators import analytics as A
from relkit.operators import joins as J
from relkit.plans import skew
from relkit.sources import Tables


@pytest.fixture(scope="module")
def skewed(spark):
    base = Tables.from_dir(spark, SF001)
    orders = base.orders.withColumn(
        "o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(7)).otherwise(F.col("o_custkey")))
    return Tables.from_frames(spark, orders=orders, customer=base.customer,
                              nation=base.nation, region=base.region, lineitem=base.lineitem)


def same(a, b):
    return rows_of(a.toPandas()) == rows_of(b.toPandas())


def eager_split(monkeypatch):
    """Split any key of more than 1,500 rows."""
    monkeypatch.setattr(skew, "TASK_ROWS", 1500)


def test_hot_customer_is_found(skewed):
    hot = skew.hot_keys(skewed.orders, ["o_custkey"], max_rows=2000)
    assert [r.o_custkey for r in hot] == [7]


@pytest.mark.parametrize("bound", [2000, 4000])
def test_hot_customer_is_found_in_a_sample(skewed, monkeypatch, bound):
    """The production branch: candidates from a sample, counted exactly."""
    monkeypatch.setattr(skew, "SAMPLE_ROWS", 3000)
    hot = skew.hot_keys(skewed.orders, ["o_custkey"], max_rows=bound)
    assert [r.o_custkey for r in hot] == [7]
    assert skew.hot_keys(skewed.orders, ["o_custkey"], max_rows=9000) == []


@pytest.mark.parametrize("partitions", [1, 4, 8, 200])
def test_split_rule_does_not_depend_on_the_partitions(spark, skewed, monkeypatch, partitions):
    monkeypatch.setattr(skew, "TASK_ROWS", 1500)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        chunks = skew.split_chunks(skewed.orders, ["o_custkey"])
        assert chunks >= max(partitions, 10)
        assert skew.split_chunks(skewed.orders, []) == chunks
        assert skew.split_chunks(skewed.customer, ["c_custkey"]) == 0
        got = A.spend_pareto(skewed)
        assert "_rk_chunk" in got._jdf.queryExecution().analyzed().toString()
        rows = got.count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert rows == skewed.orders.select("o_custkey").distinct().count()


def test_running_total_splits_hot_customer(skewed, monkeypatch):
    eager_split(monkeypatch)
    got = A.running_customer_spend(skewed)
    assert "_rk_chunk" in got._jdf.queryExecution().analyzed().toString()
    w = (Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
         .rowsBetween(Window.unboundedPreceding, 0))
    want = skewed.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice",
                                F.round(F.sum("o_totalprice").over(w), 2).alias("running_total"))
    assert same(got, want)


def test_outer_joins_with_hot_customer(skewed):
    c, o = skewed.customer, skewed.orders.where(F.col("o_totalprice") > 300000)
    want = (c.join(o, F.col("c_custkey") == F.col("o_custkey"), "left")
             .select("c_custkey", "c_name", "o_orderkey", "o_totalprice"))
    assert same(J.customers_left_join_big_orders(skewed), want)
    assert same(J.big_orders_right_join_customers(skewed).select(*want.columns), want)


def test_rank_with_hot_nation(spark, monkeypatch):
    monkeypatch.setattr(skew, "TASK_ROWS", 500)
    base = Tables.from_dir(spark, SF001)
    cust = base.customer.withColumn(
        "c_nationkey", F.when(F.col("c_custkey") % 2 == 0, F.lit(3)).otherwise(F.col("c_nationkey")))
    t = Tables.from_frames(spark, customer=cust)
    w = Window.partitionBy("c_nationkey").orderBy(F.col("c_acctbal").desc())
    want = cust.select("c_custkey", "c_nationkey", "c_acctbal",
                       F.rank().over(w).cast("bigint").alias("balance_rank"),
                       F.dense_rank().over(w).cast("bigint").alias("balance_dense_rank"),
                       F.percent_rank().over(w).alias("balance_pct_rank"),
                       F.cume_dist().over(w).alias("balance_cume_dist"))
    got = A.balance_ranks(t)
    assert "_rk_chunk" in got._jdf.queryExecution().analyzed().toString()
    assert same(got.select(*want.columns), want)


def test_pareto_splits_global_running_sum(spark, monkeypatch):
    eager_split(monkeypatch)
    t = Tables.from_dir(spark, SF001)
    got = A.spend_pareto(t)
    assert "_rk_chunk" in got._jdf.queryExecution().analyzed().toString()
    monkeypatch.setattr(skew, "TASK_ROWS", 10**12)
    plain = A.spend_pareto(t)
    assert "_rk_chunk" not in plain._jdf.queryExecution().analyzed().toString()
    assert same(got, plain)


def test_streaks_are_not_split_for_a_hot_customer(skewed, monkeypatch):
    # its distinct months are bounded by the calendar
    eager_split(monkeypatch)
    assert "_rk_chunk" not in A.order_streaks(skewed)._jdf.queryExecution().analyzed().toString()


SPLIT_QUERIES = ("a10_running_total", "a13_spread_median", "a14_rank_within_group",
                 "a16_ntile", "a18_pareto")


@pytest.mark.parametrize("name", SPLIT_QUERIES)
def test_forced_split_matches_duckdb(spark, monkeypatch, name):
    """The split form of each skew-adaptive query, forced on the shared
    tables, returns exactly DuckDB's rows."""
    import relkit.operators.analytics as analytics
    import relkit.operators.scan as scan
    from oracle import compare, duck
    from relkit.catalog import BY_NAME
    monkeypatch.setattr(scan, "split_chunks", lambda *a, **k: 8)
    monkeypatch.setattr(analytics, "split_chunks", lambda *a, **k: 8)
    q = BY_NAME[name]
    ok, msg = compare(q.run(spark, SF001), duck(SF001), q.sql)
    assert ok, msg
