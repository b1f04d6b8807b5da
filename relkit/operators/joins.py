"""JOIN: inner, outer, semi, anti, self, band (range) and the star join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relkit.functions import money, month_start, net_price
from relkit.plans.strategies import band_join, broadcast_if_few, left_outer_join, not_in, right_outer_join
from relkit.sources import Tables

BIG_ORDER = 300_000


def orders_with_customer(t: Tables) -> DataFrame:
    """Inner equi-join.  Large on both sides at scale: sort-merge join,
    with adaptive execution splitting a hot customer's partition."""
    o, c = t.orders, t.customer
    return (o.join(c, o.o_custkey == c.c_custkey, "inner")
             .select("o_orderkey", "o_custkey", "c_name", "c_mktsegment",
                     "o_totalprice", "o_orderdate"))


def _big_orders(t: Tables) -> DataFrame:
    return (t.orders.where(F.col("o_totalprice") > BIG_ORDER)
                    .select("o_orderkey", "o_custkey", "o_totalprice"))


_J2_COLS = ["c_custkey", "c_name", "o_orderkey", "o_totalprice"]


def customers_left_join_big_orders(t: Tables) -> DataFrame:
    """Every customer, with its orders above 300000 where it has any."""
    c = t.customer.select("c_custkey", "c_name")
    return left_outer_join(c, _big_orders(t), [("c_custkey", "o_custkey")]).select(*_J2_COLS)


def big_orders_right_join_customers(t: Tables) -> DataFrame:
    """``big_orders RIGHT JOIN customer``: every customer, order columns
    first."""
    c = t.customer.select("c_custkey", "c_name")
    o = _big_orders(t).select("o_orderkey", "o_totalprice", "o_custkey")
    return right_outer_join(o, c, [("o_custkey", "c_custkey")]) \
        .select("o_orderkey", "o_totalprice", "c_custkey", "c_name")


def rich_suppliers_full_join_nations(t: Tables, min_balance: float = 5000,
                                     max_region: int = 3) -> DataFrame:
    """Full outer join of the count of suppliers with a balance above
    ``min_balance`` per nation against the nations of the first
    ``max_region`` regions.  The supplier side is aggregated first: at
    most one row per nation reaches the join."""
    s = (t.supplier.where(F.col("s_acctbal") > min_balance)
                   .groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("n_rich_suppliers")))
    n = t.nation.where(F.col("n_regionkey") < max_region).select("n_nationkey", "n_name")
    return s.join(n, s.s_nationkey == n.n_nationkey, "full") \
            .select("s_nationkey", "n_rich_suppliers", "n_nationkey", "n_name")


def revenue_by_region(t: Tables) -> DataFrame:
    """Star join: lineitem -> orders -> customer -> nation -> region,
    net revenue per region.

    Each join meets the smallest grain that still carries its key:
    revenue is summed per order before the orders join, per customer
    before the customer join, and per nation before the nation and
    region joins (25 rows; the dimension tables are broadcast by size).
    Every aggregate is combined map-side, so hot keys collapse before
    any shuffle, and the per-order aggregate is already partitioned on
    the orders join key."""
    per_order = (t.lineitem.groupBy("l_orderkey")
                           .agg(F.sum(net_price()).alias("_rev")))
    per_customer = (t.orders.select("o_orderkey", "o_custkey")
                     .join(per_order, F.col("o_orderkey") == F.col("l_orderkey"))
                     .groupBy("o_custkey").agg(F.sum("_rev").alias("_rev")))
    per_nation = (per_customer
                  .join(t.customer.select("c_custkey", "c_nationkey"),
                        F.col("o_custkey") == F.col("c_custkey"))
                  .groupBy("c_nationkey").agg(F.sum("_rev").alias("_rev")))
    return (per_nation
            .join(t.nation.select("n_nationkey", "n_regionkey"),
                  F.col("c_nationkey") == F.col("n_nationkey"))
            .join(t.region.select("r_regionkey", "r_name"),
                  F.col("n_regionkey") == F.col("r_regionkey"))
            .groupBy("r_name")
            .agg(money(F.sum("_rev")).alias("revenue")))


def _big_order_customers(t: Tables) -> DataFrame:
    # Distinct keys: a customer with very many big orders is one row per
    # task before the shuffle, and the semi/anti join is one-to-one.
    return _big_orders(t).select("o_custkey").distinct()


def customers_with_big_order(t: Tables) -> DataFrame:
    """EXISTS / IN as a left semi join."""
    c = t.customer
    return (c.join(_big_order_customers(t), F.col("c_custkey") == F.col("o_custkey"), "left_semi")
             .select("c_custkey", "c_name"))


def customers_without_big_order(t: Tables) -> DataFrame:
    """NOT EXISTS as a left anti join (a customer with a null key is
    kept, as NOT EXISTS keeps it)."""
    c = t.customer
    return (c.join(_big_order_customers(t), F.col("c_custkey") == F.col("o_custkey"), "left_anti")
             .select("c_custkey", "c_name"))


def customers_not_in_big_order_keys(t: Tables) -> DataFrame:
    """``c_custkey NOT IN (keys of orders above 300000)`` -- the NOT IN
    form, whose answer differs from NOT EXISTS once nulls appear."""
    keys = _big_orders(t).select("o_custkey")
    return not_in(t.customer, "c_custkey", keys, "o_custkey").select("c_custkey", "c_name")


def monthly_orders(t: Tables) -> DataFrame:
    return (t.orders.groupBy(month_start("o_orderdate").alias("month"))
                    .agg(F.count(F.lit(1)).alias("n_orders"),
                         F.sum("o_totalprice").alias("total")))


def year_over_year(t: Tables) -> DataFrame:
    """Self join: monthly order totals joined to the same month one year
    earlier.  The join key is unique on both sides, so every row has at
    most one partner."""
    m = monthly_orders(t)
    prev = m.select((F.col("month") + F.make_ym_interval(F.lit(1), F.lit(0))).alias("month"),
                    F.col("n_orders").alias("prev_n_orders"),
                    F.col("total").alias("prev_total"))
    return (m.join(prev, "month", "left")
             .select("month", "n_orders", money(F.col("total")).alias("total"),
                     "prev_n_orders", money(F.col("prev_total")).alias("prev_total")))


def balance_brackets(t: Tables, width: float = 1000.0) -> DataFrame:
    """Range join: every customer with the supplier balance bracket
    [low, low + width) its balance lies in, if any supplier does.  The
    brackets do not overlap, so a customer has at most one.  The exact
    predicate runs on the pairs of an equi-join on buckets."""
    c = t.customer.select("c_custkey", "c_acctbal")
    low = (F.floor(F.col("s_acctbal") / F.lit(width)) * F.lit(width)).cast("double")
    brackets = (t.supplier.where(F.col("s_acctbal").isNotNull())
                 .groupBy(low.alias("bracket_low")).agg(F.count(F.lit(1)).alias("n_suppliers"))
                 .withColumn("_middle", F.col("bracket_low") + width / 2))
    # A handful of brackets: broadcast behind a count, so that customers are
    # not dealt by a handful of keys.
    near = band_join(c, broadcast_if_few(brackets), "c_acctbal", "_middle", width)
    return (near.where((F.col("c_acctbal") >= F.col("bracket_low"))
                       & (F.col("c_acctbal") < F.col("bracket_low") + width))
                .select("c_custkey", "c_acctbal", "bracket_low", "n_suppliers"))
