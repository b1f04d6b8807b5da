"""SELECT: projection, filters, CASE, DISTINCT, ORDER BY + LIMIT,
subqueries, common table expressions and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relkit.functions import money, net_price
from relkit.plans.strategies import broadcast_if_few
from relkit.sources import Tables


def projection(t: Tables) -> DataFrame:
    """Line items with their discounted price."""
    return t.lineitem.select("l_orderkey", "l_linenumber", net_price().alias("net_price"))


def filtered_orders(t: Tables) -> DataFrame:
    """A range, a list and a pattern predicate; all three reach the
    Parquet reader as pushed filters."""
    o = t.orders
    return (o.where(F.col("o_totalprice").between(1000, 50000)
                    & F.col("o_orderstatus").isin("O", "P")
                    & F.col("o_orderpriority").like("1%"))
             .select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                     "o_orderdate", "o_orderpriority"))


def size_classes(t: Tables) -> DataFrame:
    size = F.col("p_size")
    cls = (F.when(size < 10, "small").when(size < 30, "medium").otherwise("large"))
    return t.part.select("p_partkey", "p_size", cls.alias("size_class"))


def distinct_status(t: Tables) -> DataFrame:
    return t.lineitem.select("l_returnflag", "l_linestatus").distinct()


def top_orders(t: Tables, n: int = 10) -> DataFrame:
    """The ``n`` most expensive orders; the order key breaks ties.
    Planned as TakeOrderedAndProject: each task keeps its own top ``n``."""
    return (t.orders.orderBy(F.col("o_totalprice").desc(), F.col("o_orderkey").asc())
                    .limit(n)
                    .select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"))


def above_average_balance(t: Tables) -> DataFrame:
    """Uncorrelated scalar subquery: computed once, then a filter."""
    c = t.customer
    avg_bal = c.select(F.avg("c_acctbal")).scalar()
    return c.where(F.col("c_acctbal") > avg_bal).select("c_custkey", "c_name", "c_acctbal")


def above_nation_average(t: Tables) -> DataFrame:
    """Correlated scalar subquery, decorrelated: one average per nation
    (partial aggregation, one row per nation) joined back on the key.  The
    averages are broadcast if they are few, so customers are not shuffled
    on a handful of nation keys."""
    c = t.customer
    per_nation = broadcast_if_few(
        c.groupBy("c_nationkey").agg(F.avg("c_acctbal").alias("_nation_avg")))
    return (c.join(per_nation, "c_nationkey")
             .where(F.col("c_acctbal") > F.col("_nation_avg"))
             .select("c_custkey", "c_nationkey", "c_acctbal"))


def big_spenders(t: Tables, threshold: float = 1_000_000) -> DataFrame:
    """A common table expression: per-customer order totals, named, then
    filtered and joined.  Totals are aggregated before the join, so the
    join sees one row per customer."""
    spent = (t.orders.groupBy("o_custkey")
                     .agg(F.sum("o_totalprice").alias("_spent"))
                     .where(F.col("_spent") > threshold))
    return (t.customer.join(spent, F.col("c_custkey") == F.col("o_custkey"))
                      .select("c_custkey", "c_name", money(F.col("_spent")).alias("total_spent")))


def _nation_keys(t: Tables) -> tuple[DataFrame, DataFrame]:
    return (t.customer.select(F.col("c_nationkey").alias("nationkey")),
            t.supplier.select(F.col("s_nationkey").alias("nationkey")))


def nation_keys_union_all(t: Tables) -> DataFrame:
    c, s = _nation_keys(t)
    return c.unionAll(s)


def nation_keys_union(t: Tables) -> DataFrame:
    c, s = _nation_keys(t)
    return c.union(s).distinct()


def nation_keys_intersect(t: Tables) -> DataFrame:
    # Spark plans INTERSECT as a semi join under a distinct; making both
    # sides distinct first combines them map-side before their shuffles.
    c, s = _nation_keys(t)
    return c.distinct().intersect(s.distinct())


def unsold_bulk_parts(t: Tables, quantity: float = 40) -> DataFrame:
    """Parts never sold in a line of more than ``quantity`` units
    (EXCEPT DISTINCT)."""
    bulk = t.lineitem.where(F.col("l_quantity") > quantity) \
                     .select(F.col("l_partkey").alias("p_partkey")).distinct()
    return t.part.select("p_partkey").subtract(bulk)
