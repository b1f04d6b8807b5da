"""Basic analytics: global and grouped aggregates, HAVING, conditional
and distinct counts, monthly totals, rollup subtotals, shares of a
total, top N per group, running totals, moving averages, period
changes, spread and median."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from relkit.functions import charge, money, net_price, year_of
from relkit.operators.joins import monthly_orders
from relkit.operators.scan import exact_median, ntile_within, rank_within, running_sum
from relkit.plans.skew import split_chunks
from relkit.sources import Tables


def order_totals(t: Tables) -> DataFrame:
    """Global aggregate: one row.  Partial aggregates per task, one
    final merge of ``#tasks`` rows."""
    p = F.col("o_totalprice")
    return t.orders.agg(F.count(F.lit(1)).alias("n_orders"),
                        money(F.sum(p)).alias("total_price"),
                        money(F.avg(p)).alias("avg_price"),
                        F.min(p).alias("min_price"),
                        F.max(p).alias("max_price"))


def pricing_summary(t: Tables) -> DataFrame:
    """Grouped aggregate of line items by return flag and line status."""
    return (t.lineitem.groupBy("l_returnflag", "l_linestatus")
            .agg(money(F.sum("l_quantity")).alias("sum_qty"),
                 money(F.sum("l_extendedprice")).alias("sum_base_price"),
                 money(F.sum(net_price())).alias("sum_disc_price"),
                 money(F.sum(charge())).alias("sum_charge"),
                 money(F.avg("l_quantity"), 4).alias("avg_qty"),
                 money(F.avg("l_extendedprice"), 4).alias("avg_price"),
                 money(F.avg("l_discount"), 6).alias("avg_disc"),
                 F.count(F.lit(1)).alias("count_order")))


def frequent_customers(t: Tables, min_orders: int = 15) -> DataFrame:
    """HAVING: customers with at least ``min_orders`` orders."""
    return (t.orders.groupBy("o_custkey")
            .agg(F.count(F.lit(1)).alias("n_orders"),
                 money(F.sum("o_totalprice")).alias("total_price"))
            .where(F.col("n_orders") >= min_orders))


def negative_balances(t: Tables) -> DataFrame:
    """Conditional count per segment."""
    return (t.customer.groupBy("c_mktsegment")
            .agg(F.count_if(F.col("c_acctbal") < 0).alias("n_negative"),
                 F.count(F.lit(1)).alias("n_customers")))


def distinct_parts(t: Tables) -> DataFrame:
    """Distinct count per return flag.  Spark first aggregates on
    ``(flag, part)`` -- spread over all tasks by both columns -- and
    then counts per flag, so a flag with most rows is no hot spot."""
    return (t.lineitem.groupBy("l_returnflag")
            .agg(F.count_distinct("l_partkey").alias("n_parts")))


def monthly_totals(t: Tables) -> DataFrame:
    return monthly_orders(t).select("month", "n_orders", money(F.col("total")).alias("total"))


def balance_rollup(t: Tables) -> DataFrame:
    """Subtotals by region and segment, per region, and overall."""
    n = t.nation.select("n_nationkey", "n_regionkey")        # broadcast by size
    c = t.customer.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    return (c.rollup("n_regionkey", "c_mktsegment")
             .agg(F.count(F.lit(1)).alias("n_customers"),
                  money(F.sum("c_acctbal")).alias("total_balance"),
                  F.grouping("n_regionkey").cast("bigint").alias("g_region"),
                  F.grouping("c_mktsegment").cast("bigint").alias("g_segment")))


def segment_share(t: Tables) -> DataFrame:
    """Each segment's share of the total balance.  The total is a scalar
    subquery (one row, computed once), so the grouped rows stay
    distributed -- no window over an unpartitioned set."""
    c = t.customer
    total = c.select(F.sum("c_acctbal")).scalar()
    return (c.groupBy("c_mktsegment").agg(F.sum("c_acctbal").alias("_bal"))
             .select("c_mktsegment",
                     money(F.col("_bal")).alias("segment_balance"),
                     money(F.col("_bal") / total, 6).alias("share")))


def top_balances_per_nation(t: Tables, n: int = 3) -> DataFrame:
    """Top ``n`` balances per nation.  A filter on ``row_number`` is
    planned as WindowGroupLimit on both sides of the shuffle: each task
    sends at most ``n`` rows per nation."""
    w = Window.partitionBy("c_nationkey").orderBy(F.col("c_acctbal").desc(), F.col("c_custkey"))
    return (t.customer.select("c_nationkey", "c_custkey", "c_acctbal",
                              F.row_number().over(w).cast("bigint").alias("rn"))
                      .where(F.col("rn") <= n))


def running_customer_spend(t: Tables) -> DataFrame:
    """Running total of each customer's orders by date (order key, then
    price, break ties: keys may be null), split across tasks for customers with very many orders."""
    o = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    r = running_sum(o, ["o_custkey"], ["o_orderdate", "o_orderkey", "o_totalprice"], "o_totalprice", "_run")
    return r.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice",
                    money(F.col("_run")).alias("running_total"))


def _by_month() -> Window:
    # No partition key: the input is one row per calendar month (80 in
    # the test data, bounded by the date range, not by the table size).
    return Window.orderBy("month")


def moving_average(t: Tables) -> DataFrame:
    m = monthly_orders(t)
    w = _by_month().rowsBetween(-2, Window.currentRow)
    return m.select("month", money(F.col("total")).alias("total"),
                    money(F.avg("total").over(w)).alias("moving_avg_3m"))


def month_over_month(t: Tables) -> DataFrame:
    m = monthly_orders(t)
    prev = F.lag("total").over(_by_month())
    return m.select("month", money(F.col("total")).alias("total"),
                    money(prev).alias("prev_total"),
                    money(F.col("total") - prev).alias("change"))


def balance_spread(t: Tables) -> DataFrame:
    """Sample standard deviation and exact median of balance per segment."""
    got = exact_median(t.customer, ["c_mktsegment"], "c_acctbal", "_median",
                       also=[F.stddev_samp("c_acctbal").alias("_stddev")])
    return got.select("c_mktsegment", money(F.col("_stddev"), 4).alias("stddev_balance"),
                      money(F.col("_median"), 4).alias("median_balance"))


def balance_ranks(t: Tables) -> DataFrame:
    """Every customer's rank, dense rank and percent rank by balance
    within its nation (highest first), without holding a nation's
    customers in one task."""
    c = t.customer.select("c_custkey", "c_nationkey", "c_acctbal")
    return rank_within(c, ["c_nationkey"], "c_acctbal", descending=True,
                       rank="balance_rank", dense_rank="balance_dense_rank",
                       percent_rank="balance_pct_rank", cume_dist="balance_cume_dist")


def balance_quartiles(t: Tables) -> DataFrame:
    """Quartile (ntile 4) of every customer's balance within its nation,
    highest first; the customer key breaks ties."""
    c = t.customer.select("c_custkey", "c_nationkey", "c_acctbal")
    return ntile_within(c, ["c_nationkey"], [F.col("c_acctbal").desc(), F.col("c_custkey")],
                        4, out="balance_quartile")


# The order status codes of the test data.
ORDER_STATUSES = ("F", "O", "P")


def orders_by_year_and_status(t: Tables, statuses: Sequence[str] = ORDER_STATUSES) -> DataFrame:
    """Pivot: one row per year, one count column per given order status,
    and ``n_other`` for every other status, null included, so the columns
    add up to the year's orders.  With the values given, the pivot is one
    conditional aggregate per value: a single aggregation (one shuffle),
    where ``pivot()`` plans two, and no job to discover the values."""
    status = F.col("o_orderstatus")
    other = status.isNull() | ~status.isin(*statuses)
    return (t.orders.groupBy(year_of("o_orderdate").alias("year"))
                    .agg(*[F.count_if(status == s).alias(f"n_{s.lower()}") for s in statuses],
                         F.count_if(other).alias("n_other")))


def first_and_last_orders(t: Tables) -> DataFrame:
    """Each customer's first and last dated order (earliest date, then
    smallest key; latest date, then largest key).  ``min_by``/``max_by``
    are aggregates, combined per task before the shuffle, so a customer
    with very many orders is one partial row per task."""
    # Per customer and date first: the date alone then orders the rows, and
    # both aggregates are hash aggregates (a struct would have to be sorted).
    # A null key counts as smaller than any other.
    key, date = F.col("o_orderkey"), F.col("o_orderdate")
    per_date = t.orders.groupBy("o_custkey", "o_orderdate").agg(
        F.count(F.lit(1)).alias("_n"), F.min(key).alias("_lo"), F.max(key).alias("_hi"),
        F.max(key.isNull()).alias("_null"))
    first = F.when(~F.col("_null"), F.col("_lo"))
    return per_date.groupBy("o_custkey").agg(
        F.sum("_n").alias("n_orders"),
        F.min(date).alias("first_order_date"),
        F.min_by(first, date).alias("first_orderkey"),
        F.max(date).alias("last_order_date"),
        F.max_by("_hi", date).alias("last_orderkey"))


def spend_pareto(t: Tables) -> DataFrame:
    """Customers by total spend, highest first (customer key breaks
    ties), with the cumulative share of all spend.  The running sum has
    no partition key: on more than one task's worth of customers it is
    split into range chunks (:func:`running_sum`), never one task."""
    o = t.orders
    per_customer = o.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("_spent"))
    total = o.select(F.sum("o_totalprice")).scalar()
    # There are at most as many customers as orders: decide the split on
    # the orders (a footer count) instead of computing the aggregate twice.
    split = split_chunks(o, [])
    cum = running_sum(per_customer, [], [F.col("_spent").desc(), F.col("o_custkey")],
                      "_spent", "_cum", split=split)
    return cum.select("o_custkey", money(F.col("_spent")).alias("total_spent"),
                      money(F.col("_cum") / total, 6).alias("cum_share"))


def customers_every_year(t: Tables) -> DataFrame:
    """Relational division: customers with a dated order in every year
    that has any order.  Distinct (customer, year) pairs are counted per
    customer; the number of years is a scalar subquery."""
    o = t.orders.where(F.col("o_orderdate").isNotNull())
    year = year_of("o_orderdate")
    all_years = t.orders.select(F.count_distinct(year)).scalar()
    return (o.groupBy("o_custkey").agg(F.count_distinct(year).alias("n_years"))
             .where(F.col("n_years") == all_years))


def order_cube(t: Tables) -> DataFrame:
    """CUBE: orders and total per status and priority, per status, per
    priority, and over all.  ``level`` is grouping_id: which of the two is
    summed over.  One Expand under a partial aggregate, so what is shuffled
    does not grow with the orders."""
    return (t.orders.cube("o_orderstatus", "o_orderpriority")
             .agg(F.grouping_id().cast("bigint").alias("level"),
                  F.count(F.lit(1)).alias("n_orders"),
                  money(F.sum("o_totalprice")).alias("total_price")))


def order_grouping_sets(t: Tables) -> DataFrame:
    """GROUPING SETS: orders per (year, status) and per (year, priority),
    in one pass."""
    o = t.orders.select(year_of("o_orderdate").alias("year"), "o_orderstatus", "o_orderpriority")
    year, status, priority = F.col("year"), F.col("o_orderstatus"), F.col("o_orderpriority")
    return (o.groupingSets([[year, status], [year, priority]], year, status, priority)
             .agg(F.grouping_id().cast("bigint").alias("level"), F.count(F.lit(1)).alias("n_orders")))


def order_streaks(t: Tables) -> DataFrame:
    """Gaps and islands: per customer, the longest run of consecutive
    calendar months with at least one order, and the number of runs.

    The months of a customer are numbered in order; within a run, month index minus that number is constant and names the run."""
    o = t.orders.where(F.col("o_orderdate").isNotNull())
    months = o.select("o_custkey",
                      (F.year("o_orderdate") * 12 + F.month("o_orderdate") - 1)
                      .alias("_month")).distinct()
    # A customer's distinct months are bounded by the calendar: no split.
    numbered = running_sum(months.withColumn("_one", F.lit(1).cast("bigint")),
                           ["o_custkey"], ["_month"], "_one", "_n", split=False)
    runs = (numbered.groupBy("o_custkey", (F.col("_month") - F.col("_n")).alias("_run"))
                    .agg(F.count(F.lit(1)).alias("_len")))
    return runs.groupBy("o_custkey").agg(F.max("_len").alias("longest_streak"),
                                         F.count(F.lit(1)).alias("n_streaks"))


def filled_months(t: Tables, min_total: float = 495_000) -> DataFrame:
    """Orders above a total per month, from the first such month to the last,
    months without any included.  The months come from a recursive query
    that halves a span until it is one month, so its depth is the binary
    logarithm of the span and the calendar, not the orders, bounds its rows.
    Orders without a date or a total are left out; no order, no month."""
    big = (t.orders.where((F.col("o_totalprice") > min_total) & F.col("o_orderdate").isNotNull())
                   .select((F.year("o_orderdate") * 12 + F.month("o_orderdate") - 1).alias("at"), "o_totalprice"))
    per_month = big.groupBy("at").agg(F.count(F.lit(1)).alias("n_orders"), F.sum("o_totalprice").alias("total"))
    return t.spark.sql(
        """
        WITH RECURSIVE span(first, n) AS (
            SELECT bigint(min(at)), bigint(max(at) - min(at) + 1) FROM {per_month} HAVING min(at) IS NOT NULL
            UNION ALL
            SELECT half.first, half.n
            FROM span LATERAL VIEW explode(array(named_struct('first', first, 'n', n div 2),
                                                 named_struct('first', first + n div 2, 'n', n - n div 2))) h AS half
            WHERE n > 1)
        SELECT int(first div 12) AS year, int(first % 12 + 1) AS month,
               coalesce(n_orders, 0) AS n_orders, coalesce(round(total, 2), 0) AS total
        FROM span LEFT JOIN {per_month} AS m ON first = m.at
        WHERE n = 1
        """, per_month=per_month)
