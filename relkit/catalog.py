"""The registered queries: one per build-list row, each with the DuckDB
SQL that must return the same rows on the same Parquet tables.

Every builder takes ``(spark, data_dir)`` and reads the whole tables
under ``data_dir``.  Column names are identical on both sides.  Floating
totals are rounded the same way on both sides, because sums of doubles
differ in their last digits with the order of addition.  Null ordering
is spelled out in the SQL where it matters: Spark sorts nulls first when
ascending and last when descending; DuckDB sorts them last by default.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from relkit.operators import activity as T
from relkit.operators import analytics as A
from relkit.operators import joins as J
from relkit.operators import patterns as M
from relkit.operators import sampling as G
from relkit.operators import select as S
from relkit.plans import procedures as P
from relkit.plans import streams as R
from relkit.plans import views as V
from relkit.sources import Tables


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None
    rows_sf001: int | None = None     # expected rows at sf0.01
    # of a query that writes a table: the rows it writes, without writing
    plan: Callable[[Tables], DataFrame] | None = None
    portable: bool = True             # the SQL text also runs on Spark

    def run(self, spark: SparkSession, data_dir: str) -> DataFrame:
        return self.build(Tables.from_dir(spark, data_dir))

    def planned(self, spark: SparkSession, data_dir: str) -> DataFrame:
        """The query for looking at its plan: writes nothing."""
        return (self.plan or self.build)(Tables.from_dir(spark, data_dir))


_MONTHLY = """
    WITH m AS (
        SELECT date_trunc('month', o_orderdate) AS month,
               count(*)                         AS n_orders,
               sum(o_totalprice)                AS total
        FROM orders GROUP BY 1)"""

_NATION_KEYS = "SELECT c_nationkey AS nationkey FROM customer {op} SELECT s_nationkey FROM supplier"


def _p3(t: Tables) -> DataFrame:
    return P.refresh_order_summary(t, P.default_summary_dir(t))


QUERIES: list[Query] = [
    # --- SELECT --------------------------------------------------------
    Query("s1_projection", S.projection, """
        SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net_price
        FROM lineitem""", 60000),
    Query("s2_filter", S.filtered_orders, """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
        FROM orders
        WHERE o_totalprice BETWEEN 1000 AND 50000
          AND o_orderstatus IN ('O', 'P')
          AND o_orderpriority LIKE '1%'""", 192),
    Query("s3_case_bucket", S.size_classes, """
        SELECT p_partkey, p_size,
               CASE WHEN p_size < 10 THEN 'small'
                    WHEN p_size < 30 THEN 'medium'
                    ELSE 'large' END AS size_class
        FROM part""", 2000),
    Query("s4_distinct", S.distinct_status, """
        SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem""", 6),
    Query("s5_order_limit", S.top_orders, """
        SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate
        FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey NULLS FIRST LIMIT 10""", 10),
    Query("s6_scalar_subquery", S.above_average_balance, """
        SELECT c_custkey, c_name, c_acctbal FROM customer
        WHERE c_acctbal > (SELECT avg(c_acctbal) FROM customer)""", 725),
    Query("s7_correlated_subquery", S.above_nation_average, """
        SELECT c_custkey, c_nationkey, c_acctbal FROM customer c
        WHERE c_acctbal > (SELECT avg(c2.c_acctbal) FROM customer c2
                           WHERE c2.c_nationkey = c.c_nationkey)""", 728),
    Query("s8_cte", S.big_spenders, """
        WITH spent AS (SELECT o_custkey, sum(o_totalprice) AS s FROM orders GROUP BY o_custkey)
        SELECT c_custkey, c_name, round(s, 2) AS total_spent
        FROM customer JOIN spent ON c_custkey = o_custkey
        WHERE s > 1000000""", 1442),
    Query("s9a_union_all", S.nation_keys_union_all, _NATION_KEYS.format(op="UNION ALL"), 1600),
    Query("s9b_union", S.nation_keys_union, _NATION_KEYS.format(op="UNION"), 25),
    Query("s9c_intersect", S.nation_keys_intersect, _NATION_KEYS.format(op="INTERSECT"), 25),
    Query("s9d_except", S.unsold_bulk_parts, """
        SELECT p_partkey FROM part
        EXCEPT
        SELECT l_partkey FROM lineitem WHERE l_quantity > 40""", 3),
    # --- JOIN ----------------------------------------------------------
    Query("j1_inner_join", J.orders_with_customer, """
        SELECT o_orderkey, o_custkey, c_name, c_mktsegment, o_totalprice, o_orderdate
        FROM orders JOIN customer ON o_custkey = c_custkey""", 15000),
    Query("j2a_left_join", J.customers_left_join_big_orders, """
        SELECT c_custkey, c_name, o_orderkey, o_totalprice
        FROM customer
        LEFT JOIN (SELECT * FROM orders WHERE o_totalprice > 300000) o ON c_custkey = o_custkey""",
          6063),
    Query("j2b_right_join", J.big_orders_right_join_customers, """
        SELECT o_orderkey, o_totalprice, c_custkey, c_name
        FROM (SELECT * FROM orders WHERE o_totalprice > 300000) o
        RIGHT JOIN customer ON o_custkey = c_custkey""", 6063),
    Query("j2c_full_join", J.rich_suppliers_full_join_nations, """
        SELECT s_nationkey, n_rich_suppliers, n_nationkey, n_name
        FROM (SELECT s_nationkey, count(*) AS n_rich_suppliers
              FROM supplier WHERE s_acctbal > 5000 GROUP BY s_nationkey) s
        FULL OUTER JOIN (SELECT n_nationkey, n_name FROM nation WHERE n_regionkey < 3) n
          ON s_nationkey = n_nationkey""", 23),
    Query("j3_star_join", J.revenue_by_region, """
        SELECT r_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue
        FROM lineitem
        JOIN orders   ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey
        JOIN nation   ON c_nationkey = n_nationkey
        JOIN region   ON n_regionkey = r_regionkey
        GROUP BY r_name""", 5),
    Query("j4_semi_join", J.customers_with_big_order, """
        SELECT c_custkey, c_name FROM customer
        WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)""",
          1470),
    Query("j5_anti_join", J.customers_without_big_order, """
        SELECT c_custkey, c_name FROM customer
        WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)""",
          30),
    Query("j5b_not_in", J.customers_not_in_big_order_keys, """
        SELECT c_custkey, c_name FROM customer
        WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)""",
          30),
    Query("j6_self_join", J.year_over_year, _MONTHLY + """
        SELECT cur.month, cur.n_orders, round(cur.total, 2) AS total,
               prev.n_orders AS prev_n_orders, round(prev.total, 2) AS prev_total
        FROM m cur LEFT JOIN m prev ON cur.month = prev.month + INTERVAL 1 YEAR""", 80),
    Query("j8_range_join", J.balance_brackets, """
        WITH brackets AS (
            SELECT floor(s_acctbal / 1000) * 1000 AS bracket_low, count(*) AS n_suppliers
            FROM supplier WHERE s_acctbal IS NOT NULL GROUP BY 1)
        SELECT c_custkey, c_acctbal, bracket_low, n_suppliers
        FROM customer JOIN brackets
          ON c_acctbal >= bracket_low AND c_acctbal < bracket_low + 1000""", 1500),
    # --- analytics -----------------------------------------------------
    Query("a1_global_agg", A.order_totals, """
        SELECT count(*) AS n_orders,
               round(sum(o_totalprice), 2) AS total_price,
               round(avg(o_totalprice), 2) AS avg_price,
               min(o_totalprice) AS min_price,
               max(o_totalprice) AS max_price
        FROM orders""", 1),
    Query("a2_group_agg", A.pricing_summary, """
        SELECT l_returnflag, l_linestatus,
               round(sum(l_quantity), 2) AS sum_qty,
               round(sum(l_extendedprice), 2) AS sum_base_price,
               round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc_price,
               round(sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)), 2) AS sum_charge,
               round(avg(l_quantity), 4) AS avg_qty,
               round(avg(l_extendedprice), 4) AS avg_price,
               round(avg(l_discount), 6) AS avg_disc,
               count(*) AS count_order
        FROM lineitem GROUP BY l_returnflag, l_linestatus""", 6),
    Query("a3_having", A.frequent_customers, """
        SELECT o_custkey, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total_price
        FROM orders GROUP BY o_custkey HAVING count(*) >= 15""", 124),
    Query("a4_count_if", A.negative_balances, """
        SELECT c_mktsegment,
               CAST(count(*) FILTER (WHERE c_acctbal < 0) AS BIGINT) AS n_negative,
               count(*) AS n_customers
        FROM customer GROUP BY c_mktsegment""", 5),
    Query("a5_count_distinct", A.distinct_parts, """
        SELECT l_returnflag, count(DISTINCT l_partkey) AS n_parts
        FROM lineitem GROUP BY l_returnflag""", 3),
    Query("a6_monthly_totals", A.monthly_totals, _MONTHLY + """
        SELECT month, n_orders, round(total, 2) AS total FROM m""", 80),
    Query("a7_rollup", A.balance_rollup, """
        SELECT n_regionkey, c_mktsegment,
               count(*) AS n_customers,
               round(sum(c_acctbal), 2) AS total_balance,
               CAST(grouping(n_regionkey) AS BIGINT) AS g_region,
               CAST(grouping(c_mktsegment) AS BIGINT) AS g_segment
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        GROUP BY ROLLUP (n_regionkey, c_mktsegment)""", 31),
    Query("a8_share_of_total", A.segment_share, """
        SELECT c_mktsegment,
               round(sum(c_acctbal), 2) AS segment_balance,
               round(sum(c_acctbal) / (SELECT sum(c_acctbal) FROM customer), 6) AS share
        FROM customer GROUP BY c_mktsegment""", 5),
    Query("a9_top_n_per_group", A.top_balances_per_nation, """
        SELECT c_nationkey, c_custkey, c_acctbal, rn FROM (
            SELECT c_nationkey, c_custkey, c_acctbal,
                   row_number() OVER (PARTITION BY c_nationkey
                                      ORDER BY c_acctbal DESC NULLS LAST,
                                               c_custkey NULLS FIRST) AS rn
            FROM customer)
        WHERE rn <= 3""", 75),
    Query("a10_running_total", A.running_customer_spend, """
        SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice,
               round(sum(o_totalprice) OVER (PARTITION BY o_custkey
                                             ORDER BY o_orderdate NULLS FIRST,
                                                      o_orderkey NULLS FIRST,
                                                      o_totalprice NULLS FIRST
                                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2)
                 AS running_total
        FROM orders""", 15000),
    Query("a11_moving_average", A.moving_average, _MONTHLY + """
        SELECT month, round(total, 2) AS total,
               round(avg(total) OVER (ORDER BY month NULLS FIRST
                                     ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 2)
                 AS moving_avg_3m
        FROM m""", 80),
    Query("a12_period_change", A.month_over_month, _MONTHLY + """
        SELECT month, round(total, 2) AS total,
               round(lag(total) OVER (ORDER BY month NULLS FIRST), 2) AS prev_total,
               round(total - lag(total) OVER (ORDER BY month NULLS FIRST), 2) AS change
        FROM m""", 80),
    Query("a13_spread_median", A.balance_spread, """
        SELECT c_mktsegment,
               round(stddev_samp(c_acctbal), 4) AS stddev_balance,
               round(median(c_acctbal), 4) AS median_balance
        FROM customer GROUP BY c_mktsegment""", 5),
    Query("a14_rank_within_group", A.balance_ranks, """
        SELECT c_custkey, c_nationkey, c_acctbal,
               rank()         OVER w AS balance_rank,
               dense_rank()   OVER w AS balance_dense_rank,
               percent_rank() OVER w AS balance_pct_rank,
               cume_dist()    OVER w AS balance_cume_dist
        FROM customer
        WINDOW w AS (PARTITION BY c_nationkey ORDER BY c_acctbal DESC NULLS LAST)""", 1500),
    Query("a15_pivot", A.orders_by_year_and_status, """
        SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
               count(*) FILTER (WHERE o_orderstatus = 'F') AS n_f,
               count(*) FILTER (WHERE o_orderstatus = 'O') AS n_o,
               count(*) FILTER (WHERE o_orderstatus = 'P') AS n_p,
               count(*) FILTER (WHERE o_orderstatus IS NULL OR o_orderstatus NOT IN ('F', 'O', 'P')) AS n_other
        FROM orders GROUP BY 1""", 7),
    Query("a16_ntile", A.balance_quartiles, """
        SELECT c_custkey, c_nationkey, c_acctbal,
               ntile(4) OVER (PARTITION BY c_nationkey
                              ORDER BY c_acctbal DESC NULLS LAST, c_custkey NULLS FIRST)
                 AS balance_quartile
        FROM customer""", 1500),
    Query("a17_first_last", A.first_and_last_orders, """
        SELECT o_custkey, count(*) AS n_orders,
               min(o_orderdate) AS first_order_date,
               min(CASE WHEN rf = 1 AND o_orderdate IS NOT NULL THEN o_orderkey END)
                 AS first_orderkey,
               max(o_orderdate) AS last_order_date,
               min(CASE WHEN rl = 1 AND o_orderdate IS NOT NULL THEN o_orderkey END)
                 AS last_orderkey
        FROM (SELECT o_custkey, o_orderkey, o_orderdate,
                     row_number() OVER (PARTITION BY o_custkey, o_orderdate IS NULL
                                        ORDER BY o_orderdate, o_orderkey) AS rf,
                     row_number() OVER (PARTITION BY o_custkey, o_orderdate IS NULL
                                        ORDER BY o_orderdate DESC, o_orderkey DESC) AS rl
              FROM orders)
        GROUP BY o_custkey""", 1500),
    Query("a18_pareto", A.spend_pareto, """
        WITH spent AS (SELECT o_custkey, sum(o_totalprice) AS s FROM orders GROUP BY o_custkey)
        SELECT o_custkey, round(s, 2) AS total_spent,
               round(sum(s) OVER (ORDER BY s DESC NULLS LAST, o_custkey NULLS FIRST
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                     / (SELECT sum(o_totalprice) FROM orders), 6) AS cum_share
        FROM spent""", 1500),
    Query("a19_relational_division", A.customers_every_year, """
        SELECT o_custkey, count(DISTINCT year(o_orderdate)) AS n_years
        FROM orders WHERE o_orderdate IS NOT NULL
        GROUP BY o_custkey
        HAVING count(DISTINCT year(o_orderdate)) =
               (SELECT count(DISTINCT year(o_orderdate)) FROM orders)""", 195),
    Query("a20_gaps_and_islands", A.order_streaks, """
        WITH months AS (
            SELECT DISTINCT o_custkey,
                   year(o_orderdate) * 12 + month(o_orderdate) - 1 AS m
            FROM orders WHERE o_orderdate IS NOT NULL),
        runs AS (
            SELECT o_custkey,
                   m - row_number() OVER (PARTITION BY o_custkey ORDER BY m) AS run
            FROM months)
        SELECT o_custkey, max(len) AS longest_streak, count(*) AS n_streaks
        FROM (SELECT o_custkey, run, count(*) AS len FROM runs GROUP BY o_custkey, run)
        GROUP BY o_custkey""", 1500),
    Query("a21_cube", A.order_cube, """
        SELECT o_orderstatus, o_orderpriority,
               CAST(2 * grouping(o_orderstatus) + grouping(o_orderpriority) AS BIGINT) AS level,
               count(*) AS n_orders, round(sum(o_totalprice), 2) AS total_price
        FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)""", 24),
    Query("a22_grouping_sets", A.order_grouping_sets, """
        SELECT year, o_orderstatus, o_orderpriority,
               CAST(4 * grouping(year) + 2 * grouping(o_orderstatus) + grouping(o_orderpriority) AS BIGINT) AS level,
               count(*) AS n_orders
        FROM (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderstatus, o_orderpriority FROM orders)
        GROUP BY GROUPING SETS ((year, o_orderstatus), (year, o_orderpriority))""", 56),
    # --- views ---------------------------------------------------------
    Query("v1_view", V.big_orders, """
        SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate
        FROM orders WHERE o_totalprice > 200000""", 9054),
    Query("v2_view_over_view", V.big_order_counts, """
        SELECT o_custkey, count(*) AS n_big_orders, round(sum(o_totalprice), 2) AS big_total
        FROM orders WHERE o_totalprice > 200000 GROUP BY o_custkey""", 1498),
    Query("v3_persisted_view", V.frequent_customers_view, """
        SELECT o_custkey, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total_price
        FROM orders GROUP BY o_custkey HAVING count(*) >= 15""", 124, plan=V.customer_order_totals),
    # --- over time -----------------------------------------------------
    Query("t1_as_of_join", T.errors_after_purchases, """
        WITH p AS (
            SELECT user_id, ts, event_id, value,
                   lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_ts
            FROM events
            WHERE event_type = 'purchase' AND user_id IS NOT NULL AND ts IS NOT NULL AND event_id IS NOT NULL)
        SELECT e.event_id, e.user_id, e.ts, p.event_id AS purchase_id, p.ts AS purchase_ts, p.value AS purchase_value
        FROM events e
        LEFT JOIN p ON p.user_id = e.user_id AND p.ts <= e.ts AND (p.next_ts IS NULL OR e.ts < p.next_ts)
        WHERE e.event_type = 'error'"""),
    Query("t2_trailing_window", T.trailing_spend, """
        SELECT o_orderkey, o_custkey, o_orderdate, count(*) OVER w AS n_orders, round(sum(o_totalprice) OVER w, 2) AS spent
        FROM orders
        WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate
                     RANGE BETWEEN INTERVAL '30' DAY PRECEDING AND CURRENT ROW)""", 15_000),
    Query("t3_open_orders", T.open_orders, """
        WITH shipped AS (SELECT l_orderkey, max(l_shipdate) AS done FROM lineitem GROUP BY l_orderkey),
        spans AS (
            SELECT o_orderdate, done FROM orders LEFT JOIN shipped ON o_orderkey = l_orderkey
            WHERE o_orderdate IS NOT NULL AND (done IS NULL OR done > o_orderdate)),
        bounds AS (
            SELECT o_orderdate AS instant, 1 AS s, 0 AS e FROM spans
            UNION ALL SELECT done, 0, 1 FROM spans WHERE done IS NOT NULL),
        instants AS (
            SELECT instant, CAST(sum(s) AS BIGINT) AS n_started, CAST(sum(e) AS BIGINT) AS n_ended FROM bounds GROUP BY instant)
        SELECT instant, n_started, n_ended, CAST(sum(n_started - n_ended) OVER (ORDER BY instant) AS BIGINT) AS n_open
        FROM instants"""),
    Query("t4_sessions", T.user_sessions, """
        WITH g AS (
            SELECT user_id, ts, value, event_id,
                   CASE WHEN ts <= lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL '6' HOUR THEN 0 ELSE 1 END AS is_new
            FROM events WHERE ts IS NOT NULL),
        s AS (SELECT *, sum(is_new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM g)
        SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS n_events,
               round(sum(value), 2) AS total_value
        FROM s GROUP BY user_id, session"""),
    Query("t5_event_properties", T.event_properties, """
        WITH e AS (
            SELECT event_type, props,
                   CASE WHEN json_valid(props) THEN json_type(props) = 'OBJECT' ELSE false END AS valid FROM events),
        k AS (
            SELECT event_type, props, valid,
                   unnest(CASE WHEN valid AND len(json_keys(props)) > 0 THEN json_keys(props) ELSE [NULL] END) AS key
            FROM e),
        v AS (
            SELECT *, CASE WHEN key IS NOT NULL
                           THEN TRY_CAST(json_extract_string(props, '$."' || key || '"') AS DOUBLE) END AS number FROM k)
        SELECT event_type, key, count(*) AS n_events, count(*) FILTER (props IS NULL) AS n_missing,
               count(*) FILTER (props IS NOT NULL AND NOT valid) AS n_malformed, count(number) AS n_numbers,
               round(sum(number), 2) AS total
        FROM v GROUP BY event_type, key""", portable=False),
    Query("t6_stream_totals", R.daily_totals, """
        SELECT date_trunc('day', ts) AS day, event_type, count(*) AS n_events, round(sum(value), 2) AS total_value
        FROM events WHERE ts IS NOT NULL
        GROUP BY 1, 2
        HAVING date_trunc('day', min(ts)) + INTERVAL '25' HOUR <= (SELECT max(ts) FROM events)""",
          plan=R.daily_totals_plan),
    Query("t7_event_funnel", M.funnel, """
        WITH e AS (
            SELECT event_id, ts, user_id, event_type FROM events WHERE event_type IN ('view', 'click', 'purchase')),
        f AS (
            SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n
            FROM e WHERE user_id IS NOT NULL AND ts IS NOT NULL AND event_id IS NOT NULL),
        g AS (
            SELECT *,
                   min(CASE WHEN event_type = 'click' THEN n END) OVER later AS click,
                   min(CASE WHEN event_type = 'purchase' THEN n END) OVER later AS purchase
            FROM f WINDOW later AS (PARTITION BY user_id ORDER BY n ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))
        SELECT v.user_id, v.event_id, v.ts, c.event_id AS step_2_event_id, c.ts AS step_2_ts,
               b.event_id AS step_3_event_id, b.ts AS step_3_ts,
               CASE WHEN b.n IS NOT NULL THEN 3 WHEN c.n IS NOT NULL THEN 2 ELSE 1 END AS n_steps
        FROM g v LEFT JOIN g c ON c.user_id = v.user_id AND c.n = v.click AND c.ts <= v.ts + INTERVAL '72' HOUR
                 LEFT JOIN g b ON b.user_id = v.user_id AND b.n = c.purchase AND b.ts <= v.ts + INTERVAL '72' HOUR
        WHERE v.event_type = 'view'
        UNION ALL
        SELECT user_id, event_id, ts, NULL, NULL, NULL, NULL, 1 FROM e
        WHERE event_type = 'view' AND (user_id IS NULL OR ts IS NULL OR event_id IS NULL)"""),
    Query("g1_stratified_sample", G.order_sample, """
        SELECT o_orderkey, o_custkey, o_orderpriority FROM (
            SELECT o_orderkey, o_custkey, o_orderpriority,
                   row_number() OVER (PARTITION BY o_orderpriority ORDER BY
                       md5(concat_ws('|', '7', coalesce(CAST(o_orderkey AS VARCHAR(20)), '-'), coalesce(CAST(o_custkey AS VARCHAR(20)), '-'))),
                       o_orderkey, o_custkey) AS n
            FROM orders) ranked
        WHERE n <= 100"""),
    Query("a23_filled_months", A.filled_months, """
        WITH RECURSIVE big AS (
            SELECT CAST(year(o_orderdate) * 12 + month(o_orderdate) - 1 AS INTEGER) AS slot, o_totalprice
            FROM orders WHERE o_totalprice > 495000 AND o_orderdate IS NOT NULL),
        m AS (SELECT slot, count(*) AS n_orders, sum(o_totalprice) AS total FROM big GROUP BY slot),
        ends AS (SELECT min(slot) AS slot, max(slot) AS last FROM m),
        calendar(slot, last) AS (
            SELECT slot, last FROM ends WHERE slot IS NOT NULL
            UNION ALL
            SELECT slot + 1, last FROM calendar WHERE slot < last)
        SELECT CAST(floor(c.slot / 12) AS INTEGER) AS year, CAST(c.slot % 12 + 1 AS INTEGER) AS month,
               coalesce(n_orders, 0) AS n_orders, coalesce(round(total, 2), 0) AS total
        FROM calendar c LEFT JOIN m ON c.slot = m.slot"""),
    # --- procedures ----------------------------------------------------
    Query("p1_param_report", lambda t: P.priority_report(t, 200_000), """
        SELECT o_orderpriority, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total_price
        FROM orders WHERE o_totalprice > 200000 GROUP BY o_orderpriority""", 5),
    Query("p2_multi_step", P.segment_big_orders, """
        SELECT c_mktsegment, count(*) AS n_big_orders, round(sum(o_totalprice), 2) AS big_total
        FROM orders JOIN customer ON o_custkey = c_custkey
        WHERE o_totalprice > 300000 GROUP BY c_mktsegment""", 5),
    Query("p3_refresh_summary", _p3, """
        SELECT o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS year,
               count(*) AS n_orders, round(sum(o_totalprice), 2) AS total_price
        FROM orders GROUP BY 1, 2""", 21, plan=P.order_summary),
    Query("p4_table_function", lambda t: P.orders_above(t, 300_000), """
        SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_totalprice > 300000""",
          6033),
    Query("p5_sql_script", P.segment_report_script, """
        SELECT c_mktsegment, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total_price
        FROM orders JOIN customer ON o_custkey = c_custkey
        WHERE o_totalprice > (SELECT avg(o_totalprice) FROM orders)
        GROUP BY c_mktsegment""", 5, plan=P.segment_report_plan),
    Query("p6_versioned_refresh", P.publish_order_summary, """
        SELECT o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS year,
               count(*) AS n_orders, round(sum(o_totalprice), 2) AS total_price
        FROM orders GROUP BY 1, 2""", 21, plan=P.order_summary),
]

BY_NAME: dict[str, Query] = {q.name: q for q in QUERIES}
