"""Views: a named query (temp view), a view over a view, and a
persistent view over a saved table.

A temp view stores a plan, not data.  One made from a DataFrame is bound
to that DataFrame's sources; one made from SQL text binds its sources
by name each time it is read.  Names carry the data set's token so views
of different data sets never see each other's tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relkit.session import output_dir
from relkit.sources import Tables
from relkit.sources.summary import publish, refuse_input_folder, sql_path

BIG_ORDER_VIEW_MIN = 200_000


def big_orders_view_name(t: Tables) -> str:
    return f"big_orders_{t.token}"


def create_big_orders_view(t: Tables, min_total: float = BIG_ORDER_VIEW_MIN) -> str:
    """Temp view over a DataFrame query: orders above ``min_total``."""
    name = big_orders_view_name(t)
    (t.orders.where(F.col("o_totalprice") > min_total)
             .select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
             .createOrReplaceTempView(name))
    return name


def big_orders(t: Tables) -> DataFrame:
    return t.spark.table(create_big_orders_view(t))


def create_big_order_counts_view(t: Tables) -> str:
    """A view (SQL text) over the view above: big orders per customer."""
    base = create_big_orders_view(t)
    name = f"big_order_counts_{t.token}"
    t.spark.sql(f"""
        CREATE OR REPLACE TEMP VIEW {name} AS
        SELECT o_custkey,
               count(*)                    AS n_big_orders,
               round(sum(o_totalprice), 2) AS big_total
        FROM {base}
        GROUP BY o_custkey""")
    return name


def big_order_counts(t: Tables) -> DataFrame:
    return t.spark.table(create_big_order_counts_view(t))


def create_frequent_customer_view(t: Tables, location: str | None = None,
                                  min_orders: int = 15) -> str:
    """Save per-customer order totals as a table, then define a
    persistent view over it (a persistent view cannot read a temp view).

    The table is written under ``location`` (by default in the output
    folder) as a new version, so frames that read the view before stay
    readable; the catalog entry lasts as long as the session catalog
    does."""
    spark = t.spark
    view = f"frequent_customers_{t.token}"
    base = (location or f"{output_dir(spark)}/customer_order_totals_{t.token}").rstrip("/")
    refuse_input_folder(spark, base, [t.root] if t.reads_files else t.orders.inputFiles())
    path = publish(customer_order_totals(t), base)
    spark.sql(f"""
        CREATE OR REPLACE VIEW {view} AS
        SELECT o_custkey, n_orders, round(total_price, 2) AS total_price
        FROM parquet.{sql_path(path)}
        WHERE n_orders >= {int(min_orders)}""")
    return view


def customer_order_totals(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"),
                                             F.sum("o_totalprice").alias("total_price"))


def frequent_customers_view(t: Tables, location: str | None = None) -> DataFrame:
    return t.spark.table(create_frequent_customer_view(t, location))
