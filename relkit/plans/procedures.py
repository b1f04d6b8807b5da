"""Procedures: parameterised units of work.

Spark has no stored procedures in a plain session (``CREATE PROCEDURE``
does not parse, ``CALL`` finds no procedure catalog), so a procedure is
a Python function over DataFrames, or SQL text with bound parameters.
Each returns a DataFrame and leaves the action to the caller, except
the summary refresh, whose action is the write itself.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relkit.functions import money, year_of
from relkit.session import output_dir
from relkit.sources import Tables
from relkit.sources.summary import (new_version, publish, publish_after, refuse_input_folder, sql_path, sql_text,
                                    versions)


def priority_report(t: Tables, min_total: float) -> DataFrame:
    """Orders above ``:min_total`` per priority.  SQL text with a named
    parameter; the orders DataFrame is passed in by keyword, so the text
    names no catalog table."""
    return t.spark.sql(
        """
        SELECT o_orderpriority,
               count(*)                    AS n_orders,
               round(sum(o_totalprice), 2) AS total_price
        FROM {orders}
        WHERE o_totalprice > :min_total
        GROUP BY o_orderpriority
        """,
        args={"min_total": float(min_total)},
        orders=t.orders,
    )


def segment_big_orders(t: Tables, min_total: float = 300_000) -> DataFrame:
    """Multi-step: filter orders, aggregate per customer, join customer,
    aggregate per segment.  The steps stay lazy and become one plan."""
    big = t.orders.where(F.col("o_totalprice") > min_total)
    per_customer = big.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("_n"),
                                                F.sum("o_totalprice").alias("_total"))
    joined = per_customer.join(t.customer.select("c_custkey", "c_mktsegment"),
                               F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy("c_mktsegment").agg(F.sum("_n").alias("n_big_orders"),
                                              money(F.sum("_total")).alias("big_total"))


SUMMARY_SCHEMA = "o_orderstatus string, n_orders bigint, total_price double, year int"


def order_summary(t: Tables, year: int | None = None) -> DataFrame:
    o = t.orders
    if year is not None:
        o = o.where((F.col("o_orderdate") >= F.make_timestamp_ntz(
            F.lit(year), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)))
                    & (F.col("o_orderdate") < F.make_timestamp_ntz(
            F.lit(year + 1), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))))
    return (o.groupBy("o_orderstatus", year_of("o_orderdate").alias("year"))
             .agg(F.count(F.lit(1)).alias("n_orders"),
                  money(F.sum("o_totalprice")).alias("total_price")))


def _inputs(t: Tables, df: DataFrame) -> list[str]:
    """The folder the tables lie in, or the files of a hand-made frame."""
    if t.reads_files:
        return [t.root]
    return sorted({f.rsplit("/", 1)[0] for f in df.inputFiles()})


def refresh_order_summary(t: Tables, out_dir: str, year: int | None = None) -> DataFrame:
    """Rebuild the order summary under ``out_dir`` as a new version,
    partitioned by year: the whole table, or only ``year``, whose rows are
    replaced (and gone if the year has no orders any more) while the other
    years are taken over from the version before.  If another write comes
    between, a one-year refresh publishes nothing and raises
    ConcurrentWrite.  Returns the new version read back; readers of older ones are not disturbed.  ``out_dir`` must
    not overlap a folder the orders are read from."""
    refuse_input_folder(t.spark, out_dir, _inputs(t, t.orders))
    base = out_dir.rstrip("/")
    fresh = order_summary(t, year)
    before = versions(t.spark, base)
    if year is not None and before:
        old = t.spark.read.schema(SUMMARY_SCHEMA).parquet(before[-1])
        fresh = old.where(F.col("year").isNull() | (F.col("year") != year)).unionByName(fresh)
        path = publish_after(t.spark, fresh, base, before[-1], ["year"])
    else:
        path = publish(fresh, base, ["year"])
    return t.spark.read.schema(SUMMARY_SCHEMA).parquet(path)


def default_summary_dir(t: Tables) -> str:
    return f"{output_dir(t.spark)}/order_summary_{t.token}"


def register_orders_above(t: Tables) -> str:
    """A parameterised view: SQL table function ``orders_above(lo)``."""
    source = f"orders_{t.token}"
    fn = f"orders_above_{t.token}"
    t.orders.createOrReplaceTempView(source)
    t.spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {fn}(lo DOUBLE)
        RETURNS TABLE (o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE)
        RETURN SELECT o_orderkey, o_custkey, o_totalprice
               FROM {source}
               WHERE o_totalprice > lo""")
    return fn


def orders_above(t: Tables, lo: float) -> DataFrame:
    fn = register_orders_above(t)
    return t.spark.sql(f"SELECT * FROM {fn}(:lo)", args={"lo": float(lo)})


# Constant text: table names and the threshold are bound as parameters
# (IDENTIFIER(:name) for names), never formatted into the script.  Orders
# are summed per customer before the join.
SEGMENT_SELECT = """
  SELECT c_mktsegment,
         sum(n)               AS n_orders,
         round(sum(total), 2) AS total_price
  FROM (SELECT o_custkey, count(*) AS n, sum(o_totalprice) AS total
        FROM IDENTIFIER(:orders) WHERE o_totalprice > {lo} GROUP BY o_custkey)
       JOIN IDENTIFIER(:customer) ON o_custkey = c_custkey
  GROUP BY c_mktsegment"""

SEGMENT_SCRIPT = """
BEGIN
  DECLARE lo DOUBLE DEFAULT :min_total;
  IF lo IS NULL THEN
    SET lo = (SELECT avg(o_totalprice) FROM IDENTIFIER(:orders));
  END IF;
  INSERT OVERWRITE TABLE IDENTIFIER(:target)""" + SEGMENT_SELECT.format(lo="lo") + """;
END"""


def _segment_sources(t: Tables) -> dict[str, str]:
    names = {"orders": f"orders_{t.token}", "customer": f"customer_{t.token}"}
    t.orders.createOrReplaceTempView(names["orders"])
    t.customer.createOrReplaceTempView(names["customer"])
    return names


def segment_report_plan(t: Tables) -> DataFrame:
    """The rows the script below writes, as a plan."""
    default = "(SELECT avg(o_totalprice) FROM IDENTIFIER(:orders))"
    return t.spark.sql(SEGMENT_SELECT.format(lo=default), args=_segment_sources(t))


def segment_report_script(t: Tables, min_total: float | None = None,
                          location: str | None = None) -> DataFrame:
    """A procedure written as a SQL script: a parameter whose default
    (the average order total) is computed in SQL, a branch, and an
    INSERT OVERWRITE that runs as a distributed job.  Returns the rows
    written.

    Each run fills a table of its own, a new version under ``location``, so
    frames returned by earlier runs stay readable.  A script hands back its
    last result through the driver, so it ends in the write and the rows
    are read back instead."""
    spark = t.spark
    names = _segment_sources(t)
    base = (location or f"{output_dir(spark)}/segment_orders_{t.token}").rstrip("/")
    refuse_input_folder(spark, base, _inputs(t, t.orders))
    path = new_version(base)
    target = f"segment_orders_{t.token}_{uuid.uuid4().hex}"
    spark.sql(f"""
        CREATE TABLE {target}
            (c_mktsegment STRING, n_orders BIGINT, total_price DOUBLE)
        USING parquet LOCATION {sql_text(path)}""")
    try:
        spark.sql(SEGMENT_SCRIPT, args={
            "min_total": None if min_total is None else float(min_total), "target": target, **names})
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {target}")          # external: the files stay
    return spark.read.schema("c_mktsegment string, n_orders bigint, total_price double").parquet(path)


def publish_order_summary(t: Tables, base_dir: str | None = None,
                          version: str | None = None) -> DataFrame:
    """Refresh the order summary as a new version and switch a view to it.

    Only when the write of the version has committed is the view
    ``order_summary_<token>`` replaced to read it.  Readers of the view
    see the old version or the new one, never a half-written table.
    ``remove_old_versions`` drops older ones.  Returns the view."""
    spark = t.spark
    base = (base_dir or f"{output_dir(spark)}/order_summary_versions_{t.token}").rstrip("/")
    refuse_input_folder(spark, base, _inputs(t, t.orders))
    path = publish(order_summary(t), base, version=version)
    view = f"order_summary_{t.token}"
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM parquet.{sql_path(path)}")
    return spark.table(view)
