"""Queries over time and nested data: the event stream and the life of
orders, on the operators of :mod:`relkit.operators.timeline`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relkit.functions import money
from relkit.operators.timeline import as_of_join, concurrent, micros, sessions, trailing_sums
from relkit.sources import Tables

DAY_MICROS = 86_400_000_000


def errors_after_purchases(t: Tables, split: bool | int | None = None) -> DataFrame:
    """As-of join: every error event with the same user's latest purchase
    at or before it."""
    e = t.events
    errors = e.where("event_type = 'error'").select("event_id", "user_id", "ts")
    bought = e.where("event_type = 'purchase'").select(
        "user_id", F.col("ts").alias("purchase_ts"), F.col("event_id").alias("purchase_id"), F.col("value").alias("purchase_value"))
    return as_of_join(errors, bought, ["user_id"], "ts", "purchase_ts", "purchase_id",
                      ["purchase_id", "purchase_ts", "purchase_value"], split)


def trailing_spend(t: Tables, days: int = 30, split: bool | int | None = None) -> DataFrame:
    """Range-frame window: every order with its customer's orders and spend
    over the ``days`` days up to it."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", micros("o_orderdate").alias("_at"))
    sums = {"n_orders": F.lit(1).cast("bigint"), "_spent": F.col("o_totalprice")}
    got = trailing_sums(o, ["o_custkey"], "_at", days * DAY_MICROS, sums, split)
    return got.select("o_orderkey", "o_custkey", "o_orderdate", "n_orders", money(F.col("_spent")).alias("spent"))


def open_orders(t: Tables, split: bool | int | None = None) -> DataFrame:
    """Sweep line: how many orders are open from each instant on.  An order
    is open from its date until its last item ships; without items it
    stays open."""
    shipped = t.lineitem.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("done"))
    spans = t.orders.select("o_orderkey", "o_orderdate").join(shipped, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return concurrent(spans, "o_orderdate", "done", split=split)


def user_sessions(t: Tables, gap_seconds: int = 21_600, split: bool | int | None = None) -> DataFrame:
    """Sessions: each user's events without a gap of over six hours."""
    aggs = [F.count(F.lit(1)).alias("n_events"), money(F.sum("value")).alias("total_value")]
    return sessions(t.events.select("event_id", "user_id", "ts", "value"), ["user_id"], "ts", gap_seconds, aggs, "event_id", split)


def event_properties(t: Tables) -> DataFrame:
    """Nested data: per event type and property name, how often it occurs
    and its numbers.  ``props`` is read as a map, so new properties need no
    schema; nested values count as text.  Events without a property
    (``key`` null) are missing (null), malformed (no JSON object) or empty."""
    props = F.from_json("props", "map<string,string>")
    e = t.events.select("event_type", "props", props.alias("map"))
    each = e.select("event_type", "props", "map", F.explode_outer("map").alias("key", "text"))
    number = F.expr("try_cast(text AS double)")
    return each.groupBy("event_type", "key").agg(
        F.count(F.lit(1)).alias("n_events"), F.count_if(F.col("props").isNull()).alias("n_missing"),
        F.count_if(F.col("props").isNotNull() & F.col("map").isNull()).alias("n_malformed"),
        F.count(number).alias("n_numbers"), money(F.sum(number)).alias("total"))
