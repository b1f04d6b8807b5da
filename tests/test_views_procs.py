"""Views and procedures: rebinding, idempotent refresh, one-partition
refresh, parameters."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF0001, SF001
from oracle import rows_of
from relkit.plans import procedures as P
from relkit.plans import views as V
from relkit.sources import Tables
from relkit.sources.summary import versions


def bag(df):
    return rows_of(df.toPandas())


def test_view_wraps_its_query(spark):
    t = Tables.from_dir(spark, SF0001)
    want = t.orders.where(F.col("o_totalprice") > 200000).select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    assert bag(V.big_orders(t)) == bag(want)
    assert V.big_orders(t).count() == 900


def test_views_of_two_data_sets_do_not_mix(spark):
    small, big = Tables.from_dir(spark, SF0001), Tables.from_dir(spark, SF001)
    a = V.big_order_counts(small)
    b = V.big_order_counts(big)
    assert V.big_orders_view_name(small) != V.big_orders_view_name(big)
    assert a.count() != b.count()
    # re-reading the first view after the second exists still sees its own data
    assert spark.table(f"big_order_counts_{small.token}").count() == a.count()


def test_view_rebuilt_after_source_changes(spark):
    orders = Tables.from_dir(spark, SF0001).orders
    t1 = Tables(spark, root="/virtual/one", frames={"orders": orders})
    V.create_big_order_counts_view(t1)
    n1 = spark.table(f"big_order_counts_{t1.token}").count()
    t2 = Tables(spark, root="/virtual/one", frames={"orders": orders.limit(5)})
    V.create_big_order_counts_view(t2)
    n2 = spark.table(f"big_order_counts_{t1.token}").count()
    assert n1 > n2 >= 1


def test_persisted_view_over_saved_table(spark, scratch_dir):
    t = Tables.from_dir(spark, SF001)
    df = V.frequent_customers_view(t, location=os.path.join(scratch_dir, "totals"))
    assert df.count() == 124
    assert spark.catalog.tableExists(f"frequent_customers_{t.token}")
    # a second run overwrites the saved table in place
    assert V.frequent_customers_view(t, location=os.path.join(scratch_dir, "totals")).count() == 124


def test_priority_report_parameter(spark):
    t = Tables.from_dir(spark, SF0001)
    lo = P.priority_report(t, 200000).agg(F.sum("n_orders")).collect()[0][0]
    hi = P.priority_report(t, 400000).agg(F.sum("n_orders")).collect()[0][0]
    assert lo == 900 and hi < lo


def test_refresh_twice_is_idempotent(spark, scratch_dir):
    t = Tables.from_dir(spark, SF001)
    out = os.path.join(scratch_dir, "summary")
    first = bag(P.refresh_order_summary(t, out))
    second = bag(P.refresh_order_summary(t, out))
    assert first == second and len(first) == 21


def test_one_year_refresh_keeps_other_years(spark, scratch_dir):
    t = Tables.from_dir(spark, SF001)
    out = os.path.join(scratch_dir, "summary")
    full = bag(P.refresh_order_summary(t, out))
    after = bag(P.refresh_order_summary(t, out, year=1997))
    assert after == full
    total = spark.read.parquet(versions(spark, out)[-1]).agg(F.sum("n_orders")).collect()[0][0]
    assert total == 15000


def test_one_year_refresh_replaces_only_that_year(spark, scratch_dir):
    full = Tables.from_dir(spark, SF001)
    out = os.path.join(scratch_dir, "summary")
    P.refresh_order_summary(full, out)
    # refresh 1997 from a table that holds only half of 1997's orders
    half = Tables(spark, root="/virtual/half", frames={
        "orders": full.orders.where(F.col("o_orderkey") % 2 == 0)})
    df = P.refresh_order_summary(half, out, year=1997)
    per_year = {r.year: r.n for r in df.groupBy("year").agg(F.sum("n_orders").alias("n")).collect()}
    want = {r.year: r.n for r in P.order_summary(full).groupBy("year")
            .agg(F.sum("n_orders").alias("n")).collect()}
    assert per_year[1997] < want[1997]
    assert {y: n for y, n in per_year.items() if y != 1997} == \
           {y: n for y, n in want.items() if y != 1997}


def test_refresh_refuses_input_folder(spark):
    t = Tables.from_dir(spark, SF0001)
    with pytest.raises(ValueError):
        P.refresh_order_summary(t, SF0001 + "/summary")


def test_table_function_parameter(spark):
    t = Tables.from_dir(spark, SF0001)
    assert P.orders_above(t, 200000).count() == 900
    assert P.orders_above(t, 1e12).count() == 0


def test_sql_script_procedure(spark, scratch_dir):
    t = Tables.from_dir(spark, SF0001)
    loc = os.path.join(scratch_dir, "segments")
    by_avg = P.segment_report_script(t, location=loc)
    avg = t.orders.agg(F.avg("o_totalprice")).collect()[0][0]
    want = t.orders.where(F.col("o_totalprice") > avg).count()
    assert by_avg.agg(F.sum("n_orders")).collect()[0][0] == want
    # an explicit threshold overwrites the table
    fixed = P.segment_report_script(t, 200000, location=loc)
    assert fixed.agg(F.sum("n_orders")).collect()[0][0] == 900


def test_versioned_refresh_switches_view(spark, scratch_dir):
    full = Tables.from_dir(spark, SF001)
    base = os.path.join(scratch_dir, "versions")
    v1 = P.publish_order_summary(full, base, version="1")
    assert v1.agg(F.sum("n_orders")).collect()[0][0] == 15000
    half = Tables(spark, root=SF001, frames={
        "orders": full.orders.where(F.col("o_orderkey") % 2 == 0)})
    v2 = P.publish_order_summary(half, base, version="2")
    n2 = v2.agg(F.sum("n_orders")).collect()[0][0]
    assert n2 < 15000
    # the view now reads version 2; version 1 is untouched
    assert spark.table(f"order_summary_{full.token}").agg(F.sum("n_orders")).collect()[0][0] == n2
    assert spark.read.parquet(os.path.join(base, "v=1")).agg(F.sum("n_orders")).collect()[0][0] == 15000
    # a version is never overwritten
    with pytest.raises(Exception):
        P.publish_order_summary(full, base, version="1")


def test_earlier_frames_stay_readable(spark, scratch_dir):
    t = Tables.from_dir(spark, SF0001)
    for name, build in (("v", V.frequent_customers_view), ("p", P.refresh_order_summary)):
        where = os.path.join(scratch_dir, name)
        first = build(t, where)
        build(t, where)
        assert first.count() >= 0 and build(t, where).count() == first.count()
    first = P.segment_report_script(t, location=os.path.join(scratch_dir, "s"))
    P.segment_report_script(t, 1e12, location=os.path.join(scratch_dir, "s"))
    assert first.count() == 5


def test_emptied_year_disappears(spark, scratch_dir):
    full = Tables.from_dir(spark, SF001)
    out = os.path.join(scratch_dir, "summary")
    P.refresh_order_summary(full, out)
    without = Tables.from_frames(spark, orders=full.orders.where(F.year("o_orderdate") != 1996))
    years = {r.year for r in P.refresh_order_summary(without, out, year=1996).select("year").distinct().collect()}
    assert 1996 not in years and 1997 in years


def test_failed_write_leaves_the_old_version(spark, scratch_dir):
    from relkit.sources import summary
    t = Tables.from_dir(spark, SF0001)
    out = os.path.join(scratch_dir, "summary")
    before = bag(P.refresh_order_summary(t, out))
    broken = P.order_summary(t).withColumn("n_orders", F.raise_error(F.lit("no")).cast("bigint"))
    with pytest.raises(Exception):
        summary.publish(broken, out)
    newest = summary.versions(spark, out)
    assert len(newest) == 1 and bag(spark.read.schema(P.SUMMARY_SCHEMA).parquet(newest[-1])) == before


def test_old_versions_are_removed_on_request(spark, scratch_dir):
    from relkit.sources import summary
    t = Tables.from_dir(spark, SF0001)
    out = os.path.join(scratch_dir, "summary")
    for _ in range(4):
        last = P.refresh_order_summary(t, out)
    assert len(summary.remove_old_versions(spark, out, keep=1)) == 3
    assert len(summary.versions(spark, out)) == 1 and last.count() > 0


@pytest.mark.parametrize("out, ok", [
    ("{root}/summary", False), ("file:{root}/x", False), ("file://{root}", False), ("{parent}", False),
    ("{root}/../{name}/y", False), ("{root}0/out", True)])
def test_input_folders_are_compared_as_paths(spark, out, ok):
    from relkit.sources.summary import refuse_input_folder
    parent, name = os.path.split(SF0001)
    path = out.format(root=SF0001, parent=parent, name=name)
    if ok:
        refuse_input_folder(spark, path, [SF0001])
    else:
        with pytest.raises(ValueError):
            refuse_input_folder(spark, path, [SF0001])


def test_frames_refuse_their_own_files(spark, scratch_dir):
    src = os.path.join(scratch_dir, "o")
    Tables.from_dir(spark, SF0001).orders.write.parquet(src)
    t = Tables.from_frames(spark, orders=spark.read.parquet(src))
    with pytest.raises(ValueError):
        P.refresh_order_summary(t, src + "/summary")


def test_paths_with_quotes(spark, scratch_dir):
    t = Tables.from_dir(spark, SF0001)
    odd = os.path.join(scratch_dir, "it's a `folder`")
    assert P.segment_report_script(t, location=odd + "/s").count() == 5
    assert P.publish_order_summary(t, odd + "/p").count() > 0
    assert V.frequent_customers_view(t, odd + "/v").count() >= 0


def test_missing_or_retyped_columns_raise(spark, scratch_dir):
    part = spark.read.parquet(f"{SF0001}/part.parquet")
    for k, df in enumerate((part.drop("p_size"), part.withColumn("p_size", F.col("p_size").cast("string")))):
        root = os.path.join(scratch_dir, f"d{k}")
        df.write.parquet(f"{root}/part.parquet")
        with pytest.raises(ValueError, match="p_size"):
            Tables.from_dir(spark, root).part


def test_output_folder_must_be_named_on_a_cluster(spark, monkeypatch):
    import relkit.session as session
    monkeypatch.setattr(session, "_local", lambda s: False)
    with pytest.raises(RuntimeError):
        session.output_dir(spark)
    spark.conf.set(session.OUTPUT_DIR, "/shared/out")
    try:
        assert session.output_dir(spark) == "/shared/out"
    finally:
        spark.conf.unset(session.OUTPUT_DIR)


def on_a_cluster(monkeypatch):
    """The session passes for one whose executors are not in the driver."""
    import relkit.session as session
    monkeypatch.setattr(session, "_local", lambda s: False)
    monkeypatch.setattr(session, "_has_executors", lambda s: True, raising=False)
    monkeypatch.setattr(session, "_shared", set(), raising=False)
    return session


def made_orders(spark, folder):
    """2 customers with 16 orders each, one a month; one order has no date."""
    rows = [(16 * c + k, c, "OF"[c], 100.0 * (k + 1), None if k == 15 else f"{1995 + k // 12}-{k % 12 + 1:02d}-01 00:00:00", "1-URGENT")
            for c in range(2) for k in range(16)]
    orders = spark.createDataFrame(rows, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
                                         "o_orderdate string, o_orderpriority string")
    orders.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz")).write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame([(c, "name", 1, 0.0, "AB"[c]) for c in range(2)], "c_custkey bigint, c_name string, "
                          "c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(f"{folder}/customer.parquet")
    events = spark.createDataFrame([(k, f"2024-01-{k // 2 + 1:02d} 10:00:00", k, "view", 1.5, None) for k in range(6)],
                                   "event_id bigint, ts string, user_id bigint, event_type string, value double, props string")
    events.withColumn("ts", F.col("ts").cast("timestamp_ntz")).write.parquet(f"{folder}/events.parquet")
    return folder


SUMMARY_ROWS = {(s, y, n, t) for s in "OF" for y, n, t in ((1995, 12, 7800.0), (1996, 3, 4200.0), (None, 1, 1600.0))}


def written_on_a_cluster(spark, monkeypatch, scratch_dir, name):
    from relkit.catalog import BY_NAME
    on_a_cluster(monkeypatch)
    return BY_NAME[name].run(spark, made_orders(spark, scratch_dir))


def test_refresh_on_a_cluster_with_a_shared_warehouse(spark, monkeypatch, scratch_dir):
    df = written_on_a_cluster(spark, monkeypatch, scratch_dir, "p3_refresh_summary")
    assert {(r.o_orderstatus, r.year, r.n_orders, r.total_price) for r in df.collect()} == SUMMARY_ROWS
    warehouse = spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:")
    assert all(f.removeprefix("file://").startswith(f"{warehouse}/relkit/") for f in df.inputFiles())
    assert not [f for f in os.listdir(f"{warehouse}/relkit") if f.startswith("_shared-")]


def test_checkpoint_folder_stands_in_for_a_warehouse_that_is_not_shared(spark, monkeypatch, scratch_dir):
    session = on_a_cluster(monkeypatch)
    assert not session._executors_share(spark, "file:///proc/version/relkit")
    assert session._executors_share(spark, f"file://{scratch_dir}/relkit")
    class Named:                              # a session that names these folders
        conf = {"spark.sql.warehouse.dir": "/own/warehouse", "spark.checkpoint.dir": "/shared/checkpoints"}
        sparkContext, _jvm, _jsc = spark.sparkContext, spark._jvm, spark._jsc
    monkeypatch.setattr(session, "_executors_share", lambda s, folder: folder.startswith("file:///shared/"))
    assert session.output_dir(Named) == "file:///shared/checkpoints/relkit"
    monkeypatch.setattr(session, "_executors_share", lambda s, folder: False)
    with pytest.raises(RuntimeError):
        session.output_dir(Named)


def test_script_on_a_cluster_with_a_shared_warehouse(spark, monkeypatch, scratch_dir):
    df = written_on_a_cluster(spark, monkeypatch, scratch_dir, "p5_sql_script")
    assert {tuple(r) for r in df.collect()} == {("A", 8, 10000.0), ("B", 8, 10000.0)}


def test_versioned_refresh_on_a_cluster_with_a_shared_warehouse(spark, monkeypatch, scratch_dir):
    df = written_on_a_cluster(spark, monkeypatch, scratch_dir, "p6_versioned_refresh")
    assert {(r.o_orderstatus, r.year, r.n_orders, r.total_price) for r in df.collect()} == SUMMARY_ROWS


def test_stream_on_a_cluster_with_a_shared_warehouse(spark, monkeypatch, scratch_dir):
    df = written_on_a_cluster(spark, monkeypatch, scratch_dir, "t6_stream_totals")
    assert {(str(r.day)[:10], r.event_type, r.n_events, r.total_value) for r in df.collect()} == \
           {("2024-01-01", "view", 2, 3.0), ("2024-01-02", "view", 2, 3.0)}


def test_persisted_view_on_a_cluster_with_a_shared_warehouse(spark, monkeypatch, scratch_dir):
    df = written_on_a_cluster(spark, monkeypatch, scratch_dir, "v3_persisted_view")
    assert {tuple(r) for r in df.collect()} == {(0, 16, 13600.0), (1, 16, 13600.0)}
