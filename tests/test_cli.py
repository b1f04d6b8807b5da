from conftest import SF0001

from relkit.__main__ import main
from relkit.catalog import QUERIES
from relkit.sources import Tables


def test_list(capsys):
    assert main(["list"]) == 0
    assert capsys.readouterr().out.split() == [q.name for q in QUERIES]


def test_run_and_sql(spark, capsys):
    assert main(["run", "a15_pivot", "--data", SF0001]) == 0
    assert "n_f" in capsys.readouterr().out
    assert main(["sql", "SELECT count(*) AS n FROM nation", "--data", SF0001]) == 0
    assert "25" in capsys.readouterr().out


def test_unknown_query():
    assert main(["run", "nope"]) == 2


def test_register_views(spark):
    names = Tables.from_dir(spark, SF0001).register_views()
    assert "orders" in names
    assert spark.sql("SELECT count(*) FROM orders").collect()[0][0] == 1500


def test_sizing_conf():
    from relkit.session import sizing_conf
    tb = 1 << 40
    big = sizing_conf(100 * tb)
    assert big["spark.sql.shuffle.partitions"] == "102400"       # one per GB, no cap
    assert big["spark.sql.files.maxPartitionBytes"] == str(256 << 20)
    assert sizing_conf(10 << 30)["spark.sql.shuffle.partitions"] == "10"
    assert sizing_conf(1)["spark.sql.shuffle.partitions"] == "8"


def test_inferred_schema_matches_declared(spark):
    declared = Tables.from_dir(spark, SF0001)
    inferred = Tables.from_dir(spark, SF0001, infer_schema=True)
    for name in ("orders", "lineitem", "customer", "nation"):
        assert declared.table(name).schema.simpleString() == inferred.table(name).schema.simpleString()


def test_sql_file(spark, capsys, tmp_path):
    f = tmp_path / "q.sql"
    f.write_text("SELECT count(*) AS n_regions FROM region")
    assert main(["sql", "--file", str(f), "--data", SF0001]) == 0
    assert "n_regions" in capsys.readouterr().out


def test_explain(spark, capsys):
    assert main(["explain", "j8_range_join", "--data", SF0001]) == 0
    out = capsys.readouterr().out
    assert "Physical Plan" in out and "NestedLoop" not in out


def test_explain_writes_nothing(spark, capsys, tmp_path):
    spark.conf.set("spark.relkit.output.dir", str(tmp_path / "out"))
    try:
        for name in ("v3_persisted_view", "p3_refresh_summary", "p5_sql_script", "p6_versioned_refresh"):
            assert main(["explain", name, "--data", SF0001]) == 0
            assert "Exchange" in capsys.readouterr().out
    finally:
        spark.conf.unset("spark.relkit.output.dir")
    assert not (tmp_path / "out").exists()
