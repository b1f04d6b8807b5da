"""The pipeline: columns, each stage's decisions, and its registration."""

import corpus_pipeline as P
from conftest import SF0001

import __spark_entry__ as E


def test_stages_in_order(spark, tmp_path):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    columns, first = docs.columns, docs.count()
    seen = []
    for name, stage in P.STAGES:
        out = stage(spark, docs, SF0001)
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen.append((name, docs.count()))
        if name != P.STAGES[-1][0]:
            assert docs.columns == columns
    n = dict(seen)
    assert n["language_id"] <= first and n["line_dedup"] == n["language_id"] and 0 < n["near_dedup"] < n["line_dedup"]
    lines = [x for r in spark.read.parquet(f"{tmp_path}/line_dedup").collect() for x in (r.text or "").split("\n")
             if len(x) >= 24]
    assert len(lines) == len(set(lines))
    kept = {r.doc_id for r in spark.read.parquet(f"{tmp_path}/near_dedup").collect()}
    mixed = [r.doc_id for r in spark.read.parquet(f"{tmp_path}/mix_sources").collect()]
    assert set(mixed) <= kept and max(mixed.count(i) for i in set(mixed)) <= 2
    packed = spark.read.parquet(f"{tmp_path}/packing").collect()
    assert {r.doc_id for r in packed} == set(mixed)


def test_registered():
    assert E.queries()["pipeline"] is P.run and "pipeline" not in E.oracle_sql()
    assert sorted(int(x[2:].split("_")[0]) for x in E.queries() if x.startswith("op")) == list(range(1, 14))


def test_empty_documents(spark, tmp_path):
    spark.read.parquet(f"{SF0001}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0


def test_nulls_in_every_column(spark, tmp_path):
    rows = [(None, None, None, None, None), (1, "some text that is long enough to be judged", "en", "s", 42),
            (1, "some text that is long enough to be judged", "en", "s", 42), (2, "", None, None, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    assert {r.doc_id for r in P.run(spark, str(tmp_path)).collect()} == {1}


def test_line_dedup_leaves_no_repeat_of_any_length(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").union(spark.createDataFrame(
        [(-1, "}\n\nx = 1", "en", "s", 8), (-2, "}\n\ny = 1", "en", "s", 8)],
        spark.read.parquet(f"{SF0001}/documents.parquet").schema))
    out = P.line_dedup(spark, docs, SF0001).collect()
    lines = [x for r in out for x in (r.text or "").split("\n") if x]
    assert len(lines) == len(set(lines))
