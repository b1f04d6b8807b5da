"""Every registered query against its DuckDB SQL at sf0.01 (the scale
the correctness gate uses), plus the expected row counts."""

import pytest

from conftest import SF001
from oracle import compare, duck
from relkit.catalog import QUERIES

import __spark_entry__ as E


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("q", [q for q in QUERIES if q.sql], ids=lambda q: q.name)
def test_matches_duckdb(spark, con, q):
    ok, msg = compare(q.run(spark, SF001), con, q.sql)
    assert ok, msg


@pytest.mark.parametrize("q", [q for q in QUERIES if q.rows_sf001 is not None],
                         ids=lambda q: q.name)
def test_row_count(spark, q):
    assert q.run(spark, SF001).count() == q.rows_sf001


def test_entry_contract(spark):
    df = E.entry(spark)
    assert [f.name for f in df.schema.fields] == ["r_name", "revenue"]
    assert df.count() == 5
    own = {q.name for q in QUERIES}
    assert own <= set(E.queries()) and own <= set(E.oracle_sql()) <= set(E.queries())
