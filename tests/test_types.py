"""Column names and types of every query equal those of its DuckDB SQL
(the correctness gate compares schemas too)."""

import pytest

from conftest import SF0001
from oracle import duck
from relkit.catalog import QUERIES

# Spark type -> DuckDB type name, for the types the queries return
SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
                 "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP"}


@pytest.fixture(scope="module")
def con():
    return duck(SF0001)


@pytest.mark.parametrize("q", [q for q in QUERIES if q.sql], ids=lambda q: q.name)
def test_schema_matches_duckdb(spark, con, q):
    df = q.run(spark, SF0001)
    got = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
           for f in df.schema.fields}
    rel = con.sql(q.sql)
    want = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert got == want
