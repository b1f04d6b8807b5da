"""The corpus queries that SQL can express, against DuckDB."""

import pytest

from conftest import SF001, SF0001
from oracle import compare, duck
from relkit.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
@pytest.mark.parametrize("data", [SF0001, SF001])
def test_matches_duckdb(spark, name, data):
    ok, msg = compare(QUERIES[name](spark, data), duck(data), ORACLE_SQL[name])
    assert ok, msg
