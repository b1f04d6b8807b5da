"""The SQL text of every query runs unchanged on Spark SQL over the
registered tables and returns the rows of the DataFrame version: SQL
written for another engine runs here as it is."""

import pytest

from conftest import SF0001
from oracle import rows_of
from relkit.catalog import QUERIES
from relkit.sources import Tables


@pytest.fixture(scope="module")
def registered(spark):
    Tables.from_dir(spark, SF0001).register_views()
    return spark


@pytest.mark.parametrize("q", [q for q in QUERIES if q.sql and q.portable], ids=lambda q: q.name)
def test_sql_text_runs_on_spark(registered, q):
    spark = registered
    assert rows_of(spark.sql(q.sql).toPandas()) == rows_of(q.run(spark, SF0001).toPandas())
