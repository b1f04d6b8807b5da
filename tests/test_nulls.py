"""Every registered query against its DuckDB SQL on tables with nulls.

The shared test tables hold no null at all, so agreement there says
nothing about null handling.  Here the small tables are copied by Spark
with nulls put into every column (keys included) of about one row in
seven, and the comparison is repeated."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from oracle import compare, duck
from relkit.catalog import QUERIES
from relkit.sources.tables import SCHEMAS

# row key used to pick the rows that get a null, per table
ROW_KEY = {"region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey",
           "supplier": "s_suppkey", "part": "p_partkey", "orders": "o_orderkey",
           "lineitem": "l_orderkey", "events": "event_id"}


@pytest.fixture(scope="module")
def null_dir(spark):
    out = tempfile.mkdtemp(prefix="relkit-nulls-")
    for name in SCHEMAS:
        df = spark.read.parquet(f"{SF0001}/{name}.parquet")
        key = F.col(ROW_KEY[name])
        cols = []
        for i, c in enumerate(df.columns):
            # a different residue per column, so rows get nulls in different columns,
            # the row key among them
            hit = (F.abs(F.hash(key, F.lit(i))) % 7 == 0)
            cols.append(F.when(hit, F.lit(None))
                         .otherwise(F.col(c)).cast(df.schema[c].dataType).alias(c))
        df.select(*cols).write.parquet(os.path.join(out, f"{name}.parquet"))
    return out


@pytest.fixture(scope="module")
def con(null_dir):
    return duck(null_dir, tuple(SCHEMAS))


@pytest.mark.parametrize("q", [q for q in QUERIES if q.sql], ids=lambda q: q.name)
def test_matches_duckdb_with_nulls(spark, con, null_dir, q):
    ok, msg = compare(q.run(spark, null_dir), con, q.sql)
    assert ok, msg
