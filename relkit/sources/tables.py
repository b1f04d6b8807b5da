"""Input tables.

``Tables`` hands out one DataFrame per table name.  Reads are lazy and
take every column: Catalyst prunes the scan to the columns a query
uses (``ReadSchema``) and pushes its filters into the Parquet reader
(``PushedFilters``), so nothing is gained by pruning here by hand.

Queries take a ``Tables`` rather than a path so they run unchanged on
hand-made DataFrames (tests with nulls, empty inputs, duplicate keys).
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# The table names of the shared test data.
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


# The schemas of the relational test tables.  Declaring
# them keeps the types fixed; they are checked against the files once.  Other tables are inferred.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
              "props string",
}


def dataset_token(root: str) -> str:
    """Short stable id for a data folder; used to give views, functions
    and written tables distinct names per data set, because a view made
    from SQL text binds its sources by name when it is read."""
    return hashlib.sha1(root.rstrip("/").encode()).hexdigest()[:10]


_checked: set[tuple[str, str]] = set()


def check_schema(spark: SparkSession, name: str, path: str) -> None:
    """Raises if the files lack a declared column or hold it in another
    type: read with the declared schema it would be null.  The footer is
    looked at once per table and application."""
    key = (spark.sparkContext.applicationId, path)
    if key in _checked:
        return
    found = dict(spark.read.parquet(path).dtypes)
    wrong = [f"{c} {t} (found: {found.get(c, 'no such column')})"
             for c, t in (x.split() for x in SCHEMAS[name].split(", ")) if found.get(c) != t]
    if wrong:
        raise ValueError(f"table {name} at {path} differs from its declared schema: {'; '.join(wrong)}")
    _checked.add(key)


class Tables:
    def __init__(self, spark: SparkSession, root: str | None = None,
                 frames: Mapping[str, DataFrame] | None = None, infer_schema: bool = False):
        self.spark = spark
        self.root = root.rstrip("/") if root else None
        self._frames = dict(frames or {})
        # given frames may read anywhere, whatever the root is
        self.reads_files = root is not None and not frames
        self.infer_schema = infer_schema

    @classmethod
    def from_dir(cls, spark: SparkSession, root: str, infer_schema: bool = False) -> "Tables":
        """Tables under ``root`` (``<root>/<name>.parquet``).  The known
        tables are read with their declared schemas; ``infer_schema=True``
        reads the Parquet footers instead (for data whose types differ)."""
        return cls(spark, root=root, infer_schema=infer_schema)

    @classmethod
    def from_frames(cls, spark: SparkSession, **frames: DataFrame) -> "Tables":
        return cls(spark, frames=frames)

    @property
    def token(self) -> str:
        return dataset_token(self.root or "frames-%d" % id(self))

    def path(self, name: str) -> str:
        if self.root is None:
            raise KeyError(f"table {name!r} was not supplied")
        return f"{self.root}/{name}.parquet"

    def table(self, name: str) -> DataFrame:
        df = self._frames.get(name)
        if df is None:
            reader = self.spark.read
            if name in SCHEMAS and not self.infer_schema:
                check_schema(self.spark, name, self.path(name))
                reader = reader.schema(SCHEMAS[name])
            df = reader.parquet(self.path(name))
            self._frames[name] = df
        return df

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in TABLES:
            raise AttributeError(name)
        return self.table(name)

    def register_views(self, names: tuple[str, ...] = tuple(SCHEMAS)) -> list[str]:
        """Register the tables as temp views under their own names, so SQL
        text can name them (``spark.sql("SELECT ... FROM orders")``).
        A later registration under the same name replaces the view, and
        SQL-text views built on top see the new table."""
        for name in names:
            self.table(name).createOrReplaceTempView(name)
        return list(names)
