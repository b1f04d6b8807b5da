"""Written tables, published in versions.

A table is a folder of versions.  Every write goes into a folder of its
own, which no reader uses yet; the newest version whose write has
committed is the table.  A reader that has listed an older version goes on
reading it, and a failed write leaves the table as it was.
"""

from __future__ import annotations

import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from relkit.session import qualified


def _listed(spark: SparkSession, base: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(base)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = sorted(s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory())
    return [n for n in names if n.startswith("v=")]


def versions(spark: SparkSession, base: str) -> list[str]:
    """Paths of the committed versions, oldest first."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    out = []
    for n in _listed(spark, base):
        done = jvm.org.apache.hadoop.fs.Path(f"{base}/{n}/_SUCCESS")
        if done.getFileSystem(conf).exists(done):
            out.append(f"{base}/{n}")
    return out


def new_version(base: str, version: str | None = None) -> str:
    """A path for a version; names sort by time unless given."""
    return f"{base}/v={version or f'{time.time_ns():020d}-{uuid.uuid4().hex[:8]}'}"


def publish(df: DataFrame, base: str, partition_cols: list[str] | None = None,
            version: str | None = None) -> str:
    """Write ``df`` as a new version and return its path.  No repartition by
    the partition columns: that would send a whole (possibly hot) value to
    one writer task."""
    path = new_version(base, version)
    writer = df.write.mode("errorifexists")
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.parquet(path)
    return path


class ConcurrentWrite(RuntimeError):
    """Another write came between reading a table and replacing it."""


def publish_after(spark: SparkSession, df: DataFrame, base: str, before: str,
                  partition_cols: list[str] | None = None) -> str:
    """``publish`` for rows made from the version ``before``: if that is no
    longer the newest one, nothing is published and ConcurrentWrite is
    raised.  The rows are written aside first and named when they are
    complete; of two writes from one version, the one that creates the
    version's successor mark (an exclusive create) is published."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    as_path = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    aside = f"{base}/_writing-{uuid.uuid4().hex}"
    fs = as_path(base).getFileSystem(conf)
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(*partition_cols) if partition_cols else writer).parquet(aside)
    mark = f"{base}/_next-of-{before.rsplit('/', 1)[-1]}"
    try:
        if versions(spark, base)[-1:] != [before]:
            raise ConcurrentWrite(f"{base}: {before} is not the newest version any more")
        try:
            fs.create(as_path(mark), False).close()
        except Py4JJavaError as e:
            raise ConcurrentWrite(f"{base}: another write from {before} was published") from e
        path = new_version(base)
        if not fs.rename(as_path(aside), as_path(path)):
            raise RuntimeError(f"could not move {aside} to {path}")
        return path
    finally:
        fs.delete(as_path(aside), True)


def remove_old_versions(spark: SparkSession, base: str, keep: int = 2) -> list[str]:
    """Delete all but the newest ``keep`` committed versions; returns the
    paths deleted.  For the caller to run when no reader uses them."""
    old = versions(spark, base)[:-max(1, keep)]
    for p in old:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return old


def refuse_input_folder(spark: SparkSession, out: str, inputs: list[str]) -> None:
    """Raises if ``out`` is an input folder, lies in one or holds one;
    paths are compared with their schemes, in both directions."""
    o = qualified(spark, out) + "/"
    for p in inputs:
        i = qualified(spark, p) + "/"
        if o.startswith(i) or i.startswith(o):
            raise ValueError(f"refusing to write to {out}: the query reads {p}")


def sql_path(path: str) -> str:
    """A path as a quoted name in SQL text."""
    return "`" + path.replace("`", "``") + "`"


def sql_text(value: str) -> str:
    """A string literal in SQL text."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
