"""Connected components of a table of links, by alternating star steps
(large-star, small-star): every step hangs a node's neighbours on the
smallest of them, until each component is a star around its smallest
node.  Before each step every task joins the links of its own partition to
stars (union-find over a bounded number of rows), so long chains shrink at
once and a node has one link a partition to a smaller one (left out if ``native``, for
operators that run no Python: the same result in more rounds).  Minima are
combined map-side, so a hub's links are not gathered; the tables of minima
are broadcast behind a count, and else joined with adaptive skew handling.
Links stay distributed and are pinned between rounds; what a round has
used is removed."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relkit.llm.common import parts_for, pinned, released

BROADCAST_ROWS = 1_000_000            # of two numbers
_LINKS = 250_000                      # links a task joins at a time


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """u, v: links of the same components as the task's, each larger node
    hung on the smallest of its own."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        root = x
        while (over := up.get(root, root)) != root:
            root = over
        while (over := up.get(x, x)) != root:
            up[x], x = root, over
        return root

    def told() -> pa.RecordBatch:
        nodes = sorted(up)
        rows = [(x, r) for x in nodes if (r := top(x)) != x]
        up.clear()
        return pa.RecordBatch.from_arrays([pa.array([x for x, _ in rows], pa.int64()),
                                           pa.array([r for _, r in rows], pa.int64())], ["u", "v"])

    for batch in batches:
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
            a, b = sorted((top(u), top(v)))
            if a != b:
                up[b] = a
        if len(up) >= _LINKS:
            yield told()
    yield told()


def _mark(edges: DataFrame) -> tuple[int, object]:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b", native: bool = False) -> DataFrame:
    """node, root for every node of a link between two different nodes
    (whole numbers); root is the smallest node of the component.  Null ends
    are ignored."""
    spark = links.sparkSession

    def joined(df: DataFrame, rows: int) -> DataFrame:
        few = df.coalesce(parts_for(spark, rows))
        return pinned(few if native else few.mapInArrow(_stars, "u bigint, v bigint"))

    def bounded(df: DataFrame, rows: int) -> DataFrame:
        return F.broadcast(df) if rows <= BROADCAST_ROWS else df

    own = pinned(links.where(F.col(a) != F.col(b))
                      .select(F.greatest(a, b).cast("bigint").alias("u"), F.least(a, b).cast("bigint").alias("v")))
    edges = joined(own.distinct() if native else own, own.count())
    released(own)
    before, now = None, _mark(edges)
    while now != before and (native or edges.rdd.getNumPartitions() > 1):
        # large-star: (u, v) goes to the smallest that v hangs on
        least = bounded(edges.groupBy("u").agg(F.min("v").alias("m")), now[0])
        up = least.withColumnRenamed("u", "v")
        large = joined(edges.join(up, "v", "left").select("u", F.coalesce("m", "v").alias("v")).distinct(), now[0])
        # small-star: all that u hangs on go to the smallest of them
        least = bounded(large.groupBy("u").agg(F.min("v").alias("m")), now[0])
        hung = large.join(least, "u")
        small = (hung.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                     .unionByName(hung.select("u", F.col("m").alias("v"))).distinct())
        step = joined(small, now[0])
        released(edges, large)
        edges = step
        before, now = now, _mark(edges)
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
                 .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")))
                 .distinct())
