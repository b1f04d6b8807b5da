"""Per-key running sums and order statistics that stay spread over many
tasks even when one key holds a large share of the rows.

A plain ``Window.partitionBy(key).orderBy(...)`` sends every row of a key
to one task; a key with a third of the table then runs in one task.
Here the rows are first range-partitioned on ``(key, order...)``, so a
hot key is cut into several contiguous *chunks* (one per range
partition).  Each chunk gets its own running sum; a per-chunk total,
summed over the earlier chunks of the same key, is the offset added
back.

This is used only when some key is in fact that hot (found exactly by
:func:`relkit.plans.skew.split_chunks`); otherwise the plain window runs.

Full-data work of the split form: the range exchange (checkpointed
once, so every branch sees the same chunks) and one hash exchange on
``(key, chunk)`` for the in-chunk window.  The offsets concern only keys
at chunk edges -- at most three rows per chunk -- and are broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relkit.plans.skew import split_chunks
from relkit.session import ensure_checkpoint_dir

_KEY = "_rk_key"
_CHUNK = "_rk_chunk"
_WITHIN = "_rk_within"
_TOTAL = "_rk_total"
_OFFSET = "_rk_offset"


def _cols(cs: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def _num_chunks(df: DataFrame, chunks: int | None) -> int:
    if chunks:
        return chunks
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _edge_keys(ranged: DataFrame, keys: list[str]) -> DataFrame:
    """First and last key of every chunk, as ``_KEY`` structs: a superset
    of the keys that reach into more than one chunk (at most 2 per
    chunk, plus the null key)."""
    if len(keys) == 1:
        k = F.col(keys[0])
        dtype = ranged.schema[keys[0]].dataType
        per_chunk = ranged.groupBy(_CHUNK).agg(F.min(k).alias("_lo"), F.max(k).alias("_hi"),
                                               F.max(k.isNull()).alias("_nul"))
        cands = F.array(F.struct(F.col("_lo").alias(keys[0])),
                        F.struct(F.col("_hi").alias(keys[0])),
                        F.when(F.col("_nul"), F.struct(F.lit(None).cast(dtype).alias(keys[0]))))
    else:
        # Structs order field by field with nulls first, like the range
        # partitioning; min/max of a struct is a sort-based aggregate.
        per_chunk = ranged.groupBy(_CHUNK).agg(F.min(_KEY).alias("_lo"), F.max(_KEY).alias("_hi"))
        cands = F.array("_lo", "_hi")
    return (per_chunk.select(F.explode(cands).alias(_KEY))
                     .where(F.col(_KEY).isNotNull()).distinct())


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                value: str | Sequence[str], out: str | Sequence[str],
                chunks: int | None = None, split: bool | int | None = None,
                totals: str | Sequence[str] = ()) -> DataFrame:
    """``sum(value) OVER (PARTITION BY keys ORDER BY order ROWS BETWEEN
    UNBOUNDED PRECEDING AND CURRENT ROW)``, computed without putting one
    key in one task.  ``value``/``out`` may be lists to take several
    running sums in one pass; ``totals`` names columns for the sums over
    the whole key, one for each of the first values.  ``order`` must be a
    total order within a key (add a unique tie-breaker), as for the plain
    window.  Null keys form their own group and null values are skipped,
    as in the plain window.

    ``split=None`` decides at run time: if some key holds more rows than
    one task should (found exactly by :func:`relkit.plans.skew.split_chunks`),
    the rows are split into range chunks; otherwise the plain window is
    used.  A number gives the chunks, 0 the plain window.  Both give the
    same result.  Select only the needed columns first: in the split form
    the range-partitioned rows are checkpointed once
    (``spark.checkpoint.dir``)."""
    keys = list(keys)
    values = [value] if isinstance(value, str) else list(value)
    outs = [out] if isinstance(out, str) else list(out)
    sums = [totals] if isinstance(totals, str) else list(totals)
    if len(values) != len(outs):
        raise ValueError("one output column per value column")
    if split is None:
        split = split_chunks(df, keys)
    if not split:
        whole = Window.partitionBy(*keys)
        w = whole.orderBy(*_cols(order)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumns({o: F.sum(v).over(w) for v, o in zip(values, outs)}
                              | {s: F.sum(v).over(whole) for v, s in zip(values, sums)})
    n = _num_chunks(df, chunks or (None if isinstance(split, bool) else split))
    return _chunked_running_sum(df, keys, order, values, outs, sums, n)


def _chunked_running_sum(df: DataFrame, keys: list[str], order: Sequence[str | Column],
                         values: list[str], outs: list[str], sums: list[str], n: int) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    # The chunk id is the range partition index.  Range bounds come from
    # a sample whose seed depends on the exchange instance, so every
    # branch below must read the same materialised partitions: the
    # checkpoint pins the chunk ids (and survives executor loss).
    ranged = (df.repartitionByRange(n, *_cols(keys), *_cols(order))
                .withColumn(_CHUNK, F.spark_partition_id())
                .checkpoint(eager=True))
    if keys:
        # A struct of the keys compares null fields as equal: one column
        # serves as a null-safe join key.
        ranged = ranged.withColumn(_KEY, F.struct(*keys))
    group = [_KEY] if keys else []            # no keys: one group, all chunks
    within_c = [f"{_WITHIN}{i}" for i in range(len(values))]
    total_c = [f"{_TOTAL}{i}" for i in range(len(values))]
    offset_c = [f"{_OFFSET}{i}" for i in range(len(values))]
    own_c = [f"_rk_own{i}" for i in range(len(sums))]       # sum over the key in the chunk
    key_c = [f"_rk_whole{i}" for i in range(len(sums))]     # sum over all chunks of an edge key

    whole_chunk = Window.partitionBy(*group, _CHUNK)
    in_chunk = (Window.partitionBy(*group, _CHUNK).orderBy(*_cols(order))
                .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    within = ranged.withColumns({w: F.sum(v).over(in_chunk) for v, w in zip(values, within_c)}
                                | {o: F.sum(v).over(whole_chunk) for v, o in zip(values, own_c)})

    # Range chunks hold contiguous key ranges, so a key reaches into
    # another chunk only if it is the first or last key of its chunk:
    # at most 2n + 1 such keys and at most 3n + 1 (key, chunk) pairs.
    # Only those pairs need an offset; both tables are broadcast.  Without
    # keys every chunk needs one: n rows, ordered in one small window.
    edge_rows = ranged.join(F.broadcast(_edge_keys(ranged, keys)), _KEY) if keys else ranged
    earlier = (Window.partitionBy(*group).orderBy(_CHUNK)
               .rowsBetween(Window.unboundedPreceding, -1))
    offsets = (edge_rows.groupBy(*group, _CHUNK)
                        .agg(*[F.sum(v).alias(t) for v, t in zip(values, total_c)])
                        .select(*group, _CHUNK,
                                *[F.sum(t).over(earlier).alias(o) for t, o in zip(total_c, offset_c)],
                                *[F.sum(t).over(Window.partitionBy(*group)).alias(k)
                                  for t, k in zip(total_c, key_c)]))

    def total(w: str, o: str) -> Column:
        return (F.when(F.col(w).isNull() & F.col(o).isNull(), F.lit(None))
                 .otherwise(F.coalesce(F.col(w), F.lit(0)) + F.coalesce(F.col(o), F.lit(0)))
                 .cast(within.schema[w].dataType))

    return (within.join(F.broadcast(offsets), [*group, _CHUNK], "left")
                  .withColumns({out: total(w, o) for out, w, o in zip(outs, within_c, offset_c)}
                               | {s: F.coalesce(k, o) for s, k, o in zip(sums, key_c, own_c)})
                  .drop(*group, _CHUNK, *within_c, *offset_c, *own_c, *key_c))


def exact_median(df: DataFrame, keys: Sequence[str], value: str, out: str,
                 chunks: int | None = None, split: bool | int | None = None,
                 also: Sequence[Column] = ()) -> DataFrame:
    """Exact median of ``value`` per group (mean of the two middle values
    for an even count; null for a group without values), one row per
    group, with further aggregates ``also``.

    ``median``/``percentile`` keep every distinct value of a group in one
    aggregation buffer.  Here equal values are first counted (combined
    map-side), a cumulative count per group is taken with
    :func:`running_sum`, and the one or two rows covering the middle
    positions are picked out."""
    keys = list(keys)
    if split is None:
        # A group's distinct values are at most its rows: a group that is
        # not hot in the input is not hot in the value counts either.
        split = split_chunks(df.where(F.col(value).isNotNull()), keys)
    counts = (df.where(F.col(value).isNotNull())
                .groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_rk_n")))
    cum = running_sum(counts, keys, [value], "_rk_n", "_rk_cum", chunks, split, "_rk_size")

    lo = F.floor((F.col("_rk_size") + 1) / 2)          # 1-based middle positions
    hi = F.ceil((F.col("_rk_size") + 1) / 2)
    start = F.col("_rk_cum") - F.col("_rk_n")           # rows before this value
    covers_lo = (start < lo) & (lo <= F.col("_rk_cum"))
    covers_hi = (start < hi) & (hi <= F.col("_rk_cum"))

    picked = (cum.where(covers_lo | covers_hi)
                 .groupBy(F.struct(*keys).alias(_KEY))
                 .agg(((F.max(F.when(covers_lo, F.col(value).cast("double"))) +
                        F.max(F.when(covers_hi, F.col(value).cast("double")))) / 2)
                      .alias(out)))
    groups = df.groupBy(*keys).agg(*(also or [F.count(value).alias("_rk_count")]))
    return (groups.withColumn(_KEY, F.struct(*keys))      # one row per group on both sides
                  .join(picked, _KEY, "left")
                  .drop(_KEY, "_rk_count"))


def rank_within(df: DataFrame, keys: Sequence[str], value: str, descending: bool = True,
                chunks: int | None = None, split: bool | int | None = None,
                rank: str = "rank", dense_rank: str = "dense_rank",
                percent_rank: str = "percent_rank", cume_dist: str = "cume_dist") -> DataFrame:
    """``rank``, ``dense_rank``, ``percent_rank`` and ``cume_dist`` over
    ``PARTITION BY keys ORDER BY value [DESC]`` (nulls last when
    descending, first when ascending, as in Spark), added to every row of
    ``df``.

    The built-in ranking windows run unless some group is too large for one
    task.  Then equal values are counted first (combined map-side); running
    sums of those counts (rows, and distinct values) give each value's
    rank, split across tasks as in :func:`running_sum`; the ranks are joined
    back on ``(keys, value)``."""
    keys = list(keys)
    v = F.col(value).desc() if descending else F.col(value).asc()
    if split is None:
        split = split_chunks(df, keys)
    if not split:
        w = Window.partitionBy(*keys).orderBy(v)
        return df.withColumns({rank: F.rank().over(w).cast("bigint"),
                               dense_rank: F.dense_rank().over(w).cast("bigint"),
                               percent_rank: F.percent_rank().over(w),
                               cume_dist: F.cume_dist().over(w)})
    counts = (df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_rk_n"))
                .withColumn("_rk_one", F.lit(1).cast("bigint")))
    cum = running_sum(counts, keys, [v], ["_rk_n", "_rk_one"], ["_rk_cum", "_rk_dense"],
                      chunks, split, "_rk_size")
    size = F.col("_rk_size")
    pos = F.col("_rk_cum") - F.col("_rk_n") + 1
    ranked = cum.select(F.struct(F.struct(*keys).alias(_KEY), value).alias("_rk_kv"),
                        pos.alias(rank),
                        F.col("_rk_dense").alias(dense_rank),
                        F.when(size > 1, (pos - 1) / (size - 1)).otherwise(F.lit(0.0))
                         .alias(percent_rank),
                        (F.col("_rk_cum") / size).alias(cume_dist))
    return (df.withColumn("_rk_kv", F.struct(F.struct(*keys).alias(_KEY), F.col(value)))
              .join(ranked, "_rk_kv")
              .drop("_rk_kv"))


def ntile_within(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                 buckets: int, out: str = "ntile", chunks: int | None = None,
                 split: bool | int | None = None) -> DataFrame:
    """``ntile(buckets) OVER (PARTITION BY keys ORDER BY order)``: the
    first ``size % buckets`` buckets get one row more.  ``order`` must be
    a total order within a key.  The built-in window runs unless some group
    is too large for one task; then the row number is a running count and
    the size its total (:func:`running_sum`)."""
    if buckets < 1:
        raise ValueError("buckets must be positive")
    keys = list(keys)
    if split is None:
        split = split_chunks(df, keys)
    if not split:
        w = Window.partitionBy(*keys).orderBy(*_cols(order))
        return df.withColumn(out, F.ntile(buckets).over(w).cast("bigint"))
    numbered = running_sum(df.withColumn("_rk_one", F.lit(1).cast("bigint")), keys, order,
                           "_rk_one", "_rk_row", chunks, split, "_rk_size")
    row, size = F.col("_rk_row"), F.col("_rk_size")
    small = F.floor(size / buckets)                   # rows in the later buckets
    extra = size % buckets                            # buckets with one row more
    in_big = extra * (small + 1)                      # rows in those buckets
    tile = F.when(row <= in_big, F.floor((row - 1) / (small + 1)) + 1) \
            .otherwise(extra + F.floor((row - in_big - 1) / small) + 1)
    return numbered.withColumn(out, tile.cast("bigint")).drop("_rk_one", "_rk_row", "_rk_size")
