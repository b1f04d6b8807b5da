"""Operators over time: as-of join, trailing windows, intervals by sweep
line, sessions.

Each has a plain form and a split form, which is taken when a key holds
more rows than one task should (:func:`relkit.plans.skew.split_chunks`).
Both give the same rows:

* ``carry_last`` -- the last value so far.  Split: the rows are cut into
  range chunks by (key, order); each chunk carries its own values, and the
  value that enters a chunk is carried over the chunk edges, a table of at
  most three rows per chunk.
* ``as_of_join`` -- the union of both sides in one order, and
  ``carry_last`` over it: one sort, no join of rows with rows, so nothing
  grows with a key's rows times its partners.
* ``trailing_sums`` -- range-frame windows.  Split: time is cut into steps
  as long as the frame; a row is copied into the next step as its halo,
  so every step of a key is a group of its own and rows double at most.
* ``concurrent`` -- open intervals at every instant they change: boundary
  events summed per instant, then a running sum (:mod:`relkit.operators.scan`).
* ``sessions`` -- a key's rows with gaps below a bound, by
  ``session_window``.  Split: the previous instant is carried, gaps start
  sessions, a running count names them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relkit.operators.scan import running_sum
from relkit.plans.skew import split_chunks
from relkit.session import ensure_checkpoint_dir

_CHUNK, _KEY, _ROW = "_rk_chunk", "_rk_key", "_rk_row"


def micros(ts: str | Column) -> Column:
    """A timestamp without zone as microseconds, for range arithmetic.  A
    difference of clock readings: no session zone takes part."""
    since = (F.col(ts) if isinstance(ts, str) else ts) - F.lit("1970-01-01").cast("timestamp_ntz")
    part = lambda unit: F.extract(F.lit(unit), since).cast("bigint")
    seconds = F.extract(F.lit("SECOND"), since) * 1_000_000
    return ((part("DAY") * 24 + part("HOUR")) * 60 + part("MINUTE")) * 60_000_000 + seconds.cast("bigint")


def _chunks(df: DataFrame, keys: list[str], order: list[str], split: bool | int) -> DataFrame:
    """``df`` in range chunks by (key, order), with the chunk and the key as
    a struct (null keys compare as equal).  The checkpoint pins the chunks:
    whatever is made of them must see the same ones."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions")) if split is True else int(split)
    return (df.repartitionByRange(n, *keys, *order).withColumn(_CHUNK, F.spark_partition_id())
              .withColumn(_KEY, F.struct(*keys)).checkpoint(eager=True))


def _entering(chunks: DataFrame, last: Column) -> DataFrame:
    """_KEY, _CHUNK, _rk_enter: the ``last`` (an aggregate) of a key in the
    chunks before.  Only the first and the last key of a chunk reach over
    its edges: at most three rows per chunk, for a broadcast."""
    edges = chunks.groupBy(_CHUNK).agg(F.min(_KEY).alias("lo"), F.max(_KEY).alias("hi"))
    keys = edges.select(F.explode(F.array("lo", "hi")).alias(_KEY)).distinct()
    earlier = Window.partitionBy(_KEY).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    return (chunks.join(F.broadcast(keys), _KEY).groupBy(_KEY, _CHUNK).agg(last.alias("last"))
                  .select(_KEY, _CHUNK, F.last("last", ignorenulls=True).over(earlier).alias("_rk_enter")))


def carry_last(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str,
               split: bool | int | None = None) -> DataFrame:
    """``last_value(value IGNORE NULLS) OVER (PARTITION BY keys ORDER BY
    order ROWS UNBOUNDED PRECEDING)``.  ``order`` columns are a total order
    within a key, but for rows without a value; ``value`` may be a struct."""
    keys, order = list(keys), list(order)
    if split is None:
        split = split_chunks(df, keys)
    upto = (Window.unboundedPreceding, Window.currentRow)
    if not split:
        return df.withColumn(out, F.last(value, ignorenulls=True).over(
            Window.partitionBy(*keys).orderBy(*order).rowsBetween(*upto)))
    chunks = _chunks(df, keys, order, split)
    inside = chunks.withColumn("_rk_in", F.last(value, ignorenulls=True).over(
        Window.partitionBy(_KEY, _CHUNK).orderBy(*order).rowsBetween(*upto)))
    last = F.max(F.when(F.col(value).isNotNull(), F.struct(F.struct(*order).alias("o"), F.col(value).alias("v"))))["v"]
    return (inside.join(F.broadcast(_entering(chunks, last)), [_KEY, _CHUNK], "left")
                  .withColumn(out, F.coalesce("_rk_in", "_rk_enter")).drop(_KEY, _CHUNK, "_rk_in", "_rk_enter"))


def previous(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str, split: bool | int) -> DataFrame:
    """``lag(value) OVER (PARTITION BY keys ORDER BY order)`` over range
    chunks, for a value without nulls that does not fall in the order (the
    instant itself): the last of a chunk is then its largest."""
    keys, order = list(keys), list(order)
    if not split:
        return df.withColumn(out, F.lag(value).over(Window.partitionBy(*keys).orderBy(*order)))
    chunks = _chunks(df, keys, order, split)
    inside = chunks.withColumn("_rk_in", F.lag(value).over(Window.partitionBy(_KEY, _CHUNK).orderBy(*order)))
    return (inside.join(F.broadcast(_entering(chunks, F.max(value))), [_KEY, _CHUNK], "left")
                  .withColumn(out, F.coalesce("_rk_in", "_rk_enter")).drop(_KEY, _CHUNK, "_rk_in", "_rk_enter"))


def _any_null(names: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in names])


def as_of_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str,
               tie: str, columns: Sequence[str], split: bool | int | None = None) -> DataFrame:
    """``left`` with ``columns`` of the latest ``right`` row of its key at
    or before its time; of rows of one time, the one with the largest
    ``tie``.  Left rows without such a row, or with a null key or time, get
    nulls; right rows with a null key, time or tie match nothing."""
    keys, columns = list(keys), list(columns)
    clash = set(left.columns) & set(columns)
    if clash:
        raise ValueError(f"column names on both sides: {sorted(clash)}")
    lost = left.where(_any_null([*keys, left_time]))
    found = F.struct(*columns)
    rows = left.where(~_any_null([*keys, left_time])).select(
        *keys, F.col(left_time).alias("_rk_time"), F.lit(1).alias("_rk_side"),
        F.lit(None).cast(right.schema[tie].dataType).alias("_rk_tie"),
        F.lit(None).cast(right.select(found.alias("s")).schema["s"].dataType).alias("_rk_found"),
        F.struct(*left.columns).alias(_ROW))
    marks = right.where(~_any_null([*keys, right_time, tie])).select(
        *keys, F.col(right_time).alias("_rk_time"), F.lit(0).alias("_rk_side"), F.col(tie).alias("_rk_tie"),
        found.alias("_rk_found"), F.lit(None).cast(rows.schema[_ROW].dataType).alias(_ROW))
    # Left rows of one key and time stand after all marks of that time, so
    # they carry the same value in any order.
    got = carry_last(rows.unionByName(marks), keys, ["_rk_time", "_rk_side", "_rk_tie"], "_rk_found", "_rk_value", split)
    matched = got.where("_rk_side = 1").select(f"{_ROW}.*", *[F.col("_rk_value").getField(c).alias(c) for c in columns])
    nulls = [F.lit(None).cast(right.schema[c].dataType).alias(c) for c in columns]
    return matched.unionByName(lost.select("*", *nulls))


def trailing_sums(df: DataFrame, keys: Sequence[str], at: str, length: int, sums: dict[str, Column],
                  split: bool | int | None = None) -> DataFrame:
    """``sum(...) OVER (PARTITION BY keys ORDER BY at RANGE BETWEEN length
    PRECEDING AND CURRENT ROW)`` for a whole-number column ``at``, added to
    every row as the columns named by ``sums``.  Rows with a null ``at``
    have each other as their frame, as in the plain window.  The split form
    puts the rows of two frames' length of a key into one group."""
    keys = list(keys)
    if split is None:
        split = split_chunks(df, keys)
    frame = lambda *by: Window.partitionBy(*by).orderBy(at).rangeBetween(-length, 0)
    if not split:
        return df.withColumns({o: F.sum(c).over(frame(*keys)) for o, c in sums.items()})
    step = F.floor(F.col(at) / F.lit(length))
    copy = lambda s, own: F.struct(s.cast("bigint").alias("step"), F.lit(own).alias("own"))
    copies = F.when(F.col(at).isNull(), F.array(copy(F.lit(None), True))).otherwise(F.array(copy(step, True), copy(step + 1, False)))
    both = df.withColumn("_rk_halo", F.explode(copies)).withColumn("_rk_step", F.col("_rk_halo.step"))
    got = both.withColumns({o: F.sum(c).over(frame(*keys, "_rk_step")) for o, c in sums.items()})
    return got.where("_rk_halo.own").drop("_rk_halo", "_rk_step")


def concurrent(df: DataFrame, start: str, end: str, keys: Sequence[str] = (), split: bool | int | None = None) -> DataFrame:
    """Per key, every instant at which an interval [start, end) starts or
    ends: ``instant``, ``n_started``, ``n_ended`` and ``n_open`` (open from that
    instant on).  At most two rows per interval, combined per instant
    map-side.  An interval with a null end stays open; one with a null
    start, or that ends at or before its start, is never open."""
    keys = list(keys)
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    ever = df.where(F.col(start).isNotNull() & (F.col(end).isNull() | (F.col(end) > F.col(start))))
    bounds = (ever.select(*keys, F.col(start).alias("instant"), one.alias("s"), none.alias("e"))
                  .unionByName(ever.where(F.col(end).isNotNull()).select(*keys, F.col(end).alias("instant"), none.alias("s"), one.alias("e"))))
    per_instant = (bounds.groupBy(*keys, "instant").agg(F.sum("s").alias("n_started"), F.sum("e").alias("n_ended"))
                         .withColumn("_rk_change", F.col("n_started") - F.col("n_ended")))
    if split is None:
        split = split_chunks(per_instant, keys)
    return running_sum(per_instant, keys, ["instant"], "_rk_change", "n_open", split=split).drop("_rk_change")


def sessions(df: DataFrame, keys: Sequence[str], at: str, gap_seconds: int, aggs: Sequence[Column],
             tie: str, split: bool | int | None = None) -> DataFrame:
    """One row per key and session: the keys, ``session_start`` and
    ``session_end`` (its first and last instant) and ``aggs``.  A row starts
    a session if no row of its key lies within the gap before it (at
    exactly the gap is within).  Rows with a null instant are in no
    session; a null key is a key.  ``tie`` makes the order of a key's rows
    total where the split form is used."""
    keys = list(keys)
    rows = df.where(F.col(at).isNotNull())
    ends = [F.min(at).alias("session_start"), F.max(at).alias("session_end")]
    if split is None:
        split = split_chunks(rows, keys)
    if not split:
        # A session window is over at the instant its length after a row.
        window = F.session_window(at, f"{gap_seconds} seconds 1 microsecond")
        return rows.groupBy(*keys, window.alias("_rk_window")).agg(*ends, *aggs).drop("_rk_window")
    order = ["_rk_time", tie]
    before = previous(rows.withColumn("_rk_time", micros(at)), keys, order, "_rk_time", "_rk_before", split)
    new = F.col("_rk_before").isNull() | (F.col("_rk_time") - F.col("_rk_before") > gap_seconds * 1_000_000)
    named = running_sum(before.withColumn("_rk_new", new.cast("bigint")), keys, order, "_rk_new", "_rk_session", split=split)
    return named.groupBy(*keys, "_rk_session").agg(*ends, *aggs).drop("_rk_session")
