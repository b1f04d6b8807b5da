"""Finding hot keys exactly, at any size.

1. ``count()`` -- on a Parquet scan this reads only footers.  A table
   of at most ``max_rows`` rows has no hot key; one of at most
   ``SAMPLE_ROWS`` rows is counted per key exactly, in one pass.
2. A uniform sample (about ``SAMPLE_ROWS`` rows, or as many as make a hot
   key show ``SAMPLED_OF_A_HOT_KEY`` times) is counted per key (an ordinary
   distributed aggregate).  Every key seen at least half as often as a key
   at the bound is expected is a candidate: about ``2 * total / max_rows``
   at most, so they are broadcast.
3. One pass counts the candidates exactly; only keys above the bound are
   returned.

The answer only chooses between two plans that give the same result, so
a borderline key missed by the sample costs time, never correctness; a
key far above its share (the case that matters) cannot be missed.
Nothing here merges per-task state in one task (``freqItems`` would).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

_HK = "_hot_key"
# One task windows or sorts this many rows of a single key without
# trouble (spilling if it must).  The limit is absolute: a key is split
# above it however large the table and however many tasks there are.
TASK_ROWS = 10_000_000
SAMPLE_ROWS = 10_000_000
SAMPLED_OF_A_HOT_KEY = 100
SEED = 20240917


def split_chunks(df: DataFrame, keys: Sequence[str]) -> int:
    """0 if no key of ``df`` holds more rows than one task should, else
    the number of chunks to split into: enough that none holds more, and
    at least one per shuffle partition."""
    if not hot_keys(df, keys):
        return 0
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(parts, 2 * -(-df.count() // max(1, TASK_ROWS)) if TASK_ROWS else 2 * parts)


def hot_keys(df: DataFrame, keys: Sequence[str], max_rows: int | None = None) -> list[Row]:
    """The keys (as Rows of the key columns) with more than ``max_rows``
    rows (default ``TASK_ROWS``)."""
    keys = list(keys)
    bound = TASK_ROWS if max_rows is None else max_rows
    total = df.count()
    if total <= bound:
        return []
    if not keys:                       # one group holding every row
        return [Row()]
    fraction = min(1.0, max(SAMPLE_ROWS / total, SAMPLED_OF_A_HOT_KEY / max(1, bound)))
    key = F.struct(*keys).alias(_HK)
    if fraction >= 1.0:
        # small enough to count every key exactly in one pass
        return [r[_HK] for r in (df.select(key).groupBy(_HK)
                                   .agg(F.count(F.lit(1)).alias("n"))
                                   .where(F.col("n") > bound).collect())]
    cutoff = max(1, int(bound * fraction / 2))
    candidates = (df.sample(fraction=fraction, seed=SEED).select(key)
                    .groupBy(_HK).agg(F.count(F.lit(1)).alias("n"))
                    .where(F.col("n") >= cutoff).select(_HK))
    # at most about 2 * total / bound candidates: a bound for the broadcast
    counted = (df.select(key).join(F.broadcast(candidates), _HK)
                 .groupBy(_HK).agg(F.count(F.lit(1)).alias("n"))
                 .where(F.col("n") > bound)
                 .collect())                      # at most total / bound rows
    return [r[_HK] for r in counted]
