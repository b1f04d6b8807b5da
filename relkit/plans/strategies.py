"""Join strategies chosen for scale.

Broadcasts: no query hints one on a table that grows with the data.
Catalyst broadcasts a side whose estimated size is under
``spark.sql.autoBroadcastJoinThreshold`` and plans a sort-merge join
otherwise; adaptive execution re-checks the real size of each shuffled
side at runtime and converts to a broadcast join only under
``spark.sql.adaptive.autoBroadcastJoinThreshold``.  Explicit hints are
used only where the size bound is structural (``operators.scan``,
``plans.skew``).

* ``left_outer_join`` -- a left outer join as inner join plus anti join
  against the *distinct* right keys, so a hot key on the right side can
  be split by adaptive skew handling (which cannot split the buffered
  side of an outer sort-merge join).
* ``right_outer_join`` -- the same with the sides mirrored.
* ``not_in`` -- ``a NOT IN (subquery)`` with its null rules, as an anti
  join against distinct keys plus one scalar aggregate.  Spark plans a
  single-column NOT IN as a null-aware anti join that broadcasts the
  subquery side whatever its size (even with size-based broadcasts
  off); here the anti join is an ordinary one that can sort-merge.
* ``band_join`` -- ``|a - b| <= width`` as an equi-join on buckets plus the exact predicate, instead of a nested-loop join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relkit.session import ensure_checkpoint_dir


def left_outer_join(left: DataFrame, right: DataFrame,
                    on: Sequence[tuple[str, str]]) -> DataFrame:
    """``left LEFT OUTER JOIN right ON left.l = right.r AND ...``.

    Same rows as Spark's left join (both key columns kept, right columns
    null for unmatched left rows).  Column names of the two sides must
    differ.

    Left rows with a null key can match nothing and are set aside first;
    the inner join and the anti join then read the same non-null left
    side, so Spark shuffles it once and reuses the exchange."""
    clash = set(left.columns) & set(right.columns)
    if clash:
        raise ValueError(f"column names on both sides: {sorted(clash)}")
    cond = None
    has_null = None
    for lk, rk in on:
        c = F.col(lk) == F.col(rk)
        cond = c if cond is None else cond & c
        n = F.col(lk).isNull()
        has_null = n if has_null is None else has_null | n
    keyed = left.where(~has_null)
    matched = keyed.join(right, cond, "inner")
    # Distinct keys: combined map-side, so no key is hot any more.
    right_keys = right.select(*[rk for _, rk in on]).distinct()
    unmatched = keyed.join(right_keys, cond, "left_anti").unionByName(left.where(has_null))
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields]
    return matched.unionByName(unmatched.select(*left.columns, *nulls))


def right_outer_join(left: DataFrame, right: DataFrame,
                     on: Sequence[tuple[str, str]]) -> DataFrame:
    """``left RIGHT OUTER JOIN right``: the mirrored left outer join,
    columns in ``left, right`` order."""
    mirrored = left_outer_join(right, left, [(rk, lk) for lk, rk in on])
    return mirrored.select(*left.columns, *right.columns)


def not_in(left: DataFrame, left_col: str, right: DataFrame, right_col: str) -> DataFrame:
    """Rows of ``left`` where ``left_col NOT IN (SELECT right_col FROM
    right)`` is true:

    * ``right`` empty: every row (a null ``left_col`` included);
    * otherwise: rows whose value is not null, not in ``right``, and only
      if ``right`` holds no null (a null makes the test unknown)."""
    if left_col == right_col:
        raise ValueError("give the two columns different names")
    stats = right.agg(F.struct(F.count(F.lit(1)).alias("n"),
                               F.count_if(F.col(right_col).isNull()).alias("nulls"))).scalar()
    keep = (stats.getField("n") == 0) | (
        F.col(left_col).isNotNull() & (stats.getField("nulls") == 0))
    keys = right.select(right_col).where(F.col(right_col).isNotNull()).distinct()
    return (left.join(keys, F.col(left_col) == F.col(right_col), "left_anti")
                .where(keep))


def band_join(left: DataFrame, right: DataFrame, left_col: str, right_col: str,
              width: float) -> DataFrame:
    """Pairs with ``|left_col - right_col| <= width`` (inner join).

    ``left`` is bucketed by ``floor(x / size)`` with buckets half as long
    again as ``width``; each ``right`` row is copied into its bucket and
    the two next to it.  Values within ``width`` of each other are then
    less than one bucket apart, with room for the rounding of the
    differences and quotients, so no pair at a bucket's edge is lost.  Put
    the smaller table on the right; the exact predicate removes the
    candidates that are too far apart."""
    if width <= 0:
        raise ValueError("width must be positive")
    band = "_band"
    size = 1.5 * width
    l = left.withColumn(band, F.floor(F.col(left_col) / F.lit(size)))
    base = F.floor(F.col(right_col) / F.lit(size))
    # floor() clamps huge and infinite values to the ends of bigint; the
    # neighbours are then out of range (null) and skipped, while equal
    # clamped buckets still meet.  The exact predicate decides in the end
    # (NaN and infinities never satisfy it).
    one = F.lit(1).cast("bigint")
    neighbours = F.array(F.try_subtract(base, one), base, F.try_add(base, one))
    r = (right.withColumn(band, F.explode(neighbours))
              .where(F.col(band).isNotNull()))
    return (l.join(r, band)
             .where(F.abs(F.col(left_col) - F.col(right_col)) <= F.lit(width))
             .drop(band))


BROADCAST_ROWS = 10_000


def broadcast_if_few(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``rows`` rows, else as
    it is, for an ordinary join.  For aggregates, which have to be finished
    to be counted: the result is written to the checkpoint folder first, so
    they are computed once."""
    ensure_checkpoint_dir(df.sparkSession)
    done = df.checkpoint(eager=True)
    return F.broadcast(done) if done.count() <= rows else done
