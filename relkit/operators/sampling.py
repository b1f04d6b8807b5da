"""Seeded samples of exact size per stratum.

Every row gets a place, the MD5 of the seed and its identifying columns;
a stratum's sample is its ``size`` rows of the smallest places.  Reruns,
other partitionings and retried tasks choose the same rows.

No window runs over the raw rows.  A first pass counts rows per stratum
and cell, the first 16 bits of the place (at most 65,536 counts a
stratum, combined map-side), and a running count names the cell in which a
stratum's sample ends.  A second pass takes the rows of the cells before
it where they lie; only the rows of that one cell, about one in 65,536,
are ordered.  Equal rows are counted first there, so that copies of one
row, however many, are one row in that order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relkit.plans.strategies import broadcast_if_few
from relkit.sources import Tables

_PLACE, _CELL, _END, _LEFT = "_rk_place", "_rk_cell", "_rk_end", "_rk_left"


def stratified_sample(df: DataFrame, strata: Sequence[str], identity: Sequence[str], size: Column | int,
                      seed: int = 0) -> DataFrame:
    """``size`` rows of every stratum, all of a smaller one.  ``size`` is a
    number or a column of ``n_rows``, the stratum's number of rows (for
    example ``F.ceil(F.col("n_rows") / 100)``); null or below 0 means none.

    ``identity``: whole-number or string columns that tell rows apart
    (null is a value of its own).  Rows equal in them are ordered by all
    columns, and of equal rows as many are taken as fit.  A null stratum
    is a stratum.  All columns must be orderable."""
    strata, columns = list(strata), df.columns
    if clash := {c for c in columns if c.startswith("_rk_")}:
        raise ValueError(f"reserved column names: {sorted(clash)}")
    named = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in identity]
    placed = df.withColumn(_PLACE, F.md5(F.concat_ws("|", F.lit(str(seed)), *named))) \
               .withColumn(_CELL, F.conv(F.substring(_PLACE, 1, 4), 16, 10).cast("int"))
    counted = placed.groupBy(*strata, _CELL).agg(F.count(F.lit(1)).alias("_rk_n"))
    own = Window.partitionBy(*strata)
    wanted = F.coalesce(F.greatest(F.lit(size) if isinstance(size, int) else size, F.lit(0)), F.lit(0)).cast("bigint")
    upto = (counted.withColumn("n_rows", F.sum("_rk_n").over(own))
                   .withColumn("_rk_upto", F.sum("_rk_n").over(own.orderBy(_CELL).rowsBetween(Window.unboundedPreceding, 0)))
                   .withColumn("_rk_size", wanted))
    # The first cell that does not fit whole, and the rows still wanted there.
    over = F.col("_rk_upto") > F.col("_rk_size")
    ends = upto.groupBy(*strata).agg(
        F.min(F.when(over, F.struct(F.col(_CELL).alias("c"), (F.col("_rk_size") - F.col("_rk_upto") + F.col("_rk_n")).alias("n"))))
         .alias("e")).select(*[F.col(c).alias(f"_rk_s{i}") for i, c in enumerate(strata)],
                             F.col("e.c").alias(_END), F.col("e.n").alias(_LEFT))
    same = F.lit(True)
    for i, c in enumerate(strata):
        same = same & F.col(c).eqNullSafe(F.col(f"_rk_s{i}"))
    judged = placed.join(broadcast_if_few(ends), same)
    whole = judged.where(F.col(_END).isNull() | (F.col(_CELL) < F.col(_END))).select(*columns)
    last = (judged.where((F.col(_CELL) == F.col(_END)) & (F.col(_LEFT) > 0))
                  .groupBy(_PLACE, _LEFT, *columns).agg(F.count(F.lit(1)).alias("_rk_n")))
    before = F.sum("_rk_n").over(own.orderBy(_PLACE, *columns).rowsBetween(Window.unboundedPreceding, 0)) - F.col("_rk_n")
    part = (last.withColumn("_rk_take", F.least(F.col("_rk_n"), F.col(_LEFT) - before)).where("_rk_take > 0")
                .withColumn("_rk_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_rk_take")))))
    return whole.unionByName(part.select(*columns))


def order_sample(t: Tables, size: int = 100, seed: int = 7) -> DataFrame:
    """100 orders of every priority."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderpriority")
    return stratified_sample(o, ["o_orderpriority"], ["o_orderkey", "o_custkey"], size, seed)
