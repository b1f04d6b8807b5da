"""Ordered patterns over rows in time (funnels): after a row of the first
kind the next one of the second kind, after that the next of the third,
and so on.

``next(kind k+1)`` of every row is a value carried back from later rows,
so a pattern of n steps takes n - 1 passes of
:func:`relkit.operators.timeline.carry_last` over one order of the rows
taken backwards: one shuffle and one sort in the plain form.  A row of a
step carries what it found itself, so the chain needs no join of rows with
rows, and the output is one row per start.  Taking the earliest row at
every step is also the earliest way to finish, so a pattern that can
finish within a time does.  Keys with more rows than one task should hold
are split into range chunks (:mod:`relkit.plans.skew`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relkit.operators.timeline import _any_null, carry_last, micros
from relkit.plans.skew import split_chunks
from relkit.sources import Tables

HOUR_MICROS = 3_600_000_000


def ordered_pattern(df: DataFrame, keys: Sequence[str], time: str, tie: str, kind: str, steps: Sequence[str],
                    within: int, split: bool | int | None = None) -> DataFrame:
    """One row per row of kind ``steps[0]``: the keys, ``tie``, ``time``,
    then ``step_k_<tie>`` and ``step_k_<time>`` of every later step
    (k from 2) reached at most ``within`` microseconds after the start, and
    ``n_steps``, how many were reached.  Rows are in the order of
    (``time``, ``tie``), which should be total.  Of two rows at one time
    the one with the larger ``tie`` is later.

    Rows with a null key, time or tie are no steps; as starts they reach
    only themselves.  Rows of no kind or of another kind take no part.
    Neighbouring steps must be of different kinds."""
    keys, steps = list(keys), list(steps)
    if len(steps) < 2 or any(a == b for a, b in zip(steps, steps[1:])):
        raise ValueError("a pattern has two steps or more, neighbours of different kinds")
    own = df.select(*keys, tie, time, kind).where(F.col(kind).isin(steps))
    fit = ~_any_null([*keys, time, tie])
    rows = own.where(fit).withColumns({"_rk_at": -micros(time), "_rk_tie": -F.col(tie).cast("decimal(38,0)")})
    if split is None:
        split = split_chunks(df.select(*keys), keys)
    found = None                       # what a row of the step after this one carries
    for k in range(len(steps) - 1, 0, -1):
        fields = [F.col(tie).alias("id"), F.col(time).alias("ts"), F.col("_rk_at").alias("at")]
        if found is not None:
            fields.append(F.col(found).alias("next"))
        rows = rows.withColumn("_rk_step", F.when(F.col(kind) == steps[k], F.struct(*fields)))
        rows = carry_last(rows, keys, ["_rk_at", "_rk_tie"], "_rk_step", f"_rk_next{k}", split).drop("_rk_step")
        rows = rows.drop(found) if found else rows
        found = f"_rk_next{k}"
    starts = rows.where(F.col(kind) == steps[0])
    reached, columns, node = F.lit(1), [], F.col(found)
    for k in range(2, len(steps) + 1):
        # times are negative: the later, the smaller
        inside = F.coalesce(F.col("_rk_at") - node["at"] <= within, F.lit(False))
        columns += [F.when(inside, node["id"]).alias(f"step_{k}_{tie}"), F.when(inside, node["ts"]).alias(f"step_{k}_{time}")]
        reached = reached + inside.cast("int")
        node = node["next"] if k < len(steps) else node
    got = starts.select(*keys, tie, time, *columns, reached.alias("n_steps"))
    lost = own.where(~fit & (F.col(kind) == steps[0]))
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in got.schema.fields[len(keys) + 2:-1]]
    return got.unionByName(lost.select(*keys, tie, time, *empty, F.lit(1).alias("n_steps")))


def funnel(t: Tables, steps: Sequence[str] = ("view", "click", "purchase"), hours: int = 72,
           split: bool | int | None = None) -> DataFrame:
    """Every view with the user's next click and the next purchase after
    that click, as far as they come within 72 hours of the view."""
    return ordered_pattern(t.events, ["user_id"], "ts", "event_id", "event_type", steps, hours * HOUR_MICROS, split)
