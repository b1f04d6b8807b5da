"""Mixing sources to target weights as a min-cost flow.

A document may belong to several sources.  Documents are aggregated by
membership pattern (the set of their sources), so the flow network has a
node per pattern, not per document: pattern -> its sources -> quotas.
Taking a pattern's words once costs nothing, every further time costs one
more (convex), up to ``copies`` times.  Blocking flows, cost level by cost
level, give the flow that fills the quotas at the least repetition.  The
network falls into components of sources that share documents; each is
solved in a task of its own (a table with one source per document has a
component per source).  The flow is then turned into documents: all
documents of a pattern are taken as many whole times as the flow covers,
and the rest is filled in the order of a seeded hash; the one document at
the boundary is taken in part, so a pattern's words come out exactly.

The order of the hash is cut by a cumulative histogram of its first
digits, then of the next ones within the one bucket that holds the cut,
and only the documents of that last bucket are put in order.  No source is
gathered in one task.

Memory of a task: the memberships of one component (patterns, not
documents).

Defined results: a null text has size 0 and is never taken; a null source
is a source of its own, ordered last; an empty set of sources takes part
in no source and is not taken.  Rows that repeat an id are documents of
their own.  An empty table gives an empty result.  Other columns are
ignored.
"""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass
from fractions import Fraction

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from relkit.llm.common import pinned
from relkit.llm.components import components
from relkit.operators.scan import running_sum

WEIGHTS = (5, 2, 1)
SHARE = Fraction(3, 2)
COPIES = 2
SEED = "mix-1"
BROADCAST_ROWS = 10_000
_DIGITS = 3                     # hexadecimal digits of one histogram


@dataclass
class Mix:
    """documents: the id column, members, size, taken (words, repeats
    counted); targets: source, weight, source_size, target."""
    documents: DataFrame
    targets: DataFrame


def words(text: Column) -> Column:
    """Number of runs of characters that are not white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def _targets(patterns: DataFrame, weights: tuple[int, ...], share: Fraction, copies: int) -> DataFrame:
    """Quota of each source: ``share`` of all words by weight, at most
    ``copies`` times the source, the excess reshared by weight."""
    total = patterns.agg(F.sum("words")).first()[0] or 0
    sources = (patterns.select(F.explode("members").alias("source"), "words")
                       .groupBy("source").agg(F.sum("words").alias("source_size"))
                       .withColumn("one", F.lit(1).cast("bigint")))
    ranked = running_sum(sources, [], [F.col("source").asc_nulls_last()], "one", "rank")
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]),
                          ((F.col("rank") - 1) % len(weights) + 1).cast("int")).cast("bigint")
    ranked = pinned(ranked.select("source", "source_size", weight.alias("weight")))
    full = F.lit(False)
    n_full, num, den = -1, 0, 1
    while True:
        row = ranked.agg(F.count(F.when(full, 1)).alias("n"),
                         F.coalesce(F.sum(F.when(full, F.col("source_size"))), F.lit(0)).alias("size"),
                         F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)).alias("weight")).first()
        if row.n == n_full or not row.weight:
            break
        n_full = row.n
        # the level: words per unit of weight, as a ratio of whole numbers
        num = share.numerator * total - share.denominator * copies * row["size"]
        den = share.denominator * row.weight
        full = F.col("source_size") * F.lit(copies) * F.lit(den) < F.col("weight") * F.lit(num)
    level = (F.col("weight") * F.lit(num)).cast("double") / F.lit(float(den))
    return ranked.withColumn("target", F.when(full, (F.col("source_size") * F.lit(copies)).cast("double"))
                                        .otherwise(level))


def route(capacity: dict, quota: dict, copies: int) -> dict:
    """Words taken from each pattern (a tuple of sources) by the flow that
    fills the quotas as far as possible at the least cost, where the k-th
    time a pattern is taken costs k - 1.  Cheaper levels are exhausted
    first; later augmentations reroute but never return what is taken.  In
    a level, layers of nodes by distance from the patterns with words to
    spare admit many paths at once, found by walks that never enter a dead
    end twice."""
    patterns, sources = list(capacity), {s: i for i, s in enumerate(quota)}
    arcs = [[sources[s] for s in p] for p in patterns]
    flow = [dict.fromkeys(a, 0) for a in arcs]
    back: list[dict[int, None]] = [{} for _ in sources]          # patterns that send words to a source
    left = list(quota.values())
    for _ in range(copies):
        spare = [capacity[p] for p in patterns]
        while True:
            layer_p, layer_s = {p: 0 for p, w in enumerate(spare) if w > 0}, {}
            queue, reached = deque(layer_p), False
            while queue and not reached:
                p = queue.popleft()
                for s in arcs[p]:
                    if s in layer_s:
                        continue
                    layer_s[s] = layer_p[p] + 1
                    reached = reached or left[s] > 0
                    for q in back[s]:
                        if q not in layer_p:
                            layer_p[q] = layer_s[s] + 1
                            queue.append(q)
            if not reached:
                break
            steps_p = {p: iter(arcs[p]) for p in layer_p}
            steps_s = {s: iter(list(back[s])) for s in layer_s}
            for begin in [p for p, d in layer_p.items() if d == 0]:
                path = [begin]                                   # pattern, source, pattern, ...
                while path and spare[begin] > 0:
                    node, at_source = path[-1], len(path) % 2 == 0
                    if at_source and left[node] > 0:
                        amount = min(spare[begin], left[node], *[flow[q][s] for s, q in zip(path[1:-1:2], path[2::2])])
                        spare[begin] -= amount
                        left[node] -= amount
                        for p, s in zip(path[::2], path[1::2]):
                            flow[p][s] += amount
                            back[s][p] = None
                        for s, p in zip(path[1:-1:2], path[2::2]):
                            flow[p][s] -= amount
                            if not flow[p][s]:
                                del back[s][p]
                        path = [begin]
                        continue
                    if at_source:
                        ahead = next((q for q in steps_s[node] if layer_p.get(q) == layer_s[node] + 1 and flow[q][node] > 0), None)
                    else:
                        ahead = next((s for s in steps_p[node] if layer_s.get(s) == layer_p[node] + 1
                                      and (left[s] > 0 or s in steps_s)), None)
                    if ahead is not None:
                        path.append(ahead)
                        continue
                    path.pop()                                   # a dead end: its steps are used up
                    (steps_s if at_source else steps_p)[node] = iter(())
                    if at_source:
                        layer_s[node] = -1
                    else:
                        layer_p[node] = -1
    return {p: sum(f.values()) for p, f in zip(patterns, flow)}


def _routed(copies: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        """pattern and amount of a component of memberships."""
        members = rows.sort_values(["pattern", "place"]).groupby("pattern", sort=True)["place"].agg(tuple)
        words = rows.groupby("pattern")["words"].first()
        # Two patterns never have the same sources.
        number = {m: p for p, m in members.items()}
        taken = route({m: int(words[p]) for p, m in members.items()},
                      {int(s): int(q) for s, q in zip(rows["place"], rows["quota"])}, copies)
        return pd.DataFrame({"pattern": [number[m] for m in taken], "amount": list(taken.values())})
    return run


def _amounts(patterns: DataFrame, targets: DataFrame, copies: int) -> DataFrame:
    """members, words and amount (words to take) of every pattern with a
    source."""
    numbered = pinned(patterns.where(F.size("members") > 0).withColumn("pattern", F.monotonically_increasing_id()))
    quota = pinned(targets.select(F.struct("source").alias("key"), F.floor(F.col("target") + 0.5).cast("bigint").alias("quota"))
                          .withColumn("place", F.monotonically_increasing_id()))
    each = pinned(numbered.select("pattern", "words", F.explode("members").alias("source"))
                          .withColumn("key", F.struct("source")).join(quota, "key").select("pattern", "words", "place", "quota"))
    # Patterns and sources are nodes of one graph: even and odd numbers.
    links = each.select((F.col("place") * 2).alias("a"), (F.col("pattern") * 2 + 1).alias("b"))
    roots = components(links).select((F.col("node") / 2).cast("bigint").alias("place"), "root").where("node % 2 = 0")
    taken = each.join(roots, "place").groupBy("root").applyInPandas(_routed(copies), "pattern bigint, amount bigint")
    return numbered.join(taken, "pattern").select("members", "words", "amount")


def _cut(docs: DataFrame, need: DataFrame, depth: int, hint) -> tuple[DataFrame, DataFrame]:
    """One histogram step.  docs: key, digits ahead in ``hash``; need: key,
    rest (words still to take).  Returns each key's bucket that holds the
    cut, with the rest to take inside it."""
    digits = F.substring("hash", depth * _DIGITS + 1, _DIGITS)
    sums = docs.groupBy("key", digits.alias("bucket")).agg(F.sum("size").alias("words"))
    before = (Window.partitionBy("key").orderBy("bucket")
              .rowsBetween(Window.unboundedPreceding, -1))
    cum = sums.join(hint(need), "key").withColumn("ahead", F.coalesce(F.sum("words").over(before), F.lit(0)))
    return (cum.where((F.col("ahead") < F.col("rest")) & (F.col("rest") <= F.col("ahead") + F.col("words")))
               .select("key", "bucket", (F.col("rest") - F.col("ahead")).alias("rest")))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, share: Fraction = SHARE, copies: int = COPIES,
        seed: str = SEED, carry: list[str] | None = None) -> Mix:
    """``source_col`` holds a source, or an array of sources for documents
    of several; ``carry`` names columns to keep."""
    carry = carry or []
    source = F.col(source_col)
    many = isinstance(docs.schema[source_col].dataType, ArrayType)
    members = F.sort_array(F.array_distinct(source)) if many else F.array(source.cast("string"))
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("null")))
    sized = pinned(docs.select(*carry, F.col(id_col).alias("id"), members.alias("members"),
                               words(F.col(text_col)).alias("size"), F.md5(text).alias("hash")))
    patterns = pinned(sized.groupBy("members").agg(F.sum("size").alias("words")))
    targets = pinned(_targets(patterns, weights, share, copies))
    amounts = (_amounts(patterns, targets, copies)
               .withColumn("whole", F.when(F.col("words") > 0, F.floor(F.col("amount") / F.col("words")))
                                     .otherwise(0).cast("bigint"))
               .select(F.struct("members").alias("key"), "whole",
                       (F.col("amount") - F.col("whole") * F.col("words")).alias("rest")))
    amounts = pinned(amounts)
    hint = F.broadcast if amounts.count() <= BROADCAST_ROWS else (lambda df: df)
    keyed = sized.withColumn("key", F.struct("members"))
    open_ = amounts.where("rest > 0")

    def inside(df: DataFrame, cut: DataFrame, depth: int) -> DataFrame:
        digits = F.substring("hash", depth * _DIGITS + 1, _DIGITS)
        return df.join(hint(cut.select("key", "bucket")), "key").where(digits == F.col("bucket")).drop("bucket")

    first = pinned(_cut(keyed, open_, 0, hint))
    near = inside(keyed, first, 0)
    second = pinned(_cut(near, first.select("key", "rest"), 1, hint))
    last = inside(near, second, 1)
    # The last bucket's documents in order: the cut lies in one of them.
    # Rows without an id, or of one id, share a hash: they may be very many.
    last = pinned(last.withColumn("row", F.monotonically_increasing_id()))
    on_edge = (running_sum(last, ["key"], ["hash", "size", "id", "row"], "size", "upto")
                   .withColumn("before", F.col("upto") - F.col("size"))
                   .join(hint(second.select("key", "rest")), "key")
                   .join(hint(amounts.select("key", "whole")), "key")
                   .withColumn("extra", F.greatest(F.lit(0), F.least("size", F.col("rest") - F.col("before")))))
    cuts = (amounts.join(hint(first.select("key", F.col("bucket").alias("b0"))), "key", "left")
                   .join(hint(second.select("key", F.col("bucket").alias("b1"))), "key", "left"))
    d0, d1 = F.substring("hash", 1, _DIGITS), F.substring("hash", _DIGITS + 1, _DIGITS)
    judged = keyed.join(hint(cuts), "key", "left")
    at_edge = F.coalesce((d0 == F.col("b0")) & (d1 == F.col("b1")), F.lit(False))
    extra = F.when((d0 < F.col("b0")) | (d0 == F.col("b0")) & (d1 < F.col("b1")), F.col("size")).otherwise(0)
    out = [*carry, "id", "members", "size", "whole", "extra"]
    rows = (judged.where(~at_edge).withColumn("extra", extra).select(*out)
                  .unionByName(on_edge.select(*out)))
    taken = F.coalesce(F.col("whole") * F.col("size") + F.col("extra"), F.lit(0)).cast("bigint")
    return Mix(rows.select(*carry, F.col("id").alias(id_col), "members", "size", taken.alias("taken")), targets)


def mixed_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", **options) -> DataFrame:
    """One row per document of a table with one source per document: id,
    size, source_size, target (its source's) and taken."""
    got = mix(docs, id_col, text_col, source_col, **options)
    targets = got.targets.select(F.struct("source").alias("key"), "source_size", "target")
    if got.targets.count() <= BROADCAST_ROWS:
        targets = F.broadcast(targets)
    return (got.documents.withColumn("key", F.struct(F.col("members")[0].alias("source")))
               .join(targets, "key")
               .select(id_col, "size", "source_size", "target", "taken"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source", **options) -> DataFrame:
    """The documents of the mix, all columns kept, each as many times as it
    is taken; the document at a source's boundary is taken whole if at
    least half of it is.  Rows of one id, source and text share what is
    taken among them, so whole times come out for all of them together."""
    named = docs.select("*", F.struct(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                                      F.xxhash64(text_col).alias("text")).alias("_own"))
    got = mix(named, id_col, text_col, source_col, carry=["_own"], **options).documents
    times = pinned(got.where("size > 0").groupBy("_own")
                      .agg(F.sum("taken").alias("taken"), F.first("size").alias("size"), F.count(F.lit(1)).alias("_rows"))
                      .select("_own", "_rows", F.floor(F.col("taken") / F.col("size") + 0.5).cast("bigint").alias("_times"))
                      .where("_times > 0"))
    joined = named.join(times, "_own")
    once = joined.where("_rows = 1")
    # Equal rows are numbered; the first ones take one time more.
    many = pinned(joined.where("_rows > 1").withColumns({"_row": F.monotonically_increasing_id(), "_one": F.lit(1).cast("bigint")}))
    dealt = running_sum(many, ["_own"], ["_row"], "_one", "_nth").withColumn(
        "_times", F.floor(F.col("_times") / F.col("_rows")) + (F.col("_nth") <= F.col("_times") % F.col("_rows")).cast("bigint"))
    rows = once.select(*docs.columns, "_times").unionByName(dealt.where("_times > 0").select(*docs.columns, "_times"))
    return rows.withColumn("_time", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_times")))).select(*docs.columns)
