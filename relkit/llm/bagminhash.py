"""Near-duplicate documents by BagMinHash over multisets of word shingles.

A text's lower-cased words, split at white space, give its multiset of
five-word shingles (a shorter text is one shingle).  The weight of a
shingle is its count.  The weight axis is cut into [0, 1), [1, 2), [2, 4),
[4, 8), ...; every (shingle, interval) is a Poisson process whose rate is
the interval's width.  A point has a time, a place on the interval and a
signature component, all from hashes; it counts if its place lies below
the weight.  Each component keeps its earliest point, so two texts agree
in a component with probability equal to their weighted Jaccard
similarity.  Points are drawn only up to the time by which all components
are expected to be filled, and further only for texts with a gap.

Signatures are cut into bands.  Texts of equal words are one class, so
copies are neither banded nor compared.  In a bucket, every class is
compared with a few leaders, which joins almost all of a group.  Where the
classes of a bucket are then still in different groups, those outside its
largest group (the rest) meet all others of the bucket block by block
inside tasks, by 32-bit shingle names; blocks are bounded in classes and
in names.  So a class of the largest group is copied once per block of the
rest, which is small where a group is large, and no pair that shares a
bucket goes unjudged unless it is already joined; only pairs found near
leave the task.  Every link is verified by the exact multiset overlap of
all shingles (64-bit names).  Groups are the connected components.

With 25 bands of 5 a pair at similarity 0.8 shares a bucket with
probability 0.99995.

Defined results: a null text counts as empty; texts without words are one
class.  Classes and groups are of texts, not of ids: rows that repeat an id
(a null id included) with texts of different groups are in different
groups, which may then show one group_id.  Ids are integers; null ids come
after all others.  An empty table gives an empty result.  Other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relkit.llm.common import key_runs, parts_for, pinned, released, shuffle_partitions, slices
from relkit.llm.components import components

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 25, 5
#: Leaders of a bucket: the least number after a bitwise "xor" with each.
LEADERS = (0, 0x2545F4914F6CDD1D, 0x5851F42D4C957F2D)
BROADCAST_ROWS = 1_000_000
BLOCK = 256                       # classes of a block of a bucket's rest
PIECE = 2048                      # classes of a bucket's largest group that meet a block in one unit
BLOCK_NAMES = 1 << 21             # shingles of a block or piece, about (one class may have more)
_NAMES = 4096                     # columns of an incidence matrix
_SLACK = 0.01                     # for equal short names of different shingles
_KNOWN = 100_000                  # names of words a task remembers
_TEXTS = 4_000                    # texts whose processes are drawn together, at most
_BATCH = 100_000                  # shingles whose processes are drawn together; a worker keeps what they took

_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
        return x ^ (x >> _U(33))


class _Names(dict):
    """64-bit names of words."""

    def __missing__(self, word: str) -> int:
        n = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "replace"))
        return n


def shingles(words: list[str], names: _Names, size: int = WORDS) -> np.ndarray:
    """Sorted names of the shingles, repeats included."""
    if not words:
        return np.empty(0, _U)
    w = np.fromiter(map(names.__getitem__, words), _U, len(words))
    if len(names) > _KNOWN:
        names.clear()
    n = max(1, len(w) - size + 1)
    h = np.full(n, size, _U)
    with np.errstate(over="ignore"):
        for j in range(min(size, len(w))):
            h = _mix(h * _U(0x9E3779B97F4A7C15) + w[j:j + n])
    h.sort()
    return h


def as_set(sorted_names: np.ndarray) -> np.ndarray:
    """A multiset as a set: the k-th copy of a name gets a name of its own."""
    if not len(sorted_names):
        return sorted_names
    at = np.arange(len(sorted_names))
    head = np.append(True, sorted_names[1:] != sorted_names[:-1])
    nth = (at - np.maximum.accumulate(np.where(head, at, 0))).astype(_U)
    return np.sort(np.where(nth == 0, sorted_names, _mix(sorted_names + nth * _U(0x9E3779B97F4A7C15))))


def signatures(bags: list[np.ndarray], m: int) -> np.ndarray:
    """BagMinHash signatures (texts x m) of sorted name lists."""
    out = np.zeros(len(bags) * m, _U)
    sizes = np.array([len(b) for b in bags], np.float64)
    if not sizes.any():
        return out.reshape(len(bags), m)
    flat, doc = np.concatenate(bags), np.repeat(np.arange(len(bags)), sizes.astype(np.int64))
    head = np.append(True, (flat[1:] != flat[:-1]) | (doc[1:] != doc[:-1]))
    at = np.flatnonzero(head)
    weight = np.diff(np.append(at, len(flat)))
    name, doc = flat[at], doc[at]
    # Processes: interval 0 is [0, 1), interval i is [2**(i-1), 2**i).
    parts = []
    interval, low = 0, 0
    while (inside := weight > low).any():
        parts.append((name[inside], doc[inside], np.full(inside.sum(), interval), weight[inside] - low))
        low, interval = 1 << interval, interval + 1
    name, doc, which, above = (np.concatenate(x) for x in zip(*parts))
    rate = np.where(which == 0, 1, 1 << np.maximum(which - 1, 0)).astype(np.float64)
    with np.errstate(over="ignore"):
        state = _mix(name + (which + 1).astype(_U) * _U(0xD1342543DE82EF95))
    best = np.full(len(out), np.inf)
    time = np.zeros(len(name))
    limit = np.where(sizes > 0, m * (np.log(m) + 3) / np.maximum(sizes, 1), -1.0)
    while len(time):
        waiting: list[tuple] = []
        while len(time):
            with np.errstate(over="ignore"):
                drawn = _mix(state + _U(0x9E3779B97F4A7C15))
            after = time - np.log(((drawn >> _U(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / rate
            early = after <= limit[doc]
            if not early.all():                  # kept for texts that will need more points
                late = ~early
                waiting.append(tuple(x[late] for x in (state, doc, rate, above, time)))
                state, doc, rate, above, after, drawn = (x[early] for x in (state, doc, rate, above, after, drawn))
            time = after
            point = _mix(drawn ^ _U(0xA0761D6478BD642F))
            place = ((point >> _U(32)).astype(np.float64) * 2.0 ** -32 * rate).astype(np.int64)
            counts = place < above
            slot = doc * m + ((point & _U(0xFFFFFFFF)) % _U(m)).astype(np.int64)
            slot, when, key = slot[counts], time[counts], point[counts]
            np.minimum.at(best, slot, when)
            won = best[slot] == when
            out[slot[won]] = key[won]
            state = drawn
        gap = np.isinf(best.reshape(-1, m)).any(1) & (sizes > 0)
        if not gap.any():
            break
        limit = np.where(gap, limit * 1.5, -1.0)
        state, doc, rate, above, time = (np.concatenate(x) for x in zip(*waiting))
        open_ = gap[doc]
        state, doc, rate, above, time = (x[open_] for x in (state, doc, rate, above, time))
    return out.reshape(len(bags), m)


def _key(words: list[str]) -> bytes:
    """The name of a class of equal texts."""
    return xxhash.xxh3_128_digest(" ".join(words).encode("utf-8", "replace"))


def _keyed(text_col: str):
    """The rows with the name of their text's class as ``_key``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keys = [_key((text or "").lower().split()) for text in batch.column(text_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())],
                                             [*batch.schema.names, "_key"])
    return run


def _signed(bands: int, rows: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = _Names()

        def told(ids: list, keys: list[bytes], bags: list[np.ndarray]) -> pa.RecordBatch:
            sig = signatures(bags, bands * rows).reshape(-1, bands, rows)
            h = np.full(sig.shape[:2], 1, _U)
            with np.errstate(over="ignore"):
                h = h * (np.arange(bands, dtype=_U) + _U(1))
                for j in range(rows):
                    h = _mix(h * _U(0x9E3779B97F4A7C15) + sig[:, :, j])
            some = [len(b) > 0 for b in bags]
            values = h[some].view(np.int64).ravel()
            offsets = np.append(0, np.cumsum(np.array(some) * bands)).astype(np.int32)
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(keys, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))], ["id", "key", "buckets"])

        ids, keys, bags, held = [], [], [], 0
        for batch in slices(batches):
            for own, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                words = (text or "").lower().split()
                bag = shingles(words, names, size)
                ids.append(own)
                keys.append(_key(words))
                bags.append(bag)
                held += len(bag)
                if held >= _BATCH or len(ids) >= _TEXTS:
                    yield told(ids, keys, bags)
                    ids, keys, bags, held = [], [], [], 0
        if ids:
            yield told(ids, keys, bags)
    return run


def _named_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = _Names()
        for batch in slices(batches):
            words = [(t or "").lower().split() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(map(_key, words), pa.binary()),
                 pa.array([as_set(shingles(w, names, size)).tobytes() for w in words], pa.binary())], ["key", "names"])
    return run


def overlap(a: bytes, b: bytes) -> float:
    """Weighted Jaccard similarity of two multisets, given as sets."""
    x, y = np.frombuffer(a, _U), np.frombuffer(b, _U)
    if not len(x) or not len(y):
        return 0.0
    both = np.concatenate([x, y])
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return common / (len(x) + len(y) - common)


def _judge(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            near = [overlap(x.as_buffer(), y.as_buffer()) >= threshold
                    for x, y in zip(batch.column("x"), batch.column("y"))]
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))
    return run


def _links(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs a, b whose multisets (rep, n, names) overlap enough.
    Pairs of too different size are left out before any set moves."""
    na, nb = (_few(sets.select(F.col("rep").alias(c), F.col("n").alias(f"n{c}"))) for c in "ab")
    close = F.least("na", "nb") >= threshold * F.greatest("na", "nb")
    sized = pinned(pairs.join(na, "a").join(nb, "b").where(close).select("a", "b").distinct())
    x, y = (sets.select(F.col("rep").alias(c), F.col("names").alias(n)) for c, n in (("a", "x"), ("b", "y")))
    links = pinned(sized.join(x, "a").join(y, "b").select("a", "b", "x", "y")
                        .mapInArrow(_judge(threshold), "a bigint, b bigint"))
    released(sized)
    return links


def _few(df: DataFrame) -> DataFrame:
    """Marked for broadcast if it has few rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _named32(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        short = [np.unique((np.frombuffer(x, _U) >> _U(32)).astype(np.uint32)).tobytes()
                 for x in batch.column("names").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("rep"), pa.array(short, pa.binary())], ["rep", "names"])


def common_names(held: list[np.ndarray], other: list[np.ndarray]) -> np.ndarray:
    """Number of common names of each pair (held x other): products of
    incidence matrices over slices of the names that occur on both sides."""
    out = np.zeros((len(held), len(other)), np.float32)
    own = np.concatenate([*held, *other])
    doc = np.repeat(np.arange(len(held) + len(other)), [len(x) for x in (*held, *other)])
    order = np.argsort(own, kind="stable")
    own, doc = own[order], doc[order]
    number = np.cumsum(np.append(0, own[1:] != own[:-1])) if len(own) else own
    left = np.zeros(number[-1] + 1 if len(number) else 0, bool)
    right = left.copy()
    left[number[doc < len(held)]] = True
    right[number[doc >= len(held)]] = True
    shared = left & right
    keep = shared[number] if len(number) else np.zeros(0, bool)
    number, doc = (np.cumsum(shared) - 1)[number[keep]] if keep.any() else number[:0], doc[keep]
    for a in range(0, int(shared.sum()), _NAMES):
        i, j = np.searchsorted(number, [a, a + _NAMES])
        m = np.zeros((len(held) + len(other), _NAMES), np.float32)
        m[doc[i:j], number[i:j] - a] = 1
        out += m[:len(held)] @ m[len(held):].T
    return out


def _unit_links(threshold: float):
    """For each unit (two blocks of a bucket, or one with itself), pairs of
    different groups that overlap enough by short names: the best pair of
    each two groups, and all pairs too near the threshold to tell."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for unit in key_runs(batches, ["bucket", "i", "j", "piece"]):
            held, other = unit[unit["role"] == 0], unit[unit["role"] == 1]
            if unit["i"].iloc[0] == unit["j"].iloc[0]:
                other = held
            if not len(held) or not len(other):
                continue
            x, y = ([np.frombuffer(n, np.uint32) for n in f["names"]] for f in (held, other))
            common = common_names(x, y)
            total = np.array([len(n) for n in x])[:, None] + np.array([len(n) for n in y])[None] - common
            near = np.where(total > 0, common / np.maximum(total, 1), 0)
            rx, ry = held["root"].to_numpy(), other["root"].to_numpy()
            i, j = np.nonzero((near >= threshold - _SLACK) & (rx[:, None] != ry[None]))
            if not len(i):
                continue
            a, b = held["rep"].to_numpy()[i], other["rep"].to_numpy()[j]
            got = pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b), "near": near[i, j],
                                "ra": np.minimum(rx[i], ry[j]), "rb": np.maximum(rx[i], ry[j])})
            best = ~got.sort_values("near", ascending=False).duplicated(["ra", "rb"]).reindex(got.index)
            yield got.loc[best | (got["near"] < threshold + _SLACK), ["a", "b"]]
    return run


def _across(members: DataFrame, groups: DataFrame, sets: DataFrame, threshold: float, parts: int) -> DataFrame:
    """Pairs of bucket mates in different groups that may be near.  The rest
    of a bucket, in blocks, meets itself and the pieces of the largest
    group inside tasks; only near pairs come out."""
    sized = _few(sets.select("rep", "n"))
    grouped = (members.select("bucket", "rep").join(groups.withColumnRenamed("node", "rep"), "rep", "left").join(sized, "rep")
                      .select("bucket", "rep", F.coalesce("root", "rep").alias("root"), "n"))
    by_root = grouped.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("classes"), F.sum("n").alias("names"))
    largest = F.max(F.struct("classes", "names", "root"))
    dealt = lambda c, each: F.greatest(F.ceil(F.col(f"{c}.classes") / each), F.ceil(F.col(f"{c}.names") / BLOCK_NAMES))
    open_ = (by_root.groupBy("bucket").agg(largest.alias("main"), F.sum("classes").alias("classes"), F.sum("names").alias("names"))
                    .where(F.col("classes") > F.col("main.classes"))
                    .withColumn("rest", F.struct((F.col("classes") - F.col("main.classes")).alias("classes"),
                                                 (F.col("names") - F.col("main.names")).alias("names")))
                    .select("bucket", F.col("main.root").alias("main"), dealt("rest", BLOCK).cast("int").alias("blocks"),
                            dealt("main", PIECE).cast("int").alias("pieces")))
    mixed = pinned(grouped.join(open_, "bucket"))
    none, upto = F.lit(-1), lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    place = lambda c: F.pmod(F.xxhash64("rep"), F.col(c)).cast("int")
    unit = lambda i, j, piece, role: F.struct(i.alias("i"), j.alias("j"), piece.alias("piece"), F.lit(role).alias("role"))
    b = place("blocks")
    rest = F.concat(F.transform(F.filter(upto("blocks"), lambda j: j >= b), lambda j: unit(b, j, none, 0)),
                    F.transform(F.filter(upto("blocks"), lambda i: i < b), lambda i: unit(i, b, none, 1)),
                    F.transform(upto("pieces"), lambda p: unit(b, none, p, 0)))
    main = F.transform(upto("blocks"), lambda i: unit(i, none, place("pieces"), 1))
    units = mixed.withColumn("u", F.explode(F.when(F.col("root") == F.col("main"), main).otherwise(rest)))
    asked = _few(mixed.select("rep").distinct())
    short = sets.select("rep", "names").join(asked, "rep", "left_semi").mapInArrow(_named32, "rep bigint, names binary")
    keys = ["bucket", "i", "j", "piece"]
    work = (units.select("bucket", "u.i", "u.j", "u.piece", "u.role", "rep", "root").join(short, "rep")
                 .repartition(parts, *keys).sortWithinPartitions(*keys, "role"))
    found = pinned(work.mapInPandas(_unit_links(threshold), "a bigint, b bigint").distinct())
    released(mixed)
    return found


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = THRESHOLD, words: int = WORDS, bands: int = BANDS,
                    rows: int = ROWS, leaders: tuple[int, ...] = LEADERS) -> DataFrame:
    """One row per document: id, class_id (smallest id of the equal
    texts), group_id (smallest id of the group) and kept (the id is
    group_id, and the text the group's first of that id)."""
    judged = _judged(docs, id_col, text_col, threshold, words, bands, rows, leaders)
    return judged.select(F.col("id").alias(id_col), "class_id", "group_id", "kept")


def _judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            threshold: float = THRESHOLD, words: int = WORDS, bands: int = BANDS,
            rows: int = ROWS, leaders: tuple[int, ...] = LEADERS) -> DataFrame:
    """``near_duplicates`` with the id as ``id`` and the name of the text's
    class as ``key``."""
    own = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    signed = pinned(own.mapInArrow(_signed(bands, rows, words), "id bigint, key binary, buckets array<bigint>"))
    # A class is numbered once, and the numbers are pinned: its name among links.
    classes = pinned(signed.groupBy("key").agg(F.min("id").alias("id"), F.first("buckets").alias("buckets"))
                           .withColumn("rep", F.monotonically_increasing_id()))
    banded = classes.select("rep", F.explode("buckets").alias("bucket"))
    heads = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), *[
        F.min(F.col("rep").bitwiseXOR(F.lit(s))).alias(f"l{k}") for k, s in enumerate(leaders)]).where("n > 1")
    members = pinned(banded.join(heads, "bucket"))
    # Rows of the members table, and so a bound on the pairs of a leader.
    parts = parts_for(docs.sparkSession, members.count())
    members = members.coalesce(parts)
    found = pinned(classes.join(members.select("rep").distinct(), "rep", "left_semi").select("rep", "id", "key"))
    named = own.withColumn("own", F.struct("id")).join(
        _few(found.select(F.struct("id").alias("own")).distinct()), "own", "left_semi").select("text")
    sets = pinned(named.mapInArrow(_named_sets(words), "key binary, names binary").join(_few(found.select("key", "rep")), "key")
                       .dropDuplicates(["rep"]).select("rep", F.length("names").alias("n"), "names"))
    leader = F.explode(F.array(*[F.col(f"l{k}").bitwiseXOR(F.lit(s)) for k, s in enumerate(leaders)]))
    pairs = (members.select("rep", leader.alias("leader"))
                    .select(F.least("rep", "leader").alias("a"), F.greatest("rep", "leader").alias("b"))
                    .where("a < b").distinct().coalesce(parts))
    led = _links(pairs, sets, threshold)
    groups = pinned(components(led))
    # With as few members as leaders, all have met.
    across = _across(members.where(F.col("n") > min(3, len(leaders))), groups, sets, threshold, shuffle_partitions(docs.sparkSession))
    more = _links(across, sets, threshold)
    if more.count():
        last = pinned(components(groups.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more)))
        released(groups)
        groups = last
    told = classes.select("key", "id", "rep").join(groups.select(F.col("node").alias("rep"), "root"), "rep", "left")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key"))
    of_group = _few(pinned(told.where("root is not null").groupBy("root").agg(first.alias("first"))))
    by_class = pinned(told.join(of_group, "root", "left").select(
        "key", F.col("id").alias("class_id"), F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("first.id")).alias("group_id"),
        F.coalesce("first.key", "key").alias("first")))
    released(classes, found, sets, led, across, more, groups)
    return signed.select("id", "key").join(by_class, "key").select(
        "id", "key", "class_id", "group_id", (F.col("id").eqNullSafe(F.col("group_id")) & (F.col("key") == F.col("first"))).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each group, all columns kept: of the
    group's smallest id (null ids last), and of its texts the first."""
    judged = pinned(_judged(docs, id_col, text_col, **options)
                    .select(F.struct("id").alias("_own"), F.col("key").alias("_key"), "kept"))
    by_id = pinned(judged.groupBy("_own").agg(F.count(F.lit(1)).alias("n"), F.bool_or("kept").alias("any"))
                         .where("n > 1 or not any"))
    gone, again = by_id.where("not any").select("_own"), by_id.where("any").select("_own")
    left = docs.withColumn("_own", F.struct(F.col(id_col).cast("bigint").alias("id"))).join(_few(gone), "_own", "left_anti")
    repeated = _few(again)
    once = left.join(repeated, "_own", "left_anti")
    # Rows of an id may have different texts, of which only some are kept.
    rows = left.join(repeated, "_own", "left_semi")
    rows = rows.mapInArrow(_keyed(text_col), rows.withColumn("_key", F.lit(b"")).schema)
    texts = pinned(judged.where("kept").join(repeated, "_own", "left_semi").select("_own", "_key").distinct())
    released(judged)
    one = rows.join(texts, ["_own", "_key"], "left_semi").dropDuplicates(["_own", "_key"])
    return once.unionByName(one.drop("_key")).select(*docs.columns)
