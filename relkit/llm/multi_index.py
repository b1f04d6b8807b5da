"""Embedding near-duplicates through an inverted multi-index.

Vectors are scaled to length 1 and halved; each half has its own codebook,
and the pairs of codewords form a product grid.  A vector lives in the cell
of its nearest codewords and visits other cells in the order of the summed
squared distances of their codewords (along the first sequence, and for
each entry a prefix of the second), until the excess over its own cell
passes a stop value.  The stop value is set for a target recall on pairs
that lie exactly at the threshold.  Of two cells the one with the smaller
number sends its vectors to the other, so each pair is met once.  All
pairs that meet are verified by cosine in double precision.

Equal vectors of a label are one class with a count, so copies are not
compared with each other.  The vectors that live in a cell are dealt to
blocks of about ``block`` rows, and its visitors to parts of about
``VISITORS`` times as many rows; every pair of a block and a part is a unit
of work of its own, which holds the block and streams the other side.  A
unit returns, per vector, its number of links and one link to a
representative that keeps connectivity, never the pairs.

The codebooks are fitted on a bounded sample (the ``sample_rows`` rows with
the smallest hash of their id, of the ``LENGTHS`` commonest lengths, and
fewer of them if they take more than ``SAMPLE_BYTES``); every vector is
indexed.  Vectors shorter than the codebooks are filled with zeros, longer
ones are folded: their components are added up with fixed random signs at
as many places as the codebooks have, which keeps distances in expectation.
So a few very long vectors cost no more than themselves.  Links are always
verified on whole vectors.

Defined results: a vector that is null, zero or holds a null or non-finite
component, or whose label or id is null, links with nothing and is its own
component.  Vectors of different length do not link.  Rows that repeat a
vector count as vectors.  An empty table gives an empty result.  Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relkit.llm.common import pinned, shuffle_partitions
from relkit.llm.components import components

THRESHOLD = 0.93
TARGET_RECALL = 0.999
SAMPLE_ROWS = 20_000
BLOCK = 512
VISITORS = 8                     # blocks' worth of visitors in a unit
PER_CELL = 200                   # vectors a cell of the grid has on average
MAX_CODEWORDS = 1024             # of each half
MAX_DIM = 4096                   # of the codebooks
LENGTHS = 8                      # lengths that the sample is taken from
SAMPLE_BYTES = 256 << 20
BROADCAST_ROWS = 200_000
_SLICE = 2048
_COPIES = 16_384                 # visits that are in memory at a time


@dataclass
class Index:
    books: tuple[np.ndarray, np.ndarray]
    stop: float
    dim: int


def _fold(x: np.ndarray, dim: int) -> np.ndarray:
    if x.shape[1] < dim:
        return np.pad(x, ((0, 0), (0, dim - x.shape[1])))
    if x.shape[1] == dim:
        return x
    sign = np.random.default_rng(x.shape[1]).choice([-1.0, 1.0], x.shape[1])
    return np.add.reduceat(x * sign, np.arange(dim) * x.shape[1] // dim, axis=1)


def _halves(x: np.ndarray, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors folded or filled up to the codebooks' length, in halves."""
    x = _fold(x, dim)
    return x[:, :dim // 2], x[:, dim // 2:]


def _distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    return np.maximum(0, (x * x).sum(1)[:, None] - 2 * x @ book.T + (book * book).sum(1))


def _kmeans(x: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    rng = np.random.default_rng(11)
    book = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        own = _distances(x, book).argmin(1)
        sums = np.stack([np.bincount(own, x[:, j], k) for j in range(x.shape[1])], 1)
        n = np.bincount(own, minlength=k)[:, None]
        book = np.where(n > 0, sums / np.maximum(n, 1), book)
    return book


def build(sample: np.ndarray, rows: int, threshold: float, recall: float) -> Index:
    """Codebooks for a table of ``rows`` vectors, and the stop value: the
    excess at which ``recall`` of the pairs at the threshold are met, for
    neighbours in random directions of the sampled vectors."""
    dim = sample.shape[1]
    k = int(np.clip(np.sqrt(rows / PER_CELL), 2, MAX_CODEWORDS))
    k = min(k, len(sample))
    a, b = _halves(sample, dim)
    index = Index((_kmeans(a, k), _kmeans(b, k)), 0.0, dim)
    rng = np.random.default_rng(12)
    x = sample[rng.integers(0, len(sample), 20_000)]
    noise = rng.standard_normal(x.shape)
    noise -= (noise * x).sum(1, keepdims=True) * x
    noise /= np.maximum(np.linalg.norm(noise, axis=1, keepdims=True), 1e-12)
    y = threshold * x + np.sqrt(1 - threshold ** 2) * noise
    excess = np.zeros(len(x))
    for u, v, book in zip(_halves(x, dim), _halves(y, dim), index.books):
        d, other = _distances(u, book), _distances(v, book).argmin(1)
        excess += d[np.arange(len(d)), other] - d.min(1)
    index.stop = float(np.quantile(excess, recall))
    return index


def visits(x: np.ndarray, index: Index) -> tuple[np.ndarray, Iterator[tuple[np.ndarray, np.ndarray]]]:
    """Own cell of each vector; and the (row, cell) of every visit, in
    pieces of a few more than ``_COPIES`` (at most one codeword's visits)."""
    (a, b), k = _halves(x, index.dim), len(index.books[0])
    d1, d2 = _distances(a, index.books[0]), _distances(b, index.books[1])
    o1, o2 = d1.argsort(1, kind="stable"), d2.argsort(1, kind="stable")
    s1, s2 = np.take_along_axis(d1, o1, 1), np.take_along_axis(d2, o2, 1)
    s1 -= s1[:, :1].copy()
    s2 -= s2[:, :1].copy()
    own = o1[:, 0] * k + o2[:, 0]

    def pieces() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        rows, cells, held = [], [], 0
        for i in range(k):
            reach = np.flatnonzero(s1[:, i] <= index.stop)
            if not len(reach):
                break
            upto = (s2[reach] <= (index.stop - s1[reach, i])[:, None]).sum(1)
            row = np.repeat(reach, upto)
            j = np.arange(upto.sum()) - np.repeat(np.cumsum(upto) - upto, upto)
            cell = o1[row, i] * k + o2[row, j]
            keep = cell > own[row]
            rows.append(row[keep])
            cells.append(cell[keep])
            held += len(rows[-1])
            if held >= _COPIES:
                yield np.concatenate(rows), np.concatenate(cells)
                rows, cells, held = [], [], 0
        if held:
            yield np.concatenate(rows), np.concatenate(cells)

    return own, pieces()


def _unit(vectors: pd.Series) -> np.ndarray:
    x = np.array(vectors.tolist(), dtype=np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _place(handle):
    """The rows of each vector: where it lives (role 0) and visits (role 1)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index: Index = handle.value
        for batch in batches:
            for _, own in batch.groupby("dim", sort=False):
                for at in range(0, len(own), _SLICE):
                    part = own.iloc[at:at + _SLICE]
                    cell, pieces = visits(_unit(part["v"]), index)
                    yield part.assign(cell=cell, role=0)
                    for rows, cells in pieces:
                        for a in range(0, len(rows), _SLICE):
                            yield part.iloc[rows[a:a + _SLICE]].assign(cell=cells[a:a + _SLICE], role=1)
    return run


def _merge(comp: np.ndarray, linked: np.ndarray) -> np.ndarray:
    """Labels of the held rows after joining those that a row of ``linked``
    links."""
    big = len(comp)
    while True:
        by_row = np.where(linked, comp[None, :], big).min(1)
        new = np.minimum(comp, np.where(linked, by_row[:, None], big).min(0, initial=big))
        least = np.full(big + 1, big)
        np.minimum.at(least, comp, new)
        new = least[comp]
        if (new == comp).all():
            return comp
        comp = new


class _Block:
    """The block that a unit holds, and what its unit has found so far."""

    def __init__(self, held: pd.DataFrame, threshold: float):
        self.left, self.weight = _unit(held["v"]), held["m"].to_numpy()
        self.names, self.h = held["rep"].to_numpy(), held["h"].to_numpy()
        self.threshold, n = threshold, len(held)
        self.comp, self.n_left = np.arange(n), np.zeros(n, np.int64)
        if held["diagonal"].iloc[0]:
            for a in range(0, n, _SLICE):
                linked = self.left[a:a + _SLICE] @ self.left.T >= threshold
                linked[np.arange(len(linked)), a + np.arange(len(linked))] = False
                self.n_left[a:a + _SLICE] += linked @ self.weight
                self.comp = _merge(self.comp, linked | (np.arange(n) == (a + np.arange(len(linked)))[:, None]))

    def meet(self, rest: pd.DataFrame) -> Iterator[pd.DataFrame]:
        """Compares some rows of the other side; yields their links."""
        for a in range(0, len(rest), _SLICE):
            part = rest.iloc[a:a + _SLICE]
            linked = _unit(part["v"]) @ self.left.T >= self.threshold
            hit = linked.any(1)
            if not hit.any():
                continue
            part, linked = part[hit], linked[hit]
            self.n_left += part["m"].to_numpy() @ linked
            self.comp = _merge(self.comp, linked)
            yield pd.DataFrame({"rep": part["rep"].to_numpy(), "h": part["h"].to_numpy(),
                                "n": linked @ self.weight, "to": self.names[linked.argmax(1)]})

    def found(self) -> Iterator[pd.DataFrame]:
        """The links of the block's own rows."""
        hit = self.n_left > 0
        if hit.any():
            yield pd.DataFrame({"rep": self.names[hit], "h": self.h[hit], "n": self.n_left[hit],
                                "to": self.names[self.comp[hit]]})


def _verify(threshold: float):
    """Links of each unit: the block it holds against itself (if the unit
    is on the diagonal) and against the other side, as its rows come.  Rows
    are sorted by unit and role, so a unit's block comes first."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, held, block = None, [], None
        for batch in batches:
            for own, piece in batch.groupby(["unit_a", "unit_b", "role"], sort=False):
                unit, role = own[:2], own[2]
                if unit != key:
                    if held:
                        block = block or _Block(pd.concat(held, ignore_index=True), threshold)
                        yield from block.found()
                    key, held, block = unit, [], None
                if role == 0:
                    held.append(piece)
                elif held:
                    block = block or _Block(pd.concat(held, ignore_index=True), threshold)
                    yield from block.meet(piece)
        if held:
            block = block or _Block(pd.concat(held, ignore_index=True), threshold)
            yield from block.found()
    return run


def _usable(v: str):
    x = F.col(v)
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    return x.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(x, lambda e: e != 0)


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", threshold: float = THRESHOLD,
                    target_recall: float = TARGET_RECALL, sample_rows: int = SAMPLE_ROWS,
                    block: int = BLOCK) -> DataFrame:
    """One row per vector: id, n_links (other vectors of its label at
    cosine >= threshold), component_id (smallest id reachable by links),
    kept (id = component_id)."""
    spark = vectors.sparkSession
    own = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"),
                         F.col(vector_col).alias("v"))
    fit = _usable("v") & F.col("label").isNotNull() & F.col("id").isNotNull()
    good, bad = own.where(fit), own.where(~F.coalesce(fit, F.lit(False)))
    classes = pinned(good.groupBy("label", "v").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("m"))
                         .withColumn("h", F.xxhash64("v")).withColumn("dim", F.size("v")))
    rows = classes.count()
    result = ["id", "n_links", "component_id"]
    alone = bad.select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    if not rows:
        return _named(alone, id_col)
    # The commonest length, and the next ones unless they alone would take
    # the sample's bytes.
    lengths = classes.groupBy("dim").count().orderBy(F.desc("count"), "dim").limit(LENGTHS).collect()
    fits = lengths[:1] + [r for r in lengths[1:] if 8 * r.dim * sample_rows <= SAMPLE_BYTES]
    longest = max(r.dim for r in fits)
    dim = min(max(2, longest), MAX_DIM)
    most = max(2, min(sample_rows, SAMPLE_BYTES // (8 * longest)))
    # Hashes below a bound that some times the sample's size stay under, so
    # few rows meet for the choice of the smallest.
    place = F.pmod(F.xxhash64("rep"), F.lit(1 << 40))
    near = place < float(1 << 40) * 4 * most / sum(r["count"] for r in fits)
    first = (classes.where(F.col("dim").isin([r.dim for r in fits]) & near)
                    .orderBy(place, "rep", "h").select("v").limit(most).toPandas())
    sample = np.concatenate([_fold(_unit(own), dim) for _, own in first["v"].groupby(first["v"].map(len))])
    sample /= np.maximum(np.linalg.norm(sample, axis=1, keepdims=True), 1e-12)
    handle = spark.sparkContext.broadcast(build(sample, rows, threshold, target_recall))

    element = classes.schema["v"].dataType.simpleString()
    label = classes.schema["label"].dataType.simpleString()
    id_type = classes.schema["rep"].dataType.simpleString()
    parts = shuffle_partitions(spark)
    base = classes.select("label", "dim", "rep", "h", "m", "v")
    placed = base.repartition(parts).mapInPandas(
        _place(handle), f"label {label}, dim int, rep {id_type}, h bigint, m bigint, v {element}, "
                        "cell bigint, role int")
    # How many live in each cell and visit it; only occupied cells are visited.
    sizes = pinned(base.select("label", "dim", "rep", "h", "m", "v").repartition(parts)
                       .mapInPandas(_counts(handle), f"label {label}, dim int, cell bigint, role int, n bigint")
                       .groupBy("label", "dim", "cell")
                       .agg(F.sum(F.when(F.col("role") == 0, F.col("n"))).alias("n"),
                            F.sum(F.when(F.col("role") == 1, F.col("n"))).alias("visitors"))
                       .where("n is not null")
                       .withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
                       .withColumn("parts", F.greatest("blocks", F.ceil(
                           F.coalesce("visitors", F.lit(0)) / (VISITORS * block)).cast("int")))
                       .drop("n", "visitors"))
    small = F.broadcast(sizes) if sizes.count() <= BROADCAST_ROWS else sizes
    dealt = (placed.join(small, ["label", "dim", "cell"])
                   .withColumn("b", F.pmod(F.xxhash64("h", "rep"), F.when(F.col("role") == 0, F.col("blocks"))
                                                                    .otherwise(F.col("parts"))).cast("int")))
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    every_part = F.sequence(F.lit(0), F.col("parts") - 1)
    as_left = F.transform(every_part, lambda j: F.struct(F.col("b").alias("i"), j.alias("j"), F.lit(0).alias("role")))
    as_right = F.transform(every, lambda i: F.struct(i.alias("i"), F.col("b").alias("j"), F.lit(1).alias("role")))
    units = F.when(F.col("role") == 0, F.concat(as_left, F.filter(as_right, lambda s: s["i"] < s["j"]))) \
             .otherwise(as_right)
    work = (dealt.withColumn("u", F.explode(units))
                 .select(F.xxhash64("label", "dim", "cell", "u.i", "u.j").alias("unit_a"),
                         F.xxhash64(F.lit(1), "u.j", "u.i", "cell", "dim", "label").alias("unit_b"),
                         "u.role", (F.col("u.i") == F.col("u.j")).alias("diagonal"), "rep", "h", "m", "v")
                 .repartition(parts, "unit_a", "unit_b").sortWithinPartitions("unit_a", "unit_b", "role"))
    links = pinned(work.mapInPandas(_verify(threshold), f"rep {id_type}, h bigint, n bigint, to {id_type}"))
    n = links.groupBy("rep", "h").agg(F.sum("n").alias("n"))
    roots = components(links, "rep", "to")
    judged = (classes.join(n, ["rep", "h"], "left")
                     .join(roots, F.col("rep") == F.col("node"), "left")
                     .select("label", "v", (F.col("m") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
                             F.coalesce("root", "rep").alias("component_id")))
    return _named(good.join(judged, ["label", "v"]).select(*result).unionByName(alone), id_col)


def _named(rows: DataFrame, id_col: str) -> DataFrame:
    return rows.select(F.col("id").alias(id_col), "n_links", "component_id",
                       F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def _counts(handle):
    """How many rows of each cell ``_place`` makes, batch by batch."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index: Index = handle.value
        for batch in batches:
            for dim, own in batch.groupby("dim", sort=False):
                for at in range(0, len(own), _SLICE):
                    part = own.iloc[at:at + _SLICE]
                    labels = part["label"].to_numpy()
                    cell, pieces = visits(_unit(part["v"]), index)
                    yield _counted(labels, cell, dim, 0)
                    for rows, cells in pieces:
                        yield _counted(labels[rows], cells, dim, 1)
    return run


def _counted(labels: np.ndarray, cells: np.ndarray, dim: int, role: int) -> pd.DataFrame:
    return (pd.DataFrame({"label": labels, "dim": dim, "cell": cells, "role": role})
            .groupby(["label", "dim", "cell", "role"]).size().rename("n").reset_index())
