"""Exact deduplication by content-defined chunk recipes.

Every text is cut where a rolling hash of its last 32 bytes takes a given
value, so equal passages give equal chunks wherever they stand.  A chunk
is named by its 128-bit hash.  The chunks of all texts are made distinct
(combined map-side) and every name is verified to stand for one content;
should one stand for two, the run is repeated under another hash seed.
After that the ordered list of names, the recipe, stands for the text:
texts are compared, grouped and joined by recipes of 16 bytes a chunk and
no whole text is shuffled.

Defined results: a null text counts as empty; an empty text has the empty
recipe, and all empty texts are equal.  A null id never stays before one
that is not null.  Rows that repeat an id with an equal text stay or go
together.  An empty table gives an empty result.  Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relkit.llm.common import pinned

WINDOW = 32                 # bytes that the rolling hash looks back on
MIN_CHUNK, MAX_CHUNK = 256, 8192
MEAN_BITS = 10              # a cut about every 2**10 bytes
_BLOCK = 1 << 20


def _gear() -> np.ndarray:
    """256 odd-looking 32-bit numbers from a rule (splitmix64 steps)."""
    with np.errstate(over="ignore"):
        z = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (z >> np.uint64(32)).astype(np.uint32)


_GEAR = _gear()


def cut_candidates(data: np.ndarray, bits: int = MEAN_BITS) -> np.ndarray:
    """Ends (exclusive) of chunks that the rolling hash proposes."""
    found = []
    for a in range(0, len(data), _BLOCK):
        lo = max(0, a - WINDOW + 1)
        h = _GEAR[data[lo:a + _BLOCK]]
        step = 1
        while step < WINDOW:                # sums over 2, 4, ... WINDOW bytes
            h[step:] += h[:-step] << np.uint32(step)    # the right side is read first
            step *= 2
        at = np.flatnonzero((h >> np.uint32(32 - bits)) == 0) + lo + 1
        found.append(at[at > a])
    return np.concatenate(found) if found else np.empty(0, np.int64)


def cuts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[list[int]]:
    """Chunk ends of each text; texts lie in ``data`` at starts..ends.  A
    cut at least MIN_CHUNK (>= WINDOW) bytes from the text's start does
    not depend on what stands before the text."""
    cand = cut_candidates(data)
    first, last = np.searchsorted(cand, starts), np.searchsorted(cand, ends)
    for a, b, i, j in zip(starts.tolist(), ends.tolist(), first.tolist(), last.tolist()):
        out, at = [], a
        if b - a > MIN_CHUNK:
            for c in cand[i:j].tolist():
                while c - at > MAX_CHUNK:
                    at += MAX_CHUNK
                    out.append(at)
                if c - at >= MIN_CHUNK:
                    out.append(c)
                    at = c
        while b - at > MAX_CHUNK:
            at += MAX_CHUNK
            out.append(at)
        if b > at:
            out.append(b)
        yield out


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Slices of a batch of at most a few MB (or one long text), with the
    UTF-8 bytes of their texts and where each lies."""
    col = batch.column("text").cast(pa.large_binary())
    lengths = pa.compute.fill_null(pa.compute.binary_length(col), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(lengths) // (4 * _BLOCK)
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(col)]
    for a, b in zip(edges[:-1], edges[1:]):
        if a == b:
            continue
        whole = b"".join(x or b"" for x in col[a:b].to_pylist())
        ends = np.cumsum(lengths[a:b])
        yield batch.slice(a, b - a), np.frombuffer(whole, np.uint8), ends - lengths[a:b], ends


def _recipes(seed: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, starts, ends in _texts(batch):
                whole, recipe, sha = memoryview(data), [], []
                for a, b, c in zip(starts.tolist(), ends.tolist(), cuts(data, starts, ends)):
                    recipe.append(b"".join(xxhash.xxh3_128_digest(whole[x:y], seed)
                                           for x, y in zip([a, *c], c)))
                    sha.append(hashlib.sha256(whole[a:b]).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [rows.column("id"), pa.array(recipe, pa.binary()), pa.array(sha, pa.string())],
                    ["id", "recipe", "text_sha256"])
    return run


def _chunks(seed: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, starts, ends in _texts(batch):
                whole, seen = data.tobytes(), set()
                for a, c in zip(starts.tolist(), cuts(data, starts, ends)):
                    seen.update(whole[x:y] for x, y in zip([a, *c], c))
                own = list(seen)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([xxhash.xxh3_128_digest(x, seed) for x in own], pa.binary()),
                     pa.array(own, pa.binary())], ["name", "chunk"])
    return run


def _misnamed(docs: DataFrame, seed: int) -> bool:
    """Does some chunk name stand for two contents?"""
    found = docs.select("text").mapInArrow(_chunks(seed), "name binary, chunk binary")
    names = found.distinct().groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    return not names.where(F.col("n") > 1).isEmpty()


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id_col, keep_id (largest id of the
    equal texts), group_size, kept, text_sha256 and n_chunks."""
    own = docs.select(F.col(id_col).alias("id"),
                      F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    seed = next((s for s in range(4) if not _misnamed(own, s)), None)
    if seed is None:
        raise RuntimeError("chunk names collide under every seed: the texts were made to collide")
    id_type = own.schema["id"].dataType.simpleString()
    recipes = pinned(own.mapInArrow(_recipes(seed),
                                    f"id {id_type}, recipe binary, text_sha256 string"))
    # Pinned, so that both sides of the join are exchanged for it and the
    # rows of a recipe that many texts share can be split.
    groups = pinned(recipes.groupBy("recipe").agg(F.max("id").alias("keep_id"),
                                                  F.count(F.lit(1)).alias("group_size")))
    return (recipes.join(groups, "recipe")
                   .select(F.col("id").alias(id_col), "keep_id", "group_size",
                           F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256",
                           (F.length("recipe") / 16).cast("bigint").alias("n_chunks")))
