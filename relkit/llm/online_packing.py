"""Packing of documents into sequences by bounded-space online best-fit.

Each task tokenises its own documents and places every piece as it comes;
no token is shuffled and none is held back.  A document longer than a
sequence is cut into pieces of the full length, the first of them shorter
where the length does not divide; other documents stay whole.  A piece
goes into the open sequence with the least free space that still takes it.
Open sequences are kept by free space, with the occupied spaces as the
bits of one number: the best fit is the lowest set bit from the piece's
length on.  At most ``open_sequences`` are open at a time; when one more is
needed, the fullest closes first.  A full sequence closes at once.

Memory of a task: a slice of texts, one document's ids, and a sequence id
and fill for every open sequence.  The number of sequences exceeds the
optimum of each task's documents by what best-fit loses, and by what is
free in the last open sequences of a task.

Defined results: a null text is empty, and an empty text is the single end
id.  A null id is carried along.  Rows that repeat an id are packed once
per row.  Equal free spaces: the sequence that got this free space last is
taken.  An empty table gives an empty result.  Other columns are ignored.
Rows should come from a table (their order within a task is then fixed):
reruns give the same sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relkit.llm.common import slices
from relkit.llm.tier_packing import tokenizer

LENGTH = 1024
END_ID = 2
OPEN_SEQUENCES = 1024

SCHEMA = ("id {0}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, "
          "offset bigint")


class BestFit:
    """Sequences that are filled as pieces come; ``place`` tells the number
    of a piece's sequence and its offset there."""

    def __init__(self, length: int = LENGTH, open_sequences: int = OPEN_SEQUENCES):
        if length < 1 or open_sequences < 1:
            raise ValueError("a sequence holds at least one id, and at least one is open")
        self.length, self.most = length, open_sequences
        self.by_free: list[list[int]] = [[] for _ in range(length + 1)]
        self.bits = 0                                   # bit f: some open sequence has f free
        self.open = self.opened = 0

    def _take(self, free: int) -> int:
        sequence = self.by_free[free].pop()
        if not self.by_free[free]:
            self.bits &= ~(1 << free)
        self.open -= 1
        return sequence

    def place(self, n: int) -> tuple[int, int]:
        fits = self.bits >> n
        if fits:
            free = n + (fits & -fits).bit_length() - 1
            sequence = self._take(free)
        else:
            free, sequence = self.length, self.opened
            self.opened += 1
            if n < free and self.open == self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)
        if n < free:
            self.by_free[free - n].append(sequence)
            self.bits |= 1 << (free - n)
            self.open += 1
        return sequence, self.length - free


def cuts(n: int, length: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids."""
    first = n % length or length
    return [(0, first), *((a, length) for a in range(first, n, length))]


def _packer(path: str, length: int, open_sequences: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, bins = tokenizer(path), BestFit(length, open_sequences)
        shard = TaskContext.get().partitionId() << 33
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        types = [pa.int32(), *[pa.int64()] * 5]
        for batch in slices(batches):
            rows: list[tuple] = []
            for d, text in enumerate(batch.column("text").to_pylist()):
                ids = np.append(tok.ids(text or ""), np.uint32(end_id)).astype("<u4")
                for k, (start, n) in enumerate(cuts(len(ids), length)):
                    sequence, offset = bins.place(n)
                    rows.append((k, start, n, zlib.crc32(ids[start:start + n].tobytes()), shard + sequence,
                                 offset, d))
            *cols, owner = zip(*rows)
            own = batch.column("id").take(pa.array(owner, pa.int64()))
            yield pa.RecordBatch.from_arrays([own, *map(pa.array, cols, types)], names)
    return run


def pack_online(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                length: int = LENGTH, open_sequences: int = OPEN_SEQUENCES, end_id: int = END_ID) -> DataFrame:
    """One row per piece: id_col, piece (from 0), start (ids of its document
    before it), length, ids_crc32 (of its ids as little-endian unsigned
    32-bit), sequence_id and offset (in its sequence, gapless)."""
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = SCHEMA.format(own.schema["id"].dataType.simpleString())
    return (own.mapInArrow(_packer(tokenizer_path, length, open_sequences, end_id), schema)
               .withColumnRenamed("id", id_col))
