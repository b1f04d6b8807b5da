"""Hierarchical packing of documents into training sequences of several
lengths.

Each task tokenises its own documents and packs them, so no token is
shuffled.  A document of at least the longest window fills whole windows;
its rest, like every shorter document, is routed to the tier with the
smallest window it fits.  Tiers are packed from the longest down: a piece
opens a window, the gap is filled with the longest pieces of shorter
tiers that still fit, and the last gap is closed by cutting one piece.  So
every window is full.  What is left at the end of a task, less than one
window, is laid out in sequences of falling powers of two.  The windows of
a tier are dealt to step groups of equal token counts: the sizes of the
groups of a pool differ by one window at most.

Memory of a task: one pool of ``pool_tokens`` ids and one document.

Defined results: a null text is empty, and an empty text is the single
end id.  A null id is carried along.  Rows that repeat an id are packed
once per row.  An empty table gives an empty result.  Other columns are
ignored.  Rows should come from a table (their order within a task is
then fixed): reruns give the same sequences.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relkit.llm.common import slices

TIERS = (256, 512, 1024)
STEP_TOKENS = 8192
POOL_TOKENS = 1 << 21
END_ID = 0
#: Beyond this length a text goes to the general tokenizer, whose time per
#: character does not depend on how the text is spaced.
LONG_TEXT = 1_000_000
#: The vocabulary's way of splitting a text before merges.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

SCHEMA = ("id {0}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
          "sequence_id bigint, offset bigint, window bigint, step_group bigint")

_loaded: dict[str, ByteTokenizer] = {}


class ByteTokenizer:
    """The ids that the byte-level BPE vocabulary file gives, by a faster
    reader of the same vocabulary (compared in the tests)."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer
        self.general = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {x["content"]: x["id"] for x in spec.get("added_tokens", [])}
        byte_of = _byte_letters()
        ranks = {bytes(byte_of[c] for c in token): i
                 for token, i in spec["model"]["vocab"].items() if token not in special}
        self.special = special
        self.fast = tiktoken.Encoding("vocabulary", pat_str=SPLIT, mergeable_ranks=ranks,
                                      special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if len(text) > LONG_TEXT or any(x in text for x in self.special):
            return np.array(self.general.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype(np.uint32, copy=False)


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies:
    printable Latin-1 for itself, the others from code point 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def tokenizer(path: str) -> ByteTokenizer:
    if path not in _loaded:
        _loaded[path] = ByteTokenizer(path)
    return _loaded[path]


class _Shelf:
    """Pieces by length, with the lengths at hand as bits of a number."""

    def __init__(self, longest: int):
        self.by: list[list] = [[] for _ in range(longest + 1)]
        self.bits = 0

    def put(self, piece: tuple[int, int, int]) -> None:
        self.by[piece[2]].append(piece)
        self.bits |= 1 << piece[2]

    def take(self, most: int) -> tuple[int, int, int] | None:
        """The longest piece of at most ``most`` ids."""
        n = (self.bits & ((2 << most) - 1)).bit_length() - 1
        if n <= 0:
            return None
        piece = self.by[n].pop()
        if not self.by[n]:
            self.bits &= ~(1 << n)
        return piece


def pack(lengths: list[int], tiers: tuple[int, ...], last: bool
         ) -> tuple[list[tuple[int, list[tuple[int, int, int]]]], list[tuple[int, int, int]]]:
    """Full windows (window length, pieces) for documents of these token
    counts, and the pieces left over; a piece is (document, start,
    length).  ``last``: lay out the rest in powers of two."""
    longest, out, shelf = tiers[-1], [], _Shelf(tiers[-1])
    for d, n in enumerate(lengths):
        whole = n // longest
        out += [(longest, [(d, k * longest, longest)]) for k in range(whole)]
        if n > whole * longest:
            shelf.put((d, whole * longest, n - whole * longest))
    rest: list[tuple[int, int, int]] = []
    for t, tier in reversed(list(enumerate(tiers))):
        least = tiers[t - 1] if t else 0
        while shelf.bits >> (least + 1):
            pieces = [shelf.take(tier)]
            gap = tier - pieces[0][2]
            while gap and (more := shelf.take(gap)):
                pieces.append(more)
                gap -= more[2]
            if gap and shelf.bits:                       # cut one piece to close the gap
                d, start, n = shelf.take(longest)
                pieces.append((d, start, gap))
                shelf.put((d, start + gap, n - gap))
                gap = 0
            if gap:
                rest += pieces
            else:
                out.append((tier, pieces))
    if not last:
        return out, rest
    left = sum(p[2] for p in rest)
    while left:
        size = 1 << (min(left, longest).bit_length() - 1)
        pieces, gap = [], size
        while gap:
            d, start, n = rest.pop()
            pieces.append((d, start, min(n, gap)))
            if n > gap:
                rest.append((d, start + gap, n - gap))
            gap -= min(n, gap)
        out.append((size, pieces))
        left -= size
    return out, []


def _packer(path: str, tiers: tuple[int, ...], step_tokens: int, pool_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(path)
        shard = TaskContext.get().partitionId() << 33
        n_seq = n_group = 0
        id_type = None
        pool: list[tuple[object, np.ndarray, int, int]] = []    # id, ids, start in document, its ids
        held = 0

        def packed(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal pool, held, n_seq, n_group
            windows, rest = pack([len(x[1]) for x in pool], tiers, last)
            groups: dict[int, int] = {}
            for size, _ in windows:
                groups[size] = groups.get(size, 0) + 1
            first = {}
            for size in sorted(groups):
                groups[size] = -(-groups[size] * size // step_tokens)
                first[size] = n_group
                n_group += groups[size]
            seen = dict.fromkeys(groups, 0)
            rows: list[tuple] = []
            for size, pieces in windows:
                offset, group = 0, first[size] + seen[size] % groups[size]
                seen[size] += 1
                for d, start, n in pieces:
                    own, ids, before, total = pool[d]
                    rows.append((own, before + start, n, zlib.crc32(ids[start:start + n].tobytes()),
                                 total, shard + n_seq, offset, size, shard + group))
                    offset += n
                n_seq += 1
            names = [x.split()[0] for x in SCHEMA.split(", ")]
            for a in range(0, len(rows), 50_000):
                cols = list(zip(*rows[a:a + 50_000]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], id_type), *(pa.array(c, pa.int64()) for c in cols[1:])], names)
            pool = [(pool[d][0], pool[d][1][s:s + n].copy(), pool[d][2] + s, pool[d][3])
                    for d, s, n in rest]
            held = sum(n for _, _, n in rest)

        for batch in slices(batches):
            id_type = batch.schema.field("id").type
            for own, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                ids = np.append(tok.ids(text or ""), np.uint32(END_ID)).astype("<u4")
                pool.append((own, ids, 0, len(ids)))
                held += len(ids)
                if held >= pool_tokens:
                    yield from packed(False)
        if pool:
            yield from packed(True)
    return run


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
                   text_col: str = "text", tiers: tuple[int, ...] = TIERS,
                   step_tokens: int = STEP_TOKENS, pool_tokens: int = POOL_TOKENS) -> DataFrame:
    """One row per piece: id_col, start (ids of its document before it),
    length, ids_crc32 (of its ids as little-endian unsigned 32-bit),
    doc_tokens (with the end id), sequence_id, offset (in its sequence,
    gapless), window (length of the sequence) and step_group."""
    if any(t & (t - 1) for t in tiers) or list(tiers) != sorted(set(tiers)):
        raise ValueError("tiers are rising powers of two")
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = SCHEMA.format(own.schema["id"].dataType.simpleString())
    return (own.mapInArrow(_packer(tokenizer_path, tuple(tiers), step_tokens, pool_tokens), schema)
               .withColumnRenamed("id", id_col))
