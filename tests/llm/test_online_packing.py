"""Online best-fit packing: every id once, and a plain best-fit."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from conftest import SF0001
from relkit.llm import online_packing as O
from relkit.llm.queries import QUERIES

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def plain(lengths, capacity, most):
    """Best-fit by looking at every open bin."""
    bins, out, opened = [], [], 0                     # [free, age, number]
    for age, n in enumerate(lengths):
        fits = [b for b in bins if b[0] >= n]
        if fits:
            b = min(fits, key=lambda b: (b[0], -b[1]))
        else:
            b = [capacity, age, opened]
            opened += 1
            if n < capacity:
                if len(bins) == most:
                    bins.remove(min(bins, key=lambda b: (b[0], -b[1])))
                bins.append(b)
        out.append((b[2], capacity - b[0]))
        b[0] -= n
        b[1] = age
        if b[0] == 0 and b in bins:
            bins.remove(b)
    return out


@pytest.mark.parametrize("seed", range(8))
def test_best_fit_equals_plain_version(seed):
    rng = random.Random(seed)
    capacity, most = rng.choice([(10, 1), (64, 3), (1024, 20)])
    lengths = [rng.randint(1, capacity) if rng.random() < 0.7 else rng.randint(1, 1 + capacity // 8) for _ in range(800)]
    bins = O.BestFit(capacity, most)
    assert [bins.place(n) for n in lengths] == plain(lengths, capacity, most)
    assert bins.open <= most


def test_cuts():
    assert O.cuts(1, 4) == [(0, 1)] and O.cuts(4, 4) == [(0, 4)]
    assert O.cuts(9, 4) == [(0, 1), (1, 4), (5, 4)] and O.cuts(8, 4) == [(0, 4), (4, 4)]


def check(rows, got, end=O.END_ID):
    tok = Tokenizer.from_file(TOKENIZER)
    want = []
    for i, text in rows:
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, end]
        for k, (a, n) in enumerate(O.cuts(len(ids), O.LENGTH)):
            want.append((i, k, a, n, zlib.crc32(np.array(ids[a:a + n], "<u4").tobytes())))
    assert sorted(want, key=str) == sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str)
    fill = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == fill.get(r.sequence_id, 0)
        fill[r.sequence_id] = r.offset + r.length
    assert max(fill.values(), default=0) <= O.LENGTH
    return len(fill), -(-sum(x[3] for x in want) // O.LENGTH)


def test_every_id_once(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice("a bb größer 日本 x1 .".split()) for _ in range(rng.randrange(900)))) for i in range(60)]
    rows += [(None, None), (None, "null id"), (1, rows[1][1]), (1, "other"), (70, ""), (71, "w " * 30_000), (72, "<|endoftext|>")]
    df = spark.createDataFrame([(i, t, 0, "x") for i, t in rows], "doc_id long, text string, piece int, offset string")
    out = O.pack_online(df, TOKENIZER)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    check(rows, out.collect())
    check(rows, O.pack_online(df.coalesce(1), TOKENIZER, open_sequences=1).collect())
    assert O.pack_online(df.limit(0), TOKENIZER).count() == 0


def test_query_packs_the_whole_table_closely(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()]
    got = QUERIES["op13_online_packing"](spark, SF0001)
    rows = got.collect()
    used, least = check(docs, rows)
    assert used <= 1.1 * least + 1
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, rows), key=str)
