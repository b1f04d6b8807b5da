"""BagMinHash signatures, and near-duplicate groups against all pairs."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from relkit.llm import bagminhash as B
from relkit.llm import components as C


def similarity(a, b):
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(1)
    m, z = 1000, []
    for _ in range(60):
        names = rng.integers(0, 1 << 63, 60, dtype=np.int64).astype(np.uint64)
        wa, wb = rng.integers(0, 9, 60), rng.integers(0, 9, 60)
        wb = np.where(rng.random(60) < 0.6, wa, wb)
        bags = [np.sort(np.repeat(names, w)) for w in (wa, wb)]
        j = np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum()
        assert abs(B.overlap(*[B.as_set(x).tobytes() for x in bags]) - j) < 1e-12
        s = B.signatures(bags, m)
        z.append(((s[0] == s[1]).mean() - j) / np.sqrt(j * (1 - j) / m))
    assert abs(np.mean(z)) < 0.6 and 0.6 < np.std(z) < 1.4


def test_signatures_do_not_depend_on_the_batch():
    rng = np.random.default_rng(2)
    bags = [np.sort(rng.integers(0, 50, n).astype(np.uint64)) for n in (0, 1, 3, 200, 5000, 7)]
    together = B.signatures(bags, 125)
    assert (together[1:] != 0).all() and not together[0].any()
    for k, bag in enumerate(bags):
        assert (B.signatures([bag], 125)[0] == together[k]).all()


def test_common_names_in_slices(monkeypatch):
    monkeypatch.setattr(B, "_NAMES", 7)
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, n).astype(np.uint32)) for n in (0, 5, 40, 60, 1, 33)]
    got = B.common_names(sets[:3], sets)
    assert (got == [[len(np.intersect1d(x, y)) for y in sets] for x in sets[:3]]).all()


def bag(text):
    w = (text or "").lower().split()
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def brute(rows):
    """Groups of (id, text) by all pairs; equal word lists are linked too."""
    own = [(i, bag(t), (t or "").lower().split()) for i, t in rows if i is not None]
    up = {i: i for i, _, _ in own}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, (i, a, wa) in enumerate(own):
        for j, b, wb in own[:k]:
            if wa == wb or (a and b and similarity(a, b) >= 0.8):
                x, y = sorted((top(i), top(j)))
                up[y] = x
    return {i: top(i) for i, _, _ in own}


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_match_all_pairs(spark, seed, monkeypatch):
    monkeypatch.setattr(B, "BLOCK", 16)
    monkeypatch.setattr(B, "PIECE", 20)
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = []
    for d in range(10):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 8, 60, 150]))]
        for _ in range(rng.choice([1, 3, 25])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((len(rows) * 3, "  ".join(copy).upper() if rng.random() < 0.3 else " ".join(copy)))
    rows += [(900, ""), (901, None), (902, "the " * 400), (903, "the " * 380), (904, "the " * 100), (905, "x y")]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"id": F.lit("clash"), "rep": F.lit(1)})
    got = {r.doc_id: r.group_id for r in B.near_duplicates(df).collect()}
    assert got == brute(rows)


def judged(df):
    return sorted(((r.doc_id or -1), (r.group_id or -1), r.kept) for r in B.near_duplicates(df).collect())


def left(df):
    return sorted(((r.doc_id or -1), r.text or "") for r in B.keep_one(df).collect())


def test_nulls_repeats_and_empty_tables(spark):
    text, alone = (" ".join(f"{c}{i}" for i in range(50)) for c in "wn")
    rows = [(None, text, "a"), (None, text, "b"), (5, text, "c"), (5, text, "d"), (9, text + " more", None), (7, None, "e"),
            (None, alone, "f"), (None, alone, "g"), (None, alone + " more", "h")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert judged(df) == sorted([(-1, 5, False), (-1, 5, False), (5, 5, True), (5, 5, True), (7, 7, True), (9, 5, False),
                                 *[(-1, -1, k) for k in B_kept(alone)]])
    out = B.keep_one(df)
    assert out.columns == df.columns
    got = left(df)
    assert got[:1] == [(-1, got[0][1])] and got[0][1] in (alone, alone + " more") and got[1:] == [(5, text), (7, "")]
    assert B.near_duplicates(df.limit(0)).count() == 0 and B.keep_one(df.limit(0)).count() == 0


def B_kept(alone):
    """Of texts without an id the one with the smallest name is kept, with its copies."""
    return [True, True, False] if B._key(alone.split()) < B._key((alone + " more").split()) else [False, False, True]


def test_an_id_with_two_texts_leaves_a_document_of_each_group(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(50)) for c in "ab")
    rows = [(3, a, "x"), (7, a, "x"), (7, b, "x"), (8, b + " more", "x"), (9, b, "x"), (None, a, "n")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert left(df) == [(3, a), (7, b)]
    rows = [(7, a), (7, b), (8, a + " more"), (9, b)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert left(df) == [(7, a), (7, b)]
    assert judged(df) == [(7, 7, True), (7, 7, True), (8, 7, False), (9, 7, False)]


def test_a_large_group_is_copied_in_proportion(spark):
    """Rows that meet in the blocks grow with the group, not with its square."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(80)]
    rows = [(i, " ".join([*base[:79 - i % 3], f"x{i}"])) for i in range(1500)]
    rows += [(5000 + i, " ".join(rng.choice(base) for _ in range(80))) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.group_id for r in B.near_duplicates(df).collect()}
    assert all(got[i] == 0 for i in range(1500)) and all(got[i] == i for i in got if i >= 5000)


def test_very_long_texts(spark):
    words = [f"w{i % 7919}" for i in range(300_000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:290_000])), (3, " ".join(words[:100_000])), (4, "short text")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert judged(df) == [(1, 1, True), (2, 1, False), (3, 3, True), (4, 4, True)]


def test_components_of_chains_and_hubs(spark, monkeypatch):
    monkeypatch.setattr(C, "parts_for", lambda spark, rows: 8)
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(400)] + [(1000, 1000 + i) for i in range(1, 500)] + [(3000 - i, 3000) for i in range(1, 200)]
    links += [(rng.randrange(5000, 5400), rng.randrange(5000, 5400)) for _ in range(300)] + [(7, 7), (None, 3)]
    rng.shuffle(links)
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in links:
        if None not in (a, b) and a != b:
            x, y = sorted((top(a), top(b)))
            up[y] = x
    want = sorted((x, top(x)) for x in list(up))
    df = spark.createDataFrame(links, "a long, b long").repartition(8)
    assert sorted(map(tuple, C.components(df).collect())) == want
    assert sorted(map(tuple, C.components(df, native=True).collect())) == want
    assert C.components(df.limit(0)).count() == 0


def test_few_shingles_are_drawn_together(monkeypatch):
    import pyarrow as pa
    sizes, signatures = [], B.signatures
    monkeypatch.setattr(B, "signatures", lambda bags, m: sizes.append(sum(map(len, bags))) or signatures(bags, m))
    texts = [" ".join(f"w{(k * 7919 + j * j) % 5003}" for j in range(1000)) for k in range(250)]
    batch = pa.RecordBatch.from_pydict({"id": list(range(250)), "text": texts})
    got = pa.Table.from_batches(B._signed(B.BANDS, B.ROWS, B.WORDS)([batch])).to_pydict()
    assert sum(sizes) == 250 * 996 and max(sizes) <= 101_000
    alone = pa.Table.from_batches(B._signed(B.BANDS, B.ROWS, B.WORDS)([batch.slice(120, 1)])).to_pydict()
    assert {n: v[120] for n, v in got.items()} == {n: v[0] for n, v in alone.items()}
