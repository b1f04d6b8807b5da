"""Spelling variants against a plain version that compares all words."""

import random
import re
import zlib
from collections import Counter

import pytest

from conftest import SF0001
from relkit.llm import spelling_trie as S
from relkit.llm.queries import QUERIES


def plain_words(rows, least_length=5, least_count=3):
    seen = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{i}:{run}".encode())
            if i is not None and h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            seen[run] += 1
    return {w: n for w, n in seen.items() if len(w) >= least_length and n >= least_count}


def near(a, b):
    if len(a) < len(b):
        a, b = b, a
    if a == b or len(a) - len(b) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def plain(rows, **options):
    n = plain_words(rows, **options)
    mates = {w: [] for w in n}
    names = sorted(n)
    for i, a in enumerate(names):
        for b in names[i + 1:]:
            if abs(len(a) - len(b)) <= 1 and near(a, b):
                mates[a].append(b)
                mates[b].append(a)
    form = {}
    for w in names:
        best = min(mates[w], key=lambda m: (-n[m], m), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in names:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(mates[w]), n.get(form[w])))
    return sorted(out, key=str)


def got(spark, rows, schema="doc_id long, text string", **options):
    return sorted(map(tuple, S.variants(spark.createDataFrame(rows, schema), **options).collect()), key=str)


def made(seed, n, letters="abé", longest=9):
    rng = random.Random(seed)
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(3, longest))) for _ in range(n)]
    for w in base[: n // 2]:
        at = rng.randrange(len(w))
        base.append(w[:at] + rng.choice(letters) * rng.randrange(3) + w[at + 1:])
    texts = []
    for i in range(60):
        words = rng.choices(base, k=40)
        texts.append((i, rng.choice([" ", "\n", ", ", "7"]).join(w.upper() if rng.random() < 0.2 else w for w in words)))
    return texts


@pytest.mark.parametrize("seed,letters", [(1, "ab"), (2, "abé"), (3, "abcdefghijß÷")])
def test_equals_plain_version(spark, seed, letters):
    rows = made(seed, 120, letters)
    want = plain(rows)
    assert sum(r[4] for r in want) > 0 and any(r[1] for r in want)
    assert got(spark, rows) == want


def test_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(S, "BROADCAST_EDGES", -1)
    rows = made(4, 100)
    assert got(spark, rows) == plain(rows)


def test_long_words(spark):
    rng = random.Random(7)
    base = "".join(rng.choice("abcxyz") for _ in range(60))
    more = {base[:38], base[:39], base[:40], base[:41], base[:42], base, base[:-1], base[1:], base[:20] + "q" + base[21:],
            base[:20] + "r" + base[21:], "q" + base[1:39], "q" + base[1:40], base[:10] + base[11:41], "a" * 50, "a" * 51, "a" * 52,
            base[:30] + "w" + base[30:], "z" * 3000, "z" * 1500 + "y" + "z" * 1500}
    rows = [(i, " ".join(sorted(more))) for i in range(4)] + [(9, base + " " + base[:40])]
    want = plain(rows)
    assert len(want) >= len(more)
    assert got(spark, rows) == want


def test_small_depth_meets_the_long_way(spark):
    rows = made(8, 120)
    assert got(spark, rows, depth=6) == plain(rows)


def test_odd_rows(spark):
    rows = [(None, "Straße STRASSE straße"), (None, None), (1, None), (2, ""), (3, "straße Straßen straßen straßen"),
            (3, "straße"), (3, "straße"), (4, "1234 -- 5"), (5, "x" * 200_000), (6, "abcd abcd abcd ABCD")]
    assert got(spark, rows) == plain(rows)
    assert got(spark, []) == [] and got(spark, [(1, "few words")]) == []
    clash = [(i, t, "w", 1) for i, t in rows]
    assert got(spark, clash, "doc_id long, text string, word string, n int") == plain(rows)
    chain = ["aaaaa"] * 3 + ["aaaab"] * 6 + ["aaabb"] * 12 + ["aabbb"] * 24 + ["aabbc"] * 24
    assert got(spark, [(1, " ".join(chain))]) == plain([(1, " ".join(chain))])


def test_query_on_the_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()]
    out = QUERIES["op12_spelling_trie"](spark, SF0001)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, out.collect()), key=str) == plain(rows)
