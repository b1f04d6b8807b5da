"""Quotation linking against a plain Python version."""

import random
import re

from pyspark.sql import functions as F

from relkit.llm import quotes as Q


def norm(t):
    return re.sub(r"[\W_]+", " ", t.lower()).strip()


def own_words(text):
    lines = (text or "").split("\n")
    quoted = [bool(re.match(r"[ \t]*>", x)) for x in lines]
    kept = [x for i, x in enumerate(lines) if not quoted[i] and not (
        re.match(r"(?i)^\s*on\b.*\bwrote:\s*$", x) and i + 1 < len(lines) and quoted[i + 1])]
    if ">" not in (text or ""):
        return text or ""
    while kept and not kept[0].strip(" \t"):
        kept.pop(0)
    while kept and not kept[-1].strip(" \t"):
        kept.pop()
    return "\n".join(kept)


def expected(rows):
    out = []
    info = {}
    for c, t, _, text in rows:
        blocks, last = [], None
        for i, x in enumerate((text or "").split("\n")):
            m = re.match(r"((?:[ \t]*>)+)", x)
            level = m.group().count(">") if m else 0
            if level:
                if last == (level, i - 1):
                    blocks[-1][2].append(x[m.end():])
                else:
                    blocks.append((level, i, [x[m.end():]]))
                last = (level, i)
        found = []
        for level, i, ls in blocks:
            for by_line, w in [(0, norm("\n".join(ls)))] + [(1, norm(x)) for x in ls]:
                said = [t2 for c2, t2, _, text2 in rows if c2 == c and w and w in
                        {norm(own_words(text2)), *map(norm, re.split(r"\n[ \t]*\n", own_words(text2))),
                         *map(norm, own_words(text2).split("\n"))}]
                if said and min(said) < t:
                    found.append((by_line, level, i, min(said)))
        info[c, t] = (len(blocks), len({x[1:3] for x in found}), min(found)[3] if found else None)
    for c, t, role, text in rows:
        depth, top = 0, t
        while info[c, top][2] is not None:
            top, depth = info[c, top][2], depth + 1
        out.append((c, t, own_words(text), *info[c, t], top, depth))
    order = {}
    for r in sorted(out, key=lambda r: (r[0], r[6], r[7], r[1])):
        order[r[0]] = order.get(r[0], 0) + 1
        r += (order[r[0]],)
        yield r


def test_matches_plain_version(spark):
    rng = random.Random(5)
    rows = []
    for c in range(6):
        texts = []
        for t in range(12):
            own = "\n".join(" ".join(rng.choice(["Alpha", "beta,", "gamma", "delta!"]) + str(rng.randrange(40))
                                     for _ in range(4)) for _ in range(rng.randrange(1, 4)))
            text = own
            if texts and rng.random() < 0.7:
                src = rng.choice(texts)
                part = src if rng.random() < 0.5 else rng.choice(src.split("\n"))
                text = "On Monday somebody wrote:\n" * (rng.random() < 0.5) + \
                    "\n".join("> " + x.upper() for x in part.split("\n")) + "\n\n" + own
            texts.append(text)
            rows.append((c, t, "user", text))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("at", F.lit(1))
    got = sorted(tuple(r) for r in Q.link_quotes(df).select(
        "conv_id", "turn", "text", "n_quotes", "n_linked", "reply_to", "thread", "depth", "position").collect())
    want = sorted(expected(rows))
    assert got == want
    assert sum(r[5] is not None for r in want) > 20 and max(r[3] for r in want) > 0


def test_nulls_repeats_and_empty_tables(spark):
    rows = [(1, 0, "user", "Hello there"), (1, 1, None, "> hello there\nYes"), (1, 1, None, "> hello there\nYes"),
            (None, 0, "user", "> hello there"), (1, None, "user", "> hello there"), (2, 0, "user", None), (2, 1, "user", ">>")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = Q.chat_lines(Q.link_quotes(df)).collect()
    assert len(got) == len(rows)
    assert sorted((r.turn, r.position) for r in got if r.conv_id == 1 and r.reply_to == 0) == [(1, 3), (1, 4)]
    assert {r.text for r in got if r.conv_id == 2} == {""}
    assert Q.link_quotes(df.limit(0)).count() == 0
    plan = Q.link_quotes(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
