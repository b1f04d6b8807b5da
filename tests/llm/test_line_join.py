"""The edit join against brute force, on lines made by small edits."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from relkit.llm import line_join as J


def distance(a, b):
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        cur = [i]
        for j, y in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (x != y)))
        prev = cur
    return prev[-1]


def edited(rng, line, n):
    for _ in range(n):
        k = rng.randrange(len(line) + 1)
        kind = rng.choice("ids")
        c = rng.choice("abé ")
        line = line[:k] + (c if kind != "d" else "") + line[k + (kind != "i"):]
    return line


def expected(docs, edits, min_chars):
    lines = [(d, i, x) for d, t in docs for i, x in enumerate((t or "").split("\n"))]
    own = sorted({x for _, _, x in lines if len(x) >= min_chars})
    links, up = Counter(), {x: x for x in own}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, a in enumerate(own):
        for b in own[:k]:
            if abs(len(a) - len(b)) <= edits and distance(a, b) <= edits:
                links[a] += 1
                links[b] += 1
                up[top(a)] = top(b)
    first, size = {}, Counter()
    for d, i, x in lines:
        if len(x) >= min_chars:
            first[top(x)] = min(first.get(top(x), (d, i)), (d, i))
            size[top(x)] += 1
    return sorted(
        (d, i, len(x), *first[top(x)], size[top(x)], links[x], (d, i) == first[top(x)])
        if len(x) >= min_chars else (d, i, len(x), d, i, 1, 0, True) for d, i, x in lines)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_matches_brute_force(spark, edits):
    rng = random.Random(edits)
    base = ["".join(rng.choice("abcdé ü") for _ in range(rng.randrange(5, 40))) for _ in range(25)]
    lines = [edited(rng, x, rng.randrange(0, 5)) for x in base for _ in range(8)] + ["", "x", "x", "a" * 30, "a" * 31]
    rng.shuffle(lines)
    docs = [(d, "\n".join(lines[d * 7:d * 7 + 7])) for d in range(len(lines) // 7)] + [(900, None), (901, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("line", F.lit("clash"))
    got = sorted(tuple(r) for r in J.link_lines(df, edits=edits, min_chars=6).collect())
    want = expected(docs, edits, 6)
    assert got == want
    assert any(r[6] for r in want)


def test_cuts_repeated_lines_and_keeps_columns(spark):
    a, b = "a line of more than twenty-four characters", "another line of more than twenty-four characters"
    docs = [(1, f"{a}\nshort\n{b}", "x"), (2, f"{a}!\nshort", None), (3, None, "y"), (4, "new and not seen before, of good length", "z")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    got = J.drop_repeated(df)
    assert got.columns == df.columns
    assert {r.doc_id: r.text for r in got.collect()} == {1: f"{a}\nshort\n{b}", 2: "short", 3: None, 4: docs[3][1]}


def test_null_ids_repeats_and_empty_tables(spark):
    line = "a line of more than twenty-four characters"
    df = spark.createDataFrame([(None, line), (5, line), (5, line), (7, line)], "doc_id long, text string")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.kept, r.group_size) for r in J.link_lines(df).collect())
    assert got == [(False, 5, True, 4), (False, 5, True, 4), (False, 7, False, 4), (True, 0, False, 4)]
    assert J.link_lines(df.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "x\ny")], "doc_id long, text string")
    plan = J.link_lines(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_short_lines_are_grouped_when_equal_and_linked_from_eight(spark):
    docs = [(1, "}\n\nReturn.\nline 100\nseven 7"), (2, "}\n\nReturn.\nline 101\nseven 8"), (3, "line 1009\n}")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r.doc_id, r.line_no): (r.group_doc, r.group_line, r.group_size, r.n_links, r.kept)
           for r in J.link_lines(df, **J.WHOLE).collect()}
    assert got[1, 0] == (1, 0, 3, 0, True) and got[2, 0] == got[3, 1] == (1, 0, 3, 0, False)
    assert got[1, 1] == (1, 1, 1, 0, True) and got[2, 1] == (2, 1, 1, 0, True)
    assert got[2, 2] == (1, 2, 2, 0, False)
    assert got[1, 3] == (1, 3, 3, 2, True) and got[2, 3] == got[3, 0] == (1, 3, 3, 2, False)
    assert got[1, 4] == (1, 4, 1, 0, True) and got[2, 4] == (2, 4, 1, 0, True)


def test_whole_join_of_short_lines_matches_brute_force(spark):
    rng = random.Random(9)
    base = ["".join(rng.choice("abcdé ü") for _ in range(rng.randrange(8, 26))) for _ in range(25)]
    lines = [edited(rng, x, rng.randrange(0, 4)) for x in base for _ in range(8)]
    docs = [(d, "\n".join(lines[d * 7:d * 7 + 7])) for d in range(len(lines) // 7)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted(tuple(r) for r in J.link_lines(df, **J.WHOLE).where("n_chars >= 8").collect())
    assert got == [r for r in expected(docs, J.EDITS, J.CLASS) if r[2] >= 8]


def test_query_drops_equal_short_lines(spark, tmp_path):
    from relkit.llm.queries import QUERIES
    df = spark.createDataFrame([(1, "}\nx"), (2, "}\ny")], "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.doc_id, r.line_no): r.kept for r in QUERIES["op5_line_join"](spark, str(tmp_path)).collect()}
    assert got == {(1, 0): True, (1, 1): True, (2, 0): False, (2, 1): True}


def test_rows_of_one_id_are_cut_by_their_own_lines(spark):
    d, u = "a line that stands in many documents", "a line that stands nowhere else at all"
    rows = [(3, d), (7, u), (7, d), (None, d), (None, d), (None, f"{u}!!!!!!!\n{d}"), (8, None)]
    got = J.drop_repeated(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(((r.doc_id or -1), r.text) for r in got.collect() if r.doc_id != 8) == sorted(
        [(3, d), (7, u), (7, ""), (-1, ""), (-1, ""), (-1, f"{u}!!!!!!!")])


def test_a_text_of_very_many_lines(spark):
    n = 150_000
    rows = [(1, "\n".join(f"{i:07d}{i * 7919 % 1000003:07d} tail" for i in range(n))), (2, "\n".join(f"{i:07d}{i * 7919 % 1000003:07d} tail" for i in range(0, n, 2)) + "\nend")]
    got = {r.doc_id: r.text for r in J.drop_repeated(spark.createDataFrame(rows, "doc_id long, text string"), min_chars=10**6, min_equal=1).collect()}
    assert got == {1: rows[0][1], 2: "end"}


def test_lines_of_a_family_with_other_words_are_not_compared(spark, monkeypatch):
    words = ["".join("aeioudnrst"[(k * m + m) % 10] for m in (1, 3, 7, 9)) for k in range(60)]
    lines = [" ".join([*words[:k], word, *words[k + 1:]]) for k, word in ((2, "ZQXW"), (10, "VKJY"), (17, "BFGH"))]
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    monkeypatch.setattr(J, "within", lambda x, y, edits: F.raise_error(F.concat(x, F.lit(" | "), y)).cast("boolean"))
    assert {r.n_links for r in J.link_lines(df).collect()} == {0}
    with pytest.raises(Exception, match="a line of more"):
        J.link_lines(spark.createDataFrame([(1, "a line of more than twenty characters"), (2, "a line of more than twenty charakters")], df.schema))


def test_each_change_flips_four_bits_at_most(spark):
    rng = random.Random(4)
    pairs = []
    for _ in range(300):
        x = "".join(rng.choice("abcdé ü") for _ in range(rng.randrange(8, 60)))
        pairs.append((x, edited(rng, x, 2)))
    df = spark.createDataFrame(pairs, "x string, y string")
    worst = df.select(F.bit_count(J._odd("x").bitwiseXOR(J._odd("y"))).alias("n")).agg(F.max("n")).first()[0]
    assert 0 < worst <= 8


def test_many_keys_are_sieved_and_joined(spark, monkeypatch):
    for name in ("BROADCAST_ROWS", "BROADCAST_WIDE_ROWS"):
        monkeypatch.setattr(J, name, 0)
    monkeypatch.setattr(J._bounded, "__defaults__", (0,))
    monkeypatch.setattr(J, "WORDS", 64)
    monkeypatch.setattr(J, "PART_WORDS", 16)
    df = spark.range(-3000, 3000).select(F.xxhash64("id").alias("h"), "id")
    got = J._found(df, df.where("id % 50 = 0").select("h"), "h")
    assert sorted(r.id for r in got.collect()) == list(range(-3000, 3000, 50))
    rng = random.Random(11)
    base = ["".join(rng.choice("abcdé ü") for _ in range(rng.randrange(8, 40))) for _ in range(20)]
    lines = [edited(rng, x, rng.randrange(0, 5)) for x in base for _ in range(6)]
    docs = [(d, "\n".join(lines[d * 5:d * 5 + 5])) for d in range(len(lines) // 5)]
    got = J.link_lines(spark.createDataFrame(docs, "doc_id long, text string"), edits=2, min_chars=6)
    assert sorted(tuple(r) for r in got.collect()) == expected(docs, 2, 6)
