"""Spelling variants: a relational frontier walked down tries of all words.

The words that occur often enough form a trie, kept as a table of edges:
a level, a node (its prefix), the edge's letter, a letter that can follow,
and the lengths of the words below both (bits of a long).  The frontier
holds states (word, position, node, edits), the position told by the node
and the neighbour's wanted length.  Level by level it is joined with the
edges of that level, on the node and the letter after next; no level's
number is in the plan, so one generated code serves them all.  A state without edits
stands on the word's own prefix; it spends its edit on another letter
(replace) or on skipping a letter of the word (delete).  A state whose
edit is spent follows the word's next letters, and if it ends on a word,
the two are neighbours.  An edge is followed only if the letter after next
fits and a word of the wanted length lies below.  Insertions are the
deletions seen from the other word, and a replacement is followed only
towards the smaller letter.

Edits are spent in the second half of a word only.  Those in the first
half are found in a second trie, of the reversed words, in the same joins.
So no state branches near a root, where nodes have the most edges.

A node has at most as many edges with one letter after next as the
alphabet has letters, so a join never multiplies a hot prefix by itself;
the states of a hot prefix are split by adaptive execution, and a level
with few edges is broadcast behind a count.  Walked are words of at most ``depth`` letters.  Words of
that length or more meet through the names of their texts without one
letter (hashes of prefixes and suffixes, so work is linear in the
letters), and every meeting is verified on the letters; so runs of any
length are compared.

Defined results: a null text has no words, and in a document with a null
id no letter is deleted.  Rows that repeat an id are texts of their own.
Ties between near words of one count go to the smallest in code-point
order.  An empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relkit.llm.common import parts_for, pinned, released, remove_folder, slices
from relkit.session import ensure_checkpoint_dir

LETTERS = "A-Za-zÀ-ÿ"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MODULUS = 97
LEAST_LENGTH = 5
LEAST_COUNT = 3
RATIO = 2
DEPTH = 40                            # letters; word lengths are bits of a long, so at most 62
BROADCAST_EDGES = 20_000              # of a level, of about 40 bytes each
#: A prime and a base for names of long words.
PRIME = (1 << 127) - 1
BASE = 0x2545F4914F6CDD1D2545F4914F6CDD1D

EDGES = "level int, d int, node string, letter string, next string, lengths bigint"
STARTS = "level int, d int, word string, node string, wanted int, edits int"


def words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH,
          least_count: int = LEAST_COUNT, modulus: int = MODULUS) -> DataFrame:
    """word, n: the runs of letters after their seeded deletions, with
    their numbers of occurrences.  Runs below the least length become no
    words and are left out at once."""
    found = F.regexp_extract_all(F.col(text_col), F.lit(f"[{LETTERS}]{{{least_length},}}"), F.lit(0))
    runs = docs.select(F.col(id_col).cast("string").alias("id"), F.explode(found).alias("run"))
    runs = runs.withColumn("run", F.translate("run", UPPER, UPPER.lower()))
    runs = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    run, at = F.col("run"), F.pmod(F.col("h"), F.length("run")).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    word = F.when(F.col("h") % modulus == 0, cut).otherwise(run)
    return (runs.select(word.alias("word")).where(F.length("word") >= least_length)
                .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count))


def _bit(n: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), n.cast("int"))


def _letter(word: str | Column, position: Column) -> Column:
    """The letter at a position from 0; empty after the end."""
    return F.substring(word, position + 1, F.lit(1))


def _trie(both: DataFrame, lowest: int, parts: int) -> tuple[str, dict[int, int]]:
    """The folder of the edges, by level, and their number at each level."""
    folder = f"{ensure_checkpoint_dir(both.sparkSession)}/trie-{uuid.uuid4().hex}"
    level, word = F.col("level"), F.col("word")
    edges = (both.withColumn("level", F.explode(F.sequence(F.lit(lowest), F.length("word"))))
                 .groupBy("level", "d", F.substring(word, F.lit(1), level).alias("node"),
                          _letter(word, level).alias("letter"), _letter(word, level + 1).alias("next"))
                 .agg(F.bit_or(_bit(F.length("word"))).alias("lengths")))
    edges.coalesce(parts).write.partitionBy("level").parquet(folder)
    sizes = both.sparkSession.read.schema(EDGES).parquet(folder).groupBy("level").agg(F.count(F.lit(1)).alias("n"))
    return folder, {r.level: r.n for r in sizes.collect()}            # a row per level


def _starts(both: DataFrame, parts: int) -> str:
    """The folder of the states that leave a word's own prefix, by level:
    ``wanted`` is the length of the neighbours looked for, which tells a
    state's position in its word from the length of its node."""
    level, word, n = F.col("level"), F.col("word"), F.length("word")
    folder = f"{ensure_checkpoint_dir(both.sparkSession)}/starts-{uuid.uuid4().hex}"
    # Of equal letters in a row the first one may be skipped.
    skips = (level == F.col("start")) | (_letter(word, level) != _letter(word, level - 1))
    replace = F.struct(n.alias("wanted"), F.lit(0).alias("edits"))
    skip = F.struct((n - 1).alias("wanted"), F.lit(1).alias("edits"))
    states = (both.where(F.col("start") < n).withColumn("level", F.explode(F.sequence(F.col("start"), n - 1)))
                  .select("level", "d", "word", F.substring(word, F.lit(1), level).alias("node"),
                          F.explode(F.when(skips, F.array(replace, skip)).otherwise(F.array(replace))).alias("s"))
                  .select("level", "d", "word", "node", "s.wanted", "s.edits"))
    states.coalesce(parts).write.partitionBy("level").parquet(folder)
    return folder


def _trie_pairs(short: DataFrame, n_words: int, lowest: int) -> DataFrame:
    """a, b: words at one edit, a the longer one, or the greater one of one
    length."""
    spark = short.sparkSession
    parts = parts_for(spark, 8 * n_words)
    half = F.floor(F.length("word") / 2).cast("int")
    both = pinned(short.select(F.lit(0).alias("d"), "word", half.alias("start")).unionByName(
        short.select(F.lit(1).alias("d"), F.reverse("word").alias("word"), (F.length("word") - half).alias("start"))))
    folder, sizes = _trie(both, lowest, parts)
    trie = spark.read.schema(EDGES).parquet(folder)
    started = _starts(both, parts)
    starts = spark.read.schema(STARTS).parquet(started)
    letter, end = F.col("letter"), F.col("letter") == ""
    frontier, ends = None, []
    for level in sorted(sizes):
        states = starts.where(F.col("level") == level).drop("level")
        if frontier is not None:
            states = states.unionByName(frontier.where("not at_end").select("d", "word", "node", "wanted", F.lit(1).alias("edits")))
        edges = trie.where(F.col("level") == level).drop("level")
        if sizes[level] <= BROADCAST_EDGES:
            edges = F.broadcast(edges)
        position = F.length("node") + F.length("word") - F.col("wanted")
        states = states.withColumns({"own": _letter("word", position), "next": _letter("word", position + 1)})
        taken = (letter == F.col("own")) & (F.col("edits") == 1) | (letter < F.col("own")) & ~end & (F.col("edits") == 0)
        below = F.col("lengths").bitwiseAND(_bit(F.col("wanted"))) != 0
        frontier = pinned(states.join(edges, ["d", "node", "next"]).where(taken & below).select(
            "d", "word", F.concat("node", "letter").alias("node"), "wanted", end.alias("at_end")).coalesce(parts))
        ends.append(frontier)
    forth = lambda c: F.when(F.col("d") == 1, F.reverse(c)).otherwise(F.col(c))
    found = short.select(F.col("word").alias("a"), F.col("word").alias("b")).where("false")
    for end in ends:
        found = found.unionByName(end.where("at_end").select(forth("word").alias("a"), forth("node").alias("b")))
    found = pinned(found.distinct())
    released(both, *ends)
    remove_folder(spark, folder)
    remove_folder(spark, started)
    return found


def _names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(whole, at, name, word): a word's name and that of its text without
    the letter at a place; at -1 its own name, with the word."""
    def told(whole: str, rows: list[tuple]) -> pa.RecordBatch:
        at, name, word = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array([whole] * len(rows)), pa.array(at, pa.int32()), pa.array(name),
                                           pa.array(word, pa.string())], ["whole", "at", "name", "word"])

    for batch in slices(batches, 16):
        for word in batch.column("word").to_pylist():
            n, suffix, power = len(word), [0], [1]            # by number of letters
            for c in reversed(word):
                suffix.append((ord(c) * power[-1] + suffix[-1]) % PRIME)
                power.append(power[-1] * BASE % PRIME)
            whole = format(suffix[n], "x")
            rows, before = [(-1, whole, word)], 0
            for i, c in enumerate(word):
                rest = n - 1 - i
                rows.append((i, format((before * power[rest] + suffix[rest]) % PRIME, "x"), None))
                before = (before * BASE + ord(c)) % PRIME
                if len(rows) >= 50_000:
                    yield told(whole, rows)
                    rows = []
            if rows:
                yield told(whole, rows)


def _long_pairs(long: DataFrame) -> DataFrame:
    """a, b as of the trie, for words of any length.  Texts
    that differ in one place have one name without it: at most as many as
    the alphabet has letters."""
    named = pinned(long.select("word").mapInArrow(_names, "whole string, at int, name string, word string"))
    wholes = named.where("at = -1").select("whole", "word")
    less = named.where("at >= 0").select(F.col("whole").alias("a"), "at", "name")
    shorter = less.join(wholes.select(F.col("whole").alias("b")), F.col("name") == F.col("b")).select("a", "b", "at")
    other = less.select(F.col("a").alias("b"), "at", "name")
    replaced = less.join(other, ["name", "at"]).where("a > b").select("a", "b", "at")
    met = (shorter.unionByName(replaced)
                  .join(wholes.select(F.col("whole").alias("a"), F.col("word").alias("x")), "a")
                  .join(wholes.select(F.col("whole").alias("b"), F.col("word").alias("y")), "b"))
    x, y, at = F.col("x"), F.col("y"), F.col("at")
    tail = lambda c, k: F.substring(c, k + 1, F.length(c))
    same = (F.substring(x, F.lit(1), at) == F.substring(y, F.lit(1), at)) & (
        tail(x, at + 1) == tail(y, F.when(F.length(x) == F.length(y), at + 1).otherwise(at)))
    level = F.length(x) == F.length(y)                  # as in the trie, a is then the greater one
    pairs = pinned(met.where(same & (x != y)).select(F.when(level, F.greatest(x, y)).otherwise(x).alias("a"),
                                                    F.when(level, F.least(x, y)).otherwise(y).alias("b")).distinct())
    released(named)
    return pairs


def _roots(forms: DataFrame) -> DataFrame:
    """word, root: the last of a word's forms, by doubling the steps.  Every
    form is at least RATIO times as frequent, so chains are short and end."""
    now = pinned(forms.select("word", F.col("form").alias("root")))
    while True:
        far = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = pinned(now.join(far, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                          F.col("further").isNotNull().alias("moved")))
        done = not step.where("moved").limit(1).count()
        released(now)
        now = step
        if done:
            return now.select("word", "root")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH,
             least_count: int = LEAST_COUNT, modulus: int = MODULUS, ratio: int = RATIO, depth: int = DEPTH) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    if not 1 <= least_length <= depth <= 60:
        raise ValueError("depth is from the least length to 60")
    counted = pinned(words(docs, id_col, text_col, least_length, least_count, modulus))
    size = counted.agg(F.count(F.lit(1)).alias("n"), F.max(F.length("word")).alias("longest")).first()
    counted = counted.coalesce(parts_for(docs.sparkSession, size.n))
    pairs = _trie_pairs(counted.where(F.length("word") <= depth).select("word"), size.n, least_length // 2)
    if (size.longest or 0) >= depth:
        pairs = pairs.unionByName(_long_pairs(counted.where(F.length("word") >= depth))).distinct()
    links = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = counted.select(F.col("word").alias("b"), F.col("n").alias("near_n"))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("b").alias("near")))
    met = links.join(near, "b").groupBy(F.col("a").alias("word")).agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    is_form = -F.col("best.less") >= ratio * F.col("n")
    told = pinned(counted.join(met, "word", "left").select(
        "word", F.when(is_form, F.col("best.near")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), F.when(is_form, -F.col("best.less")).alias("form_n")))
    roots = _roots(told.where("form is not null"))
    return told.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
