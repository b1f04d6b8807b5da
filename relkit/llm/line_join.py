"""Line deduplication by a segment-partition edit join, in DataFrame
functions only.

Two lines are linked if their edit distance is at most ``edits``.  Lines
are put into classes by length, and every line of a class is cut into
``edits + 1`` segments of one length, the last at the line's end.  Of two
linked lines one segment of either stands unchanged in the other, shifted
by no more than its number, or, the last one, not at all from the end.  So
a line has ``edits + 1`` index keys (class, segment's number and text), a
few probe keys at shifted places, and the same in the class below if a
line there can be linked.  Keys that two different lines share are found
by an aggregate over 64-bit keys (combined map-side, so a line that
repeats costs one row a task); only rows with such a key are kept.  The
rest of the line beside the shared segment is then cut and keyed in the
same way, so lines that share one segment by chance do not meet; and of
eight chunks of a line, all but ``edits`` must be found again in the other,
or the pair does not leave the join.

Candidates are verified by banded bit-parallel edit distance: after the
common start and end are cut off, one bit for each diagonal of the band
and each number of edits, all moved forward together for each character.
The first characters alone drop most false candidates.

Linked and equal lines form groups (connected components); the first line
of a group, by document id and line number, is kept.  Lines shorter than
``min_chars`` are never linked, but grouped with equal lines from
``min_equal`` characters on (by default ``min_chars``); shorter ones are
always kept.

Defined results: a null text counts as empty and is one empty line.  A
line of a document with a null id is dropped if an equal or linked line
has an id, and else kept.  Rows that repeat an id with one text keep or
lose a line together; with different texts each is judged by its own
lines.  Ids are integers.  An empty table gives an empty result.  Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relkit.llm.common import parts_for, pinned
from relkit.llm.components import components

EDITS = 2
MIN_CHARS = 24
CLASS = 8                        # lengths of a class; segments are as long for all of them
WHOLE = {"min_chars": CLASS, "min_equal": 1}     # all lines but empty ones; segments hold a character from CLASS on
BROADCAST_ROWS = 1_000_000       # of one number
BROADCAST_WIDE_ROWS = 250_000    # of up to five numbers
WORDS = 1 << 21                  # of 64 bits, for keys too many for a broadcast of their own
PART_WORDS = 1 << 15             # in a row
CHUNKS = 8                       # of a line, to sort out candidates
FIRST_CHARS = 12                 # characters that sort out false candidates


def _row(id_col: str, text_col: str) -> Column:
    """The name of a row: its id and two hashes of its text."""
    return F.struct(F.col(id_col).cast("bigint").alias("id"), F.xxhash64(text_col).alias("t1"),
                    F.xxhash64(F.lit(1), F.col(text_col)).alias("t2"))


def _lines(docs: DataFrame, id_col: str, text_col: str, row: list[Column]) -> DataFrame:
    return docs.select(F.col(id_col).cast("bigint").alias("id"), *row,
                       F.posexplode(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")).alias("no", "line")) \
               .withColumn("chars", F.char_length("line"))


def _names() -> list[Column]:
    """A 128-bit name of a line."""
    return [F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line", "chars").alias("h2")]


def _base(chars: Column) -> Column:
    """Least length of a line's class; segment lengths follow from it."""
    return (F.floor(chars / CLASS) * CLASS).cast("int")


def _pieces(edits: int, start: Column, end: Column, size: Column) -> list[tuple[int, int, Column, Column]]:
    """The segments of a part that can be found after ``edits`` changes, as
    (number, shift, start, length).  One segment stays unchanged that has
    as many changes before it as its number says, so it is shifted by no
    more, and the last one, with no change after it, not from the end."""
    out = [(n, shift, start + size * n + shift, size) for n in range(edits) for shift in range(-n, n + 1)]
    return [*out, (edits, 0, end - size, size)]


def _plan(edits: int) -> list[tuple[int, int]]:
    """Number and shift of the segments, in the order of the keys."""
    zero = F.lit(0)
    return [(n, shift) for n, shift, _, _ in _pieces(edits, zero, zero, zero)]


def _keys(edits: int, min_chars: int) -> Column:
    """Keys of a line in its class and, if a line of the class below can be
    linked to it, in that one.  ``raw`` holds the bytes of a line with one
    byte a character: a place in them is found without a walk over the
    line, and equal bytes have equal hashes."""
    chars = F.col("chars")
    base = _base(chars)
    below = (chars - base < edits) & (base > min_chars // CLASS * CLASS)

    def of(text: Column, base: Column) -> Column:
        size = F.floor(base / (edits + 1)).cast("int")
        return F.array(*[F.xxhash64(base, F.lit(n), F.substring(text, at + 1, size))
                         for n, _, at, size in _pieces(edits, F.lit(0), chars, size)])

    def all_of(text: Column) -> Column:
        return F.concat(of(text, base), F.when(below, of(text, base - CLASS)).otherwise(F.array().cast("array<bigint>")))

    return F.when(F.col("raw").isNotNull(), all_of(F.col("raw"))).otherwise(all_of(F.col("line")))


def _finer(edits: int) -> Column:
    """Second keys of a row (line, chars, base, k): the rest of the line
    beside the segment k, on its longer side, holds a bounded number of
    changes as well and is cut again."""
    line, chars, base = F.col("line"), F.col("chars"), F.col("base")
    size = F.floor(base / (edits + 1)).cast("int")
    out = F.array().cast("array<struct<key2: bigint, index2: boolean>>")
    for k, (n, shift) in enumerate(_plan(edits)):
        if n < edits:                      # to the right: the changes not yet made
            left, start, end = edits - n, size * (n + 1) + shift, chars
            room = base - size * (n + 1) - edits
        else:                              # to the left of the last segment
            left, start, end, room = edits, F.lit(0), chars - size, base - size
        own = F.greatest(F.lit(0), F.floor(room / (left + 1))).cast("int")
        keys = F.array(*[F.struct(F.xxhash64(F.lit(m), F.substring(line, at + 1, length)).alias("key2"),
                                  F.lit(move == 0).alias("index2"))
                         for m, move, at, length in _pieces(left, start, end, own)])
        out = F.when(F.col("k") == k, keys).otherwise(out)
    return out


def _chunks(edits: int, probes: bool) -> Column:
    """Hashes of CHUNKS chunks of a row's line (line, base), at their places
    or at all places where a linked line can hold them."""
    line, base = F.col("line"), F.col("base")
    size = F.floor(base / CHUNKS).cast("int")
    shifts = range(-edits, edits + 1) if probes else (0,)
    return F.array_distinct(F.array(*[
        F.hash(F.lit(m), F.substring(line, F.greatest(F.lit(1), size * m + shift + 1), size))
        for m in range(CHUNKS) for shift in shifts]))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _odd(line: str) -> Column:
    """A bit for each of 64 sets of character pairs: whether the line holds
    an odd number of them.  A change takes and gives two pairs at most."""
    def bits(w: Column) -> Column:
        def flipped(bits: Column, i: Column) -> Column:
            pair = F.hash(F.get(w, i), F.get(w, i + 1)).bitwiseAND(63)
            return bits.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), pair))
        return F.aggregate(F.sequence(F.lit(0), F.size(w) - 1), F.lit(0).cast("bigint"), flipped)
    return _let(F.split(line, ""), bits)


def _common(x: Column, y: Column, part: Callable[[Column, Column, Column], Column], longest: int = 1 << 16) -> Column:
    """How far x and y have the same part, by halving steps (of longer
    common parts some)."""
    steps = F.array(*[F.lit(longest >> k) for k in range(longest.bit_length())])
    most = F.least(F.char_length(x), F.char_length(y))

    def more(at: Column, step: Column) -> Column:
        same = (at + step <= most) & (part(x, at, step) == part(y, at, step))
        return at + F.when(same, step).otherwise(0)

    return F.aggregate(steps, F.lit(0), more)


def _at_start(x: Column, at: Column, step: Column) -> Column:
    return F.substring(x, at + 1, step)


def _at_end(x: Column, at: Column, step: Column) -> Column:
    return F.substring(x, F.char_length(x) - at - step + 1, step)


def _lane(edits: int, value: int) -> int:
    return sum(value << (8 * e) for e in range(edits + 1))


def _advanced(x: Column, y: Column, edits: int, steps: Column) -> Column:
    """The band after ``steps`` characters of x: for each number of edits e
    a byte, whose bit d says that x up to here can be turned into y up to
    here + d - edits with at most e edits."""
    width = 2 * edits + 1
    every, rest = _lane(edits, (1 << width) - 1), _lane(edits, (1 << (width - 1)) - 1)
    begin = sum(sum(1 << (edits + d) for d in range(e + 1)) << (8 * e) for e in range(edits + 1))

    def step(band: Column, i: Column) -> Column:
        c = F.get(x, i)
        match = sum((F.when(F.get(y, i + (d - edits)) == c, 1 << d).otherwise(0) for d in range(width)), F.lit(0))
        same = band.bitwiseAND(match * _lane(edits, 1))
        other = F.shiftleft(band, 8).bitwiseAND(every)
        skip = F.shiftleft(F.shiftright(band, 1).bitwiseAND(rest), 8).bitwiseAND(every)
        return same.bitwiseOR(other).bitwiseOR(skip)

    def insert(band: Column) -> Column:
        return band.bitwiseOR(F.shiftleft(band.bitwiseAND(rest), 9).bitwiseAND(every))

    def moved(band: Column, i: Column) -> Column:
        out = step(band, i)
        for _ in range(edits):
            out = _let(out, insert)
        return out

    return F.aggregate(F.when(steps > 0, F.sequence(F.lit(0), steps - 1)).otherwise(F.array().cast("array<int>")),
                       F.lit(begin), moved)


def within(x: Column, y: Column, edits: int) -> Column:
    """Whether two texts are within ``edits``."""
    if not 1 <= edits <= 3:
        raise ValueError("the band has a byte for each number of edits: 1 to 3")

    def judged(p: Column) -> Column:                     # p: the characters that differ
        n, m = F.size(p["x"]), F.size(p["y"])
        alive = _advanced(p["x"], p["y"], edits, F.least(n, F.lit(FIRST_CHARS))) != 0
        end = sum((F.when(m - n == d, 1 << (d + edits + 8 * edits)).otherwise(0)
                   for d in range(-edits, edits + 1)), F.lit(0))
        full = _advanced(p["x"], p["y"], edits, n).bitwiseAND(end) != 0
        return F.when(F.abs(n - m) > edits, False).when(~alive, False).otherwise(full)

    def letters(text: Column, start: Column, end: Column) -> Column:
        middle = F.substring(text, start + 1, F.char_length(text) - start - end)
        return F.filter(F.split(middle, ""), lambda c: c != "")

    def cut(p: Column) -> Column:                        # p: x, y
        def both(n: Column) -> Column:
            rest = lambda t: F.substring(t, n + 1, F.char_length(t))
            end = _let(F.struct(rest(p["x"]).alias("x"), rest(p["y"]).alias("y")),
                       lambda q: _common(q["x"], q["y"], _at_end))
            return _let(end, lambda m: F.struct(letters(p["x"], n, m).alias("x"), letters(p["y"], n, m).alias("y")))
        return _let(_common(p["x"], p["y"], _at_start), both)

    return _let(_let(F.struct(x.alias("x"), y.alias("y")), cut), judged)


def _bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Marked for broadcast if it has few rows."""
    return F.broadcast(df) if df.count() <= rows else df


def _found(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows of ``df`` whose ``key``, a 64-bit hash, is in ``keys``.  Too
    many keys for a broadcast go as a bit each, by their last bits, in a
    broadcast of fixed size; only rows that hit one meet the keys."""
    if keys.count() <= BROADCAST_ROWS:
        return df.join(F.broadcast(keys), key, "left_semi")
    bit = F.col(key).bitwiseAND(64 * WORDS - 1)
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit.bitwiseAND(63).cast("int"))
    word = F.shiftright(bit, 6)
    words = (keys.select(word.alias("word"), one.alias("bits"))
                 .unionByName(keys.sparkSession.range(WORDS).select(F.col("id").alias("word"), F.lit(0).cast("bigint").alias("bits")))
                 .groupBy("word").agg(F.bit_or("bits").alias("bits")))
    parts = pinned(words.groupBy(F.floor(F.col("word") / PART_WORDS).cast("bigint").alias("part"))
                        .agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda w: w["bits"]).alias("words")))
    part = F.shiftright(word, PART_WORDS.bit_length() - 1)
    hit = F.get("words", word.bitwiseAND(PART_WORDS - 1).cast("int")).bitwiseAND(one) != 0
    return df.join(F.broadcast(parts), (part == F.col("part")) & hit, "left_semi").join(keys, key, "left_semi")


def link_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               edits: int = EDITS, min_chars: int = MIN_CHARS, min_equal: int | None = None) -> DataFrame:
    """One row per line: id, line_no (from 0), n_chars, group_doc and
    group_line (the first line of its group), group_size (lines), n_links
    (different lines within ``edits``) and kept."""
    return _linked(docs, id_col, text_col, edits, min_chars, min_equal, [])


def _linked(docs: DataFrame, id_col: str, text_col: str, edits: int, min_chars: int, min_equal: int | None,
            row: list[Column]) -> DataFrame:
    """``link_lines`` with further columns of each line's document."""
    lines = _lines(docs, id_col, text_col, row)
    more = lines.columns[1:-3]
    least = min_chars if min_equal is None else min(min_equal, min_chars)
    plan = _plan(edits)
    # Place in the table as one number, so that the first line is a minimum.
    place = (F.col("id").cast("decimal(20,0)") * F.lit(1 << 32).cast("decimal(11,0)") + F.col("no")).cast("decimal(38,0)")
    # One row per different line, with its keys: the texts are cut once, and
    # keys are counted and looked up without them.
    keys = F.when(F.col("chars") >= min_chars, _keys(edits, min_chars)).otherwise(F.array().cast("array<bigint>"))
    classes = pinned(lines.where(F.col("chars") >= least)
                          .withColumn("raw", F.when(F.octet_length("line") == F.col("chars"), F.col("line").cast("binary")))
                          .select(*_names(), "chars", keys.alias("keys"), place.alias("place"))
                          .groupBy("h1", "h2", "chars", "keys")
                          .agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")))
    keyed = classes.select("h1", "h2", "chars", F.posexplode("keys").alias("pos", "key"))
    k = (F.col("pos") % len(plan)).cast("int")
    index = k.isin([i for i, (_, shift) in enumerate(plan) if shift == 0])
    shared = pinned(keyed.groupBy("key").agg(F.min("h1").alias("lo"), F.max("h1").alias("hi"),
                                             F.max(index).alias("index"))
                         .where("lo != hi and index").select("key"))
    base = _base(F.col("chars")) - F.when(F.col("pos") >= len(plan), CLASS).otherwise(0)
    rows = pinned(keyed.join(_bounded(shared), "key")
                       .select("key", "h1", "h2", k.alias("k"), base.alias("base"), index.alias("index")))
    wanted = pinned(rows.select("h1").distinct())
    named = _found(lines.where(F.col("chars") >= min_chars).select("line", "chars", *_names()), wanted, "h1")
    texts = pinned(named.groupBy("h1", "h2").agg(F.first("line").alias("line"), F.first("chars").alias("chars")))
    texts = pinned(texts.select("h1", "h2", "line", "chars", _odd("line").alias("odd"),
                                F.monotonically_increasing_id().alias("lid")))
    parts = parts_for(docs.sparkSession, rows.count())
    rows = rows.join(texts, ["h1", "h2"])
    sieve = pinned(rows.select("lid", "base", "line", "chars", "odd").dropDuplicates(["lid", "base"])
                       .select("lid", "base", "line", "chars", "odd", _chunks(edits, False).alias("own"),
                               _chunks(edits, True).alias("places")))
    fine = (rows.select("key", "base", "index", "lid", F.explode(_finer(edits)).alias("f"))
                .select("key", "f.key2", "base", (F.col("index") & F.col("f.index2")).alias("index"), "lid")
                .groupBy("key", "key2", "base", "lid").agg(F.max("index").alias("index")))
    at = pinned(fine.coalesce(parts))
    a = (at.where("index").join(sieve.drop("places"), ["lid", "base"])
           .select("key", "key2", F.col("lid").alias("a"), F.col("chars").alias("ca"), F.col("line").alias("x"),
                   F.col("odd").alias("odd_a"), "own"))
    b = (at.join(sieve.drop("own"), ["lid", "base"])
           .select("key", "key2", "index", F.col("lid").alias("b"), F.col("chars").alias("cb"),
                   F.col("line").alias("y"),
                   F.col("odd").alias("odd_b"), "places"))
    # Two index rows meet once; each change spoils one chunk and flips four
    # bits at most.  Lines of a family that differ in words meet in numbers
    # that grow with its square, so the cheapest test is first.  The edit
    # distance is taken inside the join, so only links leave it.
    once = (F.col("a") < F.col("b")) | ((F.col("a") != F.col("b")) & ~F.col("index"))
    near = (F.abs(F.col("ca") - F.col("cb")) <= edits) & (F.bit_count(F.col("odd_a").bitwiseXOR(F.col("odd_b"))) <= 4 * edits)
    kept = F.size(F.array_intersect("own", "places")) >= F.size("own") - edits
    met = a.join(b, (a["key"] == b["key"]) & (a["key2"] == b["key2"]) & once & near & kept
                 & within(F.col("x"), F.col("y"), edits))
    links = pinned(met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    n_links = (links.select(F.explode(F.array("a", "b")).alias("lid")).groupBy("lid")
                    .agg(F.count(F.lit(1)).alias("n_links")))
    roots = components(links, native=True)
    near = _bounded(pinned(texts.select("h1", "h2", "lid").join(n_links, "lid")
                                .join(roots.withColumnRenamed("node", "lid"), "lid").drop("lid")),
                    BROADCAST_WIDE_ROWS)
    linked = pinned(classes.select("h1", "h2", "first", "n").join(near, ["h1", "h2"]))
    groups = linked.groupBy("root").agg(F.min("first").alias("first"), F.sum("n").alias("group_size"))
    # Only lines that repeat or are linked need their group looked up.
    again = (classes.where("n > 1").select("h1", "h2", "first", F.col("n").alias("group_size"), F.lit(0).cast("bigint").alias("n_links"))
                    .join(_bounded(linked.select("h1", "h2"), BROADCAST_WIDE_ROWS), ["h1", "h2"], "left_anti"))
    many = _bounded(pinned(linked.drop("first", "n").join(groups, "root")
                                 .select("h1", "h2", "first", "group_size", "n_links").unionByName(again)), BROADCAST_WIDE_ROWS)
    occur = lines.where(F.col("chars") >= least).select("id", *more, "no", "chars", *_names(), place.alias("place"))
    found = occur.join(many, ["h1", "h2"], "left")
    first = F.coalesce("first", "place")
    doc = F.floor(first / F.lit(1 << 32)).cast("bigint")
    rows_ = found.select(F.col("id").alias(id_col), F.col("no").cast("bigint").alias("line_no"),
                         F.col("chars").cast("bigint").alias("n_chars"), doc.alias("group_doc"),
                         (first - doc.cast("decimal(20,0)") * F.lit(1 << 32).cast("decimal(11,0)"))
                         .cast("bigint").alias("group_line"),
                         F.coalesce("group_size", F.lit(1)).alias("group_size"),
                         F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                         F.col("place").eqNullSafe(first).alias("kept"), *more)
    alone = lines.where(F.col("chars") < least).select(
        F.col("id").alias(id_col), F.col("no").cast("bigint").alias("line_no"),
        F.col("chars").cast("bigint").alias("n_chars"), F.col("id").alias("group_doc"),
        F.col("no").cast("bigint").alias("group_line"), F.lit(1).cast("bigint").alias("group_size"),
        F.lit(0).cast("bigint").alias("n_links"), F.lit(True).alias("kept"), *more)
    return rows_.unionByName(alone)


def drop_repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  edits: int = EDITS, min_chars: int = MIN_CHARS, min_equal: int | None = None) -> DataFrame:
    """``docs`` with the lines that are not kept cut out of their texts; all
    columns stay.  A text that loses no line is unchanged, also if null.
    What is cut is collected for each text, so it is bounded by the text."""
    row = _row(id_col, text_col)
    gone = (_linked(docs, id_col, text_col, edits, min_chars, min_equal, [row.alias("_row")]).where("not kept")
            .groupBy("_row").agg(F.collect_set("line_no").alias("_gone")))
    joined = docs.withColumn("_row", row).join(pinned(gone), "_row", "left")
    parts = joined.withColumn("_lines", F.when(F.col("_gone").isNotNull(), F.split(F.col(text_col), "\n")))
    # By hashing, so linear in the lines of a long text.
    stay = F.array_except(F.sequence(F.lit(0).cast("bigint"), F.size("_lines").cast("bigint") - 1), "_gone")
    left = F.transform(stay, lambda i: F.get("_lines", i.cast("int")))
    return parts.withColumn(text_col, F.when(F.col("_gone").isNull(), F.col(text_col))
                                       .otherwise(F.array_join(left, "\n"))).select(*docs.columns)
