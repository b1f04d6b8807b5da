"""Quotation linking: conversations in reply order, without quotes, in
DataFrame functions only.

A line that begins with ``>`` marks is quoted; the number of marks is its
level.  Neighbouring lines of one level form a quoted passage.  Passages
(and their single lines) are normalised to lower-case words and hashed to
128 bits; so are the own words of every message: the whole, its paragraphs
and its lines.  A passage belongs to the first message of its conversation
that said it, which must come before the quoting one.  The message with
the shallowest linked passage (ties: the first one) is the one replied to;
whole passages go before single lines.

Own words that are said again and again cost one row a task (the first
turn is a minimum, combined map-side), so no pairs of equal messages
arise.  Threads are found by pointer jumping over the reply links alone.
Messages are numbered in reply order by a running count that does not
gather a conversation in one task.

Reply order: by the first message of the thread, then by depth in the
thread, then by turn; so a message always follows the one it replies to.

Defined results: a null text counts as empty.  Messages with a null
conversation or turn link with nothing; those of the null conversation are
numbered together, null turns first.  A passage without letters or digits
is not linked.  Repeated rows give repeated results, numbered one after
the other.  An empty table gives an empty result.  Other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relkit.llm.common import pinned
from relkit.operators.scan import running_sum

QUOTED = r"^[ \t]*>"
MARKS = r"^((?:[ \t]*>)+)"
ATTRIBUTION = r"(?i)^\s*on\b.*\bwrote:\s*$"


def _norm(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def _hashes(words: str) -> list[Column]:
    return [F.xxhash64(words).alias("h1"), F.xxhash64(F.lit(1), words).alias("h2")]


def clean(text: Column) -> Column:
    """The text without quoted lines, the lines that announce a quote, and
    empty lines at either end."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n")

    def own(line: Column, i: Column) -> Column:
        following = F.coalesce(F.get(lines, i + 1), F.lit(""))
        return ~line.rlike(QUOTED) & ~(line.rlike(ATTRIBUTION) & following.rlike(QUOTED))

    kept = F.array_join(F.filter(lines, own), "\n")
    plain = F.regexp_replace(F.regexp_replace(kept, r"\A(?:[ \t]*\n)+", ""), r"(?:\n[ \t]*)+\z", "")
    return F.when(F.coalesce(text, F.lit("")).contains(">"), plain).otherwise(F.coalesce(text, F.lit("")))


def _passages(marked: DataFrame) -> DataFrame:
    """Quoted passages: conv, turn, th, level, at (first line), lines."""
    lines = marked.select("conv", "turn", "th", F.posexplode(F.split("text", "\n")).alias("no", "line"))
    marks = F.regexp_extract("line", MARKS, 1)
    lines = (lines.withColumn("level", F.length(F.regexp_replace(marks, "[^>]", "")))
                  .withColumn("body", F.substring(F.col("line"), F.length(marks) + 1, F.length("line")))
                  .where("level > 0"))
    # Within one message: neighbouring lines of a level share no - rank.
    rank = F.row_number().over(Window.partitionBy("conv", "turn", "th", "level").orderBy("no"))
    blocks = lines.withColumn("island", F.col("no") - rank)
    return (blocks.groupBy("conv", "turn", "th", "level", "island")
                  .agg(F.min("no").alias("at"), F.array_sort(F.collect_list(F.struct("no", "body"))).alias("b"))
                  .select("conv", "turn", "th", "level", "at", F.col("b.body").alias("lines")))


def _first_said(own: DataFrame, marked: DataFrame) -> DataFrame:
    """conv, h1, h2 and the first turn that said these words."""
    said = own.where("conv is not null and turn is not null").join(
        marked.select("conv").distinct(), "conv", "left_semi")
    text = clean(F.col("text"))
    parts = F.array_distinct(F.concat(F.array(_norm(text)),
                                      F.transform(F.split(text, r"\n[ \t]*\n"), _norm),
                                      F.transform(F.split(text, "\n"), _norm)))
    return (said.select("conv", "turn", F.explode(parts).alias("words")).where("words != ''")
                .select("conv", "turn", *_hashes("words"))
                .groupBy("conv", "h1", "h2").agg(F.min("turn").alias("first")))


def _threads(links: DataFrame) -> DataFrame:
    """conv, turn, thread (turn of the thread's first message) and depth,
    for messages that reply, by pointer jumping."""
    up = pinned(links.groupBy("conv", "turn").agg(F.min("reply_to").alias("top"))
                     .withColumn("depth", F.lit(1).cast("bigint")))
    while True:
        above = up.select("conv", F.col("turn").alias("top"), F.col("top").alias("top2"), F.col("depth").alias("depth2"))
        step = pinned(up.join(above, ["conv", "top"], "left"))
        moved = not step.where("top2 is not null").isEmpty()
        up = step.select("conv", "turn", F.coalesce("top2", "top").alias("top"),
                         (F.col("depth") + F.coalesce("depth2", F.lit(0))).alias("depth"))
        if not moved:
            return up.withColumnRenamed("top", "thread")


def link_quotes(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per message: conv, turn, role, text (without quotes),
    n_quotes (passages), n_linked, reply_to (turn), thread (turn of its
    first message), depth, and position (1, 2, ... in the conversation, in
    reply order)."""
    own = messages.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("bigint").alias("turn"),
                          F.col(role_col).alias("role"), F.col(text_col).alias("text")) \
                  .withColumn("th", F.xxhash64("text"))
    marked = (own.where(F.col("text").contains(">") & F.col("text").rlike("(?m)" + QUOTED))
                 .where("conv is not null and turn is not null").select("conv", "turn", "text", "th").distinct())
    marked = pinned(marked)
    passages = pinned(_passages(marked))
    words = F.concat(F.array(F.struct(F.lit(0).alias("by_line"), _norm(F.array_join("lines", "\n")).alias("words"))),
                     F.transform("lines", lambda x: F.struct(F.lit(1).alias("by_line"), _norm(x).alias("words"))))
    probes = (passages.select("conv", "turn", "th", "level", "at", F.explode(words).alias("w"))
                      .select("conv", "turn", "th", "level", "at", "w.by_line", "w.words").where("words != ''")
                      .select("conv", "turn", "th", "level", "at", "by_line", *_hashes("words")))
    found = pinned(probes.join(_first_said(own, marked), ["conv", "h1", "h2"]).where("first < turn"))
    best = F.min(F.struct("by_line", "level", "at", "first"))
    replies = found.groupBy("conv", "turn", "th").agg(best["first"].alias("reply_to"))
    linked = (found.select("conv", "turn", "th", "level", "at").distinct()
                   .groupBy("conv", "turn", "th").agg(F.count(F.lit(1)).alias("n_linked")))
    quotes = passages.groupBy("conv", "turn", "th").agg(F.count(F.lit(1)).alias("n_quotes"))
    told = pinned(quotes.join(replies, ["conv", "turn", "th"], "left").join(linked, ["conv", "turn", "th"], "left"))
    threads = _threads(told.where("reply_to is not null"))
    n = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    rows = (own.join(told, ["conv", "turn", "th"], "left").join(threads, ["conv", "turn"], "left")
               .select("conv", "turn", "role", clean(F.col("text")).alias("text"), n("n_quotes"), n("n_linked"),
                       "reply_to", F.coalesce("thread", "turn").alias("thread"), n("depth"), "th",
                       F.lit(1).cast("bigint").alias("one")))
    ordered = running_sum(rows, ["conv"], ["thread", "depth", "turn", "role", "th"], "one", "position")
    return ordered.select(F.col("conv").alias(conv_col), F.col("turn").alias(turn_col), F.col("role").alias(role_col),
                          F.col("text").alias(text_col), "n_quotes", "n_linked", "reply_to", "thread", "depth",
                          "position")


def chat_lines(linked: DataFrame, role_col: str = "role", text_col: str = "text",
               form: str = "<|%s|>\n%s\n") -> DataFrame:
    """``linked`` with each message in chat markup, as column ``chat``; a
    conversation's chat is these lines by position."""
    return linked.withColumn("chat", F.format_string(form, F.coalesce(role_col, F.lit("user")),
                                                     F.coalesce(text_col, F.lit(""))))
