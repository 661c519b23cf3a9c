"""Quotation linking: conversations rebuilt from what messages quote.

Leading ``>`` marks give a line's quote level.  Runs of lines of one level are
passages; a passage and its lines are normalised and hashed, and the hashes are
joined to those of unquoted text in earlier messages.  The message that the
outermost level quotes most words of is the one replied to.  What is left
without quotes is a message's own text.

DataFrame functions only.  A passage meets the last earlier message that has it
through one ordered pass over the passage's hash, so a passage that everyone
writes or quotes makes no pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sondar.llm.common import quoted, staged

_MARKS = r"^[ \t]{0,3}((?:>[ \t]?)+)"


def quote_level(line: Column) -> Column:
    """Number of leading quotation marks, spaces between them allowed."""
    return F.length(F.regexp_replace(F.regexp_extract(line, _MARKS, 1), "[^>]", ""))


def unquoted(line: Column) -> Column:
    """The line without its leading quotation marks."""
    return F.regexp_replace(line, _MARKS, "")


def normalised(text: Column) -> Column:
    """Letters and digits in lower case, everything else as single spaces."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def passages(messages: DataFrame) -> DataFrame:
    """(conv, turn, h, level, unit, words) of columns conv, turn, h, text: every line with
    words and every run of lines of one level, blank lines between runs, as hashes."""
    lines = messages.select("conv", "turn", "h", F.posexplode(F.split("text", r"\r?\n")).alias("at", "line"))
    lines = lines.select("conv", "turn", "h", "at", quote_level(F.col("line")).alias("level"),
                         normalised(unquoted(F.col("line"))).alias("words"))
    # Runs: lines of one level in a row, counted within their message.
    blank = F.col("words") == ""
    order = Window.partitionBy("conv", "turn", "h").orderBy("at")
    begins = blank | F.coalesce(F.lag("level").over(order) != F.col("level"), F.lit(True)) | F.coalesce(
        F.lag("words").over(order) == "", F.lit(True))
    runs = lines.withColumn("run", F.sum(begins.cast("int")).over(order)).where(~blank)
    whole = runs.groupBy("conv", "turn", "h", "run").agg(
        F.first("level").alias("level"), F.count(F.lit(1)).alias("lines"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "words"))), lambda x: x["words"]), " ").alias("words"))
    every = whole.where("lines > 1").select("conv", "turn", "h", "level", "words").unionByName(
        runs.select("conv", "turn", "h", "level", "words"))
    return every.select("conv", "turn", "h", "level", F.sha2("words", 256).alias("unit"), F.size(F.split("words", " ")).alias("words"))


def own_text(text: Column) -> Column:
    """The text without quoted lines and without blank lines at either end."""
    kept = F.filter(F.split(text, r"\r?\n"), lambda x: quote_level(x) == 0)
    return F.regexp_replace(F.regexp_replace(F.array_join(kept, "\n"), r"^(?:[ \t]*\n)+", ""), r"(?:\n[ \t]*)+$", "")


def links(units: DataFrame) -> DataFrame:
    """(conv, turn, h, level, parent_turn, parent_h, words): for each message and
    quote level the earlier message of its conversation most words of whose own text it quotes;
    of equals the latest."""
    # Within a turn, quotes come before own text, so no message is its own source.
    order = Window.partitionBy("conv", "unit").orderBy("turn", F.desc("quoting"), "h", "level")
    marked = units.select("*", (F.col("level") > 0).cast("int").alias("quoting")).groupBy(
        "conv", "unit", "turn", "h", "level", "quoting").agg(F.max("words").alias("words"))
    source = F.last(F.when(F.col("level") == 0, F.struct(F.col("turn").alias("turn"), F.col("h").alias("h"))), ignorenulls=True)
    found = marked.withColumn("source", source.over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    found = found.where("level > 0 and source is not null")
    voted = found.groupBy("conv", "turn", "h", "level", "source").agg(F.sum("words").alias("words"))
    best = voted.groupBy("conv", "turn", "h", "level").agg(
        F.max(F.struct("words", "source")).alias("b"))
    return best.select("conv", "turn", "h", "level", F.col("b.source.turn").alias("parent_turn"),
                       F.col("b.source.h").alias("parent_h"), F.col("b.words").alias("words"))


def threads(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", text: str = "text") -> DataFrame:
    """One row per row of ``messages``, in reply order by (conv, depth, turn).

    ``conv``, ``turn``, ``parent_turn`` (the message replied to, found through the
    outermost level that quotes an earlier message; null where none does),
    ``root_turn`` and ``depth`` (the first message that replies lead back to, and how many
    replies lie between), ``n_quoted`` (levels of quotation), ``n_linked`` (levels whose source was
    found) and ``body``, the text without quotes.

    A null text is empty.  Rows without a conversation or turn stand alone, without links.
    Rows equal in conversation, turn and text are one message and have equal results.
    """
    rows = messages.select(
        quoted(conv).alias("conv"), quoted(turn).alias("turn"), F.coalesce(quoted(text), F.lit("")).alias("text"))
    rows = rows.withColumn("h", F.sha2("text", 256))
    sound = rows.where("conv is not null and turn is not null")
    units = staged(passages(sound.groupBy("conv", "turn", "h").agg(F.first("text").alias("text"))), "units")
    found = staged(links(units), "links")
    levels = units.where("level > 0").groupBy("conv", "turn", "h").agg(F.countDistinct("level").alias("n_quoted"))
    reply = found.groupBy("conv", "turn", "h").agg(
        F.min(F.struct("level", "parent_turn", "parent_h")).alias("r"), F.count(F.lit(1)).alias("n_linked"))
    reply = staged(reply.select("conv", "turn", "h", "r.parent_turn", "r.parent_h", "n_linked"), "replies")
    # Pointers jump twice as far in each round until all are at a root.
    jump = reply.select("conv", "turn", "h", F.col("parent_turn").alias("to_turn"), F.col("parent_h").alias("to_h"), F.lit(1).alias("depth"))
    jump = staged(jump, "jumps")
    while True:
        onward = jump.select("conv", F.col("turn").alias("to_turn"), F.col("h").alias("to_h"), F.col("to_turn").alias("next_turn"),
                             F.col("to_h").alias("next_h"), F.col("depth").alias("more"))
        joined = jump.join(onward, ["conv", "to_turn", "to_h"], "left")
        if joined.where("more is not null").isEmpty():
            break
        jump = staged(joined.select(
            "conv", "turn", "h", F.coalesce("next_turn", "to_turn").alias("to_turn"),
            F.when(F.col("more").isNull(), F.col("to_h")).otherwise(F.col("next_h")).alias("to_h"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")), "jumps")
    known = (
        levels.join(reply, ["conv", "turn", "h"], "left")
        .join(jump.select("conv", "turn", "h", F.col("to_turn").alias("root_turn"), "depth"), ["conv", "turn", "h"], "left")
    )
    known = staged(known, "messages")
    return rows.join(known, ["conv", "turn", "h"], "left").select(
        F.col("conv").alias(conv), F.col("turn").alias(turn), "parent_turn",
        F.coalesce("root_turn", "turn").alias("root_turn"), F.coalesce("depth", F.lit(0)).alias("depth"),
        F.coalesce("n_quoted", F.lit(0)).cast("long").alias("n_quoted"),
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"), own_text(F.col("text")).alias("body"))


def quoting(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", text: str = "text", levels: int = 2) -> DataFrame:
    """The messages as mail: each quotes the ``levels`` before it in its
    conversation, the oldest with the most marks, above its own text."""
    order = Window.partitionBy(quoted(conv)).orderBy(quoted(turn), F.xxhash64(quoted(text)))
    above = [F.lag(F.coalesce(quoted(text), F.lit("")), level).over(order) for level in range(1, levels + 1)]
    parts = [F.regexp_replace(F.regexp_replace(a, r"(?m)^", "> " if level == 1 else ">" * level + " "), r"\r", "")
             for level, a in enumerate(above, 1)][::-1]
    # A row without a conversation follows nothing.
    whole = F.concat_ws("\n", *parts, F.coalesce(quoted(text), F.lit("")))
    return messages.select(quoted(conv), quoted(turn), F.when(quoted(conv).isNull(), quoted(text)).otherwise(whole).alias(text))
