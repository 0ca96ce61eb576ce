"""Chat formatting by prefix-target expansion, with built-in functions only.

Every assistant turn becomes an example of its own: all turns before it are
context, and only its reply is trainable. All examples of a conversation are
beginnings of one formatted text, so a row names the part of that text which the
example is, instead of repeating it: such rows of a conversation of n turns take
space in proportion to n. ``write_examples`` writes the examples in full, and digests
are read from these.

A turn is formatted as ``### Role: text </turn>`` and a line feed. Backslashes,
``<`` and ``#`` inside roles and texts are escaped by a backslash and a letter,
so no text can hold a marker and the original comes back exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.llm.tables import stored, text
from barline.session import fresh_path

# The template's markers and the escapes inside texts.
OPEN, MIDDLE, CLOSE = "### ", ": ", " </turn>\n"
ESCAPES = (("\\", "\\b"), ("<", "\\l"), ("#", "\\h"), (":", "\\c"))
TRAINABLE = "assistant"


def escaped(value: Column) -> Column:
    for plain, code in ESCAPES:
        value = F.replace(value, F.lit(plain), F.lit(code))
    return value


def unescaped(value: Column) -> Column:
    """The inverse: after an escape every backslash begins a code, and the code of the
    backslash itself is undone last."""
    for plain, code in reversed(ESCAPES):
        value = F.replace(value, F.lit(code), F.lit(plain))
    return value


def formatted(conversations: DataFrame) -> DataFrame:
    """(conv_id, text, ends): the formatted conversation and where its turns' texts lie.

    Turns are ordered by turn, then role and text, so ties and repeated rows have one
    order; null roles, texts and turns are empty or first. One conversation is one value,
    as its example texts and digests ask; no row holds more than one.
    """
    turn = F.struct(
        F.col("turn").cast("bigint").alias("turn"), text("role").alias("role"), text().alias("text")
    )
    turns = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), turn.alias("t"))
    turns = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    part = lambda t: F.concat(F.lit(OPEN), escaped(t.role), F.lit(MIDDLE), escaped(t.text), F.lit(CLOSE))
    return turns.select(
        "conv_id", F.transform("turns", lambda t: t.role).alias("roles"), F.transform("turns", part).alias("parts")
    )


def examples(conversations: DataFrame) -> DataFrame:
    """One row per assistant turn, and one without a target for the turns after the last.

    Columns: conv_id, example, piece (what this example adds to the one before it), start
    (where the piece begins in the conversation's text), end (where the example ends),
    reply_start and reply_end (the trainable part, null without a target). The example is
    the conversation's formatted text up to ``end``; pieces in order make up that text.
    """
    whole = formatted(conversations)
    last = F.size("parts") - 1
    stops = F.filter(
        F.sequence(F.lit(0), last), lambda i: (F.get("roles", i) == TRAINABLE) | (i == last)
    )
    cut = whole.withColumn("stops", stops).select("*", F.posexplode("stops").alias("example", "stop"))
    before = F.coalesce(F.get("stops", F.col("example") - 1), F.lit(-1))
    cut = cut.withColumn("piece", F.array_join(F.slice("parts", before + 2, F.col("stop") - before), ""))
    lengths = F.aggregate(
        F.slice("parts", 1, before + 1), F.lit(0).cast("bigint"), lambda n, p: n + F.length(p)
    )
    cut = cut.withColumn("start", lengths).withColumn("end", F.col("start") + F.length("piece"))
    target = F.get("roles", "stop") == TRAINABLE
    lead = len(OPEN) + len(MIDDLE) + len(TRAINABLE)
    reply_start = F.col("end") - F.length(F.get("parts", "stop")) + lead
    return cut.select(
        "conv_id", F.col("example").cast("bigint").alias("example"), "piece", "start", "end",
        F.when(target, reply_start).alias("reply_start"),
        F.when(target, F.col("end") - len(CLOSE)).alias("reply_end"),
    )


def example_texts(rows: DataFrame) -> DataFrame:
    """The examples in full: (conv_id, example, text, reply_start, reply_end).

    The texts of a conversation of n turns add up to the square of n. Its pieces come
    together once, and each example is cut from the text that they make up.
    """
    spans = ("example", "end", "reply_start", "reply_end")
    joined = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("example", "piece", *spans[1:]))).alias("all"))
    each = joined.select(
        "conv_id", F.array_join(F.transform("all", lambda x: x.piece), "").alias("whole"),
        F.transform("all", lambda x: F.struct(*(x[c].alias(c) for c in spans))).alias("spans"),
    ).select("conv_id", "whole", F.inline("spans"))
    return each.select(
        "conv_id", "example", F.expr("substring(whole, 1, int(end))").alias("text"), "reply_start", "reply_end"
    )


def turns_of(whole: Column) -> Column:
    """The turns (role, text) read back from a conversation's formatted text."""
    parts = F.split(whole, CLOSE.replace("/", "\\/"))
    parts = F.slice(parts, 1, F.size(parts) - 1)

    def turn(part: Column) -> Column:
        body = F.substring(part, len(OPEN) + 1, 1 << 30)
        role = F.substring_index(body, MIDDLE.strip(), 1)
        said = F.substr(body, F.length(role) + len(MIDDLE) + 1)
        return F.struct(unescaped(role).alias("role"), unescaped(said).alias("text"))

    return F.transform(parts, turn)


# Examples share their beginnings, which zstd finds again within a page of this size. A page
# and a group of rows are closed by their bytes, whatever the length of a row.
PAGES = {
    "compression": "zstd", "parquet.page.size": 8 << 20, "parquet.page.size.row.check.min": 1,
    "parquet.block.size": 32 << 20, "parquet.block.size.row.check.min": 1,
}


def write_examples(rows: DataFrame) -> DataFrame:
    """``example_texts`` of the stored examples, written in full and read again."""
    texts = example_texts(rows)
    path = fresh_path(rows.sparkSession, "chat-texts")
    texts.write.options(**PAGES).parquet(path)
    return rows.sparkSession.read.schema(texts.schema).parquet(path)


def summary(rows: DataFrame) -> DataFrame:
    """Writes the examples in full and gives the digests of each conversation, computed from
    what was written alone: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars, n_examples.

    The replies are cut from their own examples; the turns are read from the last one,
    which is the whole text."""
    reply = F.substr("text", F.col("reply_start") + 1, F.col("reply_end") - F.col("reply_start"))
    loss = unescaped(F.coalesce(reply, F.lit("")))
    each = write_examples(rows).select("conv_id", "example", "text", F.struct("example", loss.alias("loss")).alias("e"), "reply_start")
    read = each.groupBy("conv_id").agg(
        F.sort_array(F.collect_list("e")).alias("all"), F.count("reply_start").alias("n_examples"),
        F.max_by("text", "example").alias("whole"),
    ).withColumn("loss", F.array_join(F.transform("all", lambda x: x.loss), "")).withColumn("turns", turns_of(F.col("whole")))
    line = F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n")))
    return read.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(line, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("whole").cast("bigint").alias("formatted_chars"), "n_examples",
    )


def format_chats(conversations: DataFrame) -> DataFrame:
    """The stored examples of all conversations."""
    return stored(examples(conversations), "chat-examples")
