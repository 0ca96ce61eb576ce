"""Line deduplication by a deletion-neighbourhood join, with built-in functions only.

Two lines are duplicates if they are equal, or if one edit of a code point turns
one into the other, after trimming and lower-casing. Lines with an equal variant
after at most one deletion are joined; the real edit distance is then checked, and
the earliest line stays. "Earliest" is by doc_id, then row, then place.

A line of n code points has n variants. They are emitted only where a match is
possible: cut a line into blocks, and one edit leaves all but one of them alone,
so lines in reach of each other share the text around some block. Lines that share
half of their text with no other emit nothing; the rest are cut again into 16
blocks, and only blocks whose surroundings are shared emit variants, hashed with
those surroundings. No match is lost by this.

Tables of marked lines grow with the texts and have no bound, so joins of texts with
them ask for a sort-merge join at every size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.llm.tables import ROW, numbered_once, stored, text

PLACES = f"{ROW}_places"

MIN_CHARS = 20
HALVES, BLOCKS = 2, 16
FIRST = "first"
ID = ("h1", "h2")  # two hashes of a line stand for its text


def lines(docs: DataFrame, least: int = MIN_CHARS) -> DataFrame:
    """Every line of at least ``least`` code points of numbered rows, with its place and identity."""
    rows = docs.select(ROW, F.col("doc_id").cast("bigint").alias("doc_id"), text().alias("text"))
    rows = rows.select(ROW, "doc_id", F.posexplode(F.split("text", "\n")).alias("place", "line"))
    rows = rows.withColumn("line", F.lower(F.trim("line"))).filter(F.length("line") >= least)
    return rows.select(
        F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", ROW, "place").alias("at"), "line",
        F.xxhash64(F.lit(1), "line").alias("h1"), F.xxhash64(F.lit(2), "line").alias("h2"),
    )


def block_keys(line: Column, n: Column, blocks: int) -> Column:
    """(key, low, high, short) of each block: a hash of what surrounds it, and its ends.

    Blocks are cut for the length of the shorter line of a pair, so a line is cut for its
    own length and for one less; in the latter case a block is one longer.
    """

    def one(shorter: int, j: int) -> Column:
        size = n - shorter
        low, high = F.floor(size * j / blocks), F.floor(size * (j + 1) / blocks) + shorter
        around = (F.substr(line, F.lit(1), low.cast("int")), F.substr(line, high.cast("int") + 1))
        return F.struct(
            F.xxhash64(F.lit(j), size.cast("int"), *around).alias("key"), low.cast("int").alias("low"),
            high.cast("int").alias("high"), F.lit(shorter == 0).alias("short"),
        )

    return F.array(*(one(s, j) for s in (0, 1) for j in range(blocks)))


def sharing(keyed: DataFrame, label: str) -> DataFrame:
    """The rows of ``keyed`` whose key another line has too."""
    shared = keyed.groupBy("key").agg(F.min("h1").alias("a"), F.max("h1").alias("b")).filter("a <> b")
    return keyed.join(stored(shared.select("key"), label), "key", "left_semi")


def neighbours(distinct: DataFrame, docs: DataFrame) -> DataFrame:
    """(h1, h2) of each distinct line that an earlier one is within one edit of."""
    halves = distinct.select(*ID, F.explode("halves").alias("key"))
    near = stored(sharing(halves, "lines-halves").select(*ID).distinct(), "lines-near")
    # A line's text is read where it first stands.
    firsts = distinct.join(near, list(ID), "left_semi").select(*ID, FIRST)
    spots = lines(docs).select(F.col("at").alias(FIRST), "line", *ID)
    texts = stored(spots.join(firsts.hint("merge"), [*ID, FIRST]).select(*ID, FIRST, "line"), "lines-texts")
    blocks = texts.select(
        *ID, FIRST, "line", F.explode(block_keys(F.col("line"), F.length("line"), BLOCKS)).alias("b")
    ).select(*ID, FIRST, F.col("b.key").alias("key"), "line", "b.low", "b.high", "b.short")
    blocks = blocks.select(
        *ID, FIRST, "key", "short", F.substr("line", F.col("low") + 1, F.col("high") - F.col("low")).alias("block")
    )
    emitting = sharing(blocks, "lines-blocks")
    without = lambda i: F.concat(F.substr("block", F.lit(1), i - 1), F.substr("block", i + 1))
    gone = F.transform(
        F.sequence(F.lit(1), F.length("block"), F.when(F.length("block") > 0, F.lit(1)).otherwise(F.lit(-1))),
        lambda i: F.struct(F.xxhash64("key", without(i)).alias("variant"), F.when(F.col("short"), i).otherwise(0).alias("cut")),
    )
    gone = F.when(F.length("block") > 0, gone)
    same = F.when(F.col("short"), F.array(F.struct(F.xxhash64("key", "block").alias("variant"), F.lit(0).alias("cut"))))
    empty = F.array().cast("array<struct<variant:bigint,cut:int>>")
    variants = emitting.select(
        *ID, FIRST, "short", F.explode(F.concat(F.coalesce(same, empty), F.coalesce(gone, empty))).alias("v")
    ).select(*ID, FIRST, (F.col("short") & (F.col("v.cut") == 0)).alias("itself"), "v.variant", "v.cut")
    # Equal variants cut at one place are in reach of each other, so the earliest stands for
    # all. A line that is itself the variant is in reach of all that were cut down to it.
    spot = F.struct(FIRST, *ID)
    heads = stored(
        variants.groupBy("variant", "cut").agg(
            F.min(spot).alias("head"), F.max(spot).alias("tail"), F.min(F.when(F.col("itself"), spot)).alias("short")
        ).filter("head <> tail"),
        "lines-heads",
    )
    leader = F.when((F.col("cut") > 0) | F.col("itself"), F.col("head")).otherwise(F.col("short_head"))
    links = (
        variants.join(heads.withColumnRenamed("short", "short_head"), ["variant", "cut"])
        .withColumn("leader", leader).filter(F.col("leader").isNotNull() & (F.col(f"leader.{FIRST}") < F.col(FIRST)))
        .select(*ID, F.col("leader.h1").alias("l1"), F.col("leader.h2").alias("l2")).distinct()
    )
    ahead = texts.select(F.col("h1").alias("l1"), F.col("h2").alias("l2"), F.col("line").alias("ahead"))
    checked = stored(links, "lines-links").join(texts.select(*ID, "line"), list(ID)).join(ahead, ["l1", "l2"])
    return checked.filter(F.levenshtein("line", "ahead", 1) >= 0).select(*ID).distinct()


def dropped_lines(docs: DataFrame, short: bool = False) -> DataFrame:
    """(a row's number, doc_id, places): the 0-based lines of each row that an earlier line stands for.

    Lines under 20 code points are not compared by edits: at that length one edit makes
    another word. With ``short`` they are dropped if they repeat an earlier line exactly,
    else never; an empty line is no line. Null and empty texts have no lines to drop; of repeated rows all but the first
    lose their lines. A row without a doc_id is earliest.
    """
    docs = numbered_once(docs.select("doc_id", "text", *({ROW} & {*docs.columns})), "lines-rows")
    line, n = F.col("line"), F.length("line")
    least = 1 if short else MIN_CHARS
    halves = F.when(n >= MIN_CHARS, F.transform(block_keys(line, n, HALVES), lambda b: b.key))
    distinct = stored(
        lines(docs, least).groupBy(*ID).agg(
            F.min("at").alias(FIRST), F.count("*").alias("n"), F.first(halves).alias("halves")
        ),
        "lines-distinct",
    )
    near = neighbours(distinct, docs).withColumn("near", F.lit(True))
    marked = distinct.select(*ID, FIRST, "n").join(near, list(ID), "left").filter("n > 1 or near")
    marked = stored(marked, "lines-marked")
    gone = (
        lines(docs, least).select("at", *ID).join(marked.hint("merge"), list(ID))
        .filter(F.col("near").isNotNull() | (F.col("at") != F.col(FIRST)))
    )
    return gone.groupBy(F.col(f"at.{ROW}").alias(ROW), F.col("at.doc_id").alias("doc_id")).agg(
        F.sort_array(F.collect_set("at.place")).alias("places")
    )


def drop_repeated_lines(docs: DataFrame, short: bool = False) -> DataFrame:
    """``docs`` without their repeated lines; a row left without any visible text goes.

    Rows that had no text to begin with stay as they are, and so does every other column
    but n_chars, which counts the new text if there is such a column.
    """
    rows = numbered_once(docs, "lines-rows")
    gone = stored(dropped_lines(rows, short).select(ROW, F.col("places").alias(PLACES)), "lines-gone")
    rows = rows.join(gone.hint("merge"), ROW, "left")
    kept = F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains(PLACES, i))
    changed = F.col(PLACES).isNotNull()
    rows = rows.withColumn("text", F.when(changed, F.array_join(kept, "\n")).otherwise(F.col("text")))
    rows = rows.filter(~changed | (F.trim("text") != ""))
    if "n_chars" in docs.columns:
        count = F.length("text").cast(docs.schema["n_chars"].dataType)
        rows = rows.withColumn("n_chars", F.when(changed, count).otherwise(F.col("n_chars")))
    return rows.select(docs.columns)
