"""Mixing sources to target weights, with built-in functions only.

1. Words are summed per source. Sources in code point order, a missing one last, weigh
   1, 2, 3 and so on again, and share the words of the whole corpus by weight.
2. No source gives more than three times its words. What is above that is shared anew by
   weight among the others, until none is above: each round is one sum over the sources,
   kept as two integers, the level (numerator, denominator) of one unit of weight. A
   round caps what the last level puts above its bound, so the level only rises, and few
   rounds reach the end (this is Newton's step on a convex line of pieces).
3. A source's rate is its target over its words. A document is taken floor(rate) times,
   and once more if its hash, as a number from 0 to 1, is below the rest of the rate.

The hash is of id and text, so reruns and any split of the input agree, and documents
without ids still draw apart; rows equal in both draw alike.

Defined results: a missing text has no words, and is taken as often as its source's other
texts; a missing source is a source of its own; a source without words has target 0 and
rate 0; an empty table gives an empty one. Extra columns stay, but for those named as an
added one, which are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.llm.tables import ordered, stored, text

# What a word is, how sources weigh, how often a document may be taken.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = 3
MOST_COPIES = 3
ADDED = ("size", "source_size", "target", "copies")
# Rates of so many sources, whose names have so many bytes, go to every task.
BROADCAST_SOURCES, BROADCAST_BYTES = 50_000, 4 << 20
SALTS = 32
EXACT = "decimal(38,0)"


def words(value: Column) -> Column:
    return F.regexp_count(value, F.lit(WORD)).cast("bigint")


def draw(seed: str) -> Column:
    """A number from 0 to below 1 by doc_id and text: 52 bits of a digest."""
    key = F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("\n"), text())
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def level(sources: DataFrame) -> tuple[int, int]:
    """(numerator, denominator) of the words that one unit of weight gets.

    ``sources`` has source_size and weight. Only the two sums of a round come back.
    """
    size, weight = F.col("source_size").cast(EXACT), F.col("weight").cast(EXACT)
    total = sources.agg(F.sum(size), F.sum(weight)).first()
    num, den = int(total[0] or 0), int(total[1] or 1)
    while True:
        above = weight * F.lit(num).cast(EXACT) > size * F.lit(MOST_COPIES * den).cast(EXACT)
        capped = sources.filter(above).agg(F.sum(size), F.sum(weight)).first()
        after = int(total[0] or 0) - MOST_COPIES * int(capped[0] or 0), int(total[1] or 1) - int(capped[1] or 0)
        if after == (num, den):
            return after
        num, den = after


def rates(docs: DataFrame) -> DataFrame:
    """(source, source_size, target, rate) of every source: one row each, stored."""
    sizes = docs.groupBy(F.col("source").cast("string").alias("source")).agg(
        F.sum(words(text())).alias("source_size")
    )
    placed = ordered(sizes, "mix-sources", F.asc_nulls_last("source"))
    sources = stored(
        placed.select("source", "source_size", (F.pmod("place", F.lit(WEIGHTS)) + 1).alias("weight")), "mix-weights"
    )
    num, den = level(sources)
    bound = F.col("source_size") * MOST_COPIES
    target = F.least(bound.cast("double"), (F.col("weight") * F.lit(num)).cast("double") / F.lit(float(den)))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return sources.select("source", "source_size", target.alias("target")).withColumn("rate", rate)


def allotted(docs: DataFrame, seed: str = "mix", broadcast_sources: int = BROADCAST_SOURCES) -> DataFrame:
    """Every document with size, source_size, target (of its source) and copies.

    The rates are one row a source. They are broadcast if they were counted to be few and
    short; beyond that both sides are dealt by source and salt, so that a source with a
    third of all documents is dealt to many tasks.
    """
    by_source = rates(docs)
    found = by_source.agg(F.count("*"), F.sum(F.octet_length("source"))).first()
    given = docs.select(
        F.struct("*").alias("doc"), F.col("source").cast("string").alias("source"), words(text()).alias("size"),
        draw(seed).alias("draw"),
    )
    same = given.source.eqNullSafe(by_source.source)
    if found[0] <= broadcast_sources and (found[1] or 0) <= BROADCAST_BYTES:
        joined = given.join(F.broadcast(by_source), same)
    else:
        given = given.withColumn("salt", F.floor(F.col("draw") * SALTS).cast("int"))
        by_source = by_source.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = given.join(by_source, same & (given.salt == by_source.salt))
    whole = F.floor("rate")
    copies = whole + F.when(F.col("draw") < F.col("rate") - whole, 1).otherwise(0)
    kept = [F.col(f"doc.`{c}`") for c in docs.columns if c.lower() not in ADDED]
    return joined.select(*kept, "size", "source_size", "target", copies.cast("bigint").alias("copies"))


def mixed(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """The mix itself: every document once for each copy taken, numbered from 1 as ``copy``."""
    taken = allotted(docs.drop("copy"), seed).filter("copies > 0")
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
