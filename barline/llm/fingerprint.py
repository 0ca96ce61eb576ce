"""Document fingerprints by Order MinHash, with built-in functions only.

A text's k-mers are its runs of three words, each numbered by its occurrence. A
hash of k-mer and number deals every one to one of 32 bins and ranks it there.
A bin keeps its two least k-mers, puts them back into text order and hashes the
pair, so a sketch changes when words change and also when they change places.
The bins stand for independent orders of one hash (one-permutation hashing), so
a text is hashed and sorted once and not 32 times.

Work arrays hold one long per k-mer: 39 bits of hash over 24 bits of place, so
that Spark sorts plain longs. Places beyond 2**24 words wrap, which can only
change the order inside one pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barline.llm.tables import stored, text

MISSING = -(1 << 63)  # stands for a missing doc_id
KMER_WORDS = 3
PICKED = 2
BIN_SHIFT, PLACE_BITS = 58, 24
MASK_PLACE, MASK_RANK = (1 << 24) - 1, (1 << 34) - 1
MASK_HASH, MASK_TUPLE = (1 << 39) - 1, (1 << 58) - 1


def masked(value: Column, mask: int) -> Column:
    return value.bitwiseAND(F.lit(mask).cast("bigint"))


def over_place(hashed: Column, place: Column) -> Column:
    shifted = F.shiftleft(masked(hashed, MASK_HASH), PLACE_BITS)
    return shifted.bitwiseOR(masked(place.cast("bigint"), MASK_PLACE))


def run_starts(array: str, shift: int) -> Column:
    """Places where the high bits of a sorted array's entries change."""
    high = lambda i: F.shiftright(F.get(array, i), shift)
    return F.filter(
        F.sequence(F.lit(0), F.size(array) - 1), lambda i: (i == 0) | (high(i) != high(i - 1))
    )


def run_end(array: str, starts: str, r: Column) -> Column:
    return F.coalesce(F.get(starts, r + 1), F.size(array))


def fingerprinted(df: DataFrame, column: str, out: str) -> DataFrame:
    """``df`` with the sketches of text ``column`` in array ``out``, a bin number in the
    top bits of each. A null is an empty text, whose only k-mer is empty."""
    w, s, b, ranked, placed = (f"_llm_{out}_{x}" for x in ("words", "kmers", "starts", "ranked", "placed"))
    kmer = lambda i: F.xxhash64(*(F.get(w, i + j) for j in range(KMER_WORDS)))
    df = df.withColumn(w, F.split(F.trim(text(column)), r"\s+"))
    last = F.greatest(F.size(w) - KMER_WORDS, F.lit(0))
    df = df.withColumn(s, F.sort_array(F.transform(F.sequence(F.lit(0), last), lambda i: over_place(kmer(i), i))))
    df = df.withColumn(b, run_starts(s, PLACE_BITS))

    def numbered_run(start: Column, r: Column) -> Column:
        value = F.shiftright(F.get(s, start), PLACE_BITS)
        return F.transform(
            F.sequence(start, run_end(s, b, r) - 1),
            lambda j: over_place(F.xxhash64(value, j - start), F.get(s, j)),
        )

    df = df.withColumn(ranked, F.sort_array(F.flatten(F.transform(b, numbered_run))))
    bin_of = lambda x: F.shiftright(x, BIN_SHIFT)
    picked = F.filter(
        ranked, lambda x, i: (i < PICKED) | (bin_of(x) != bin_of(F.get(ranked, i - PICKED)))
    )

    def by_place(x: Column) -> Column:
        place = F.shiftleft(masked(x, MASK_PLACE), 34)
        rank = masked(F.shiftright(x, PLACE_BITS), MASK_RANK)
        return F.shiftleft(bin_of(x), BIN_SHIFT).bitwiseOR(place).bitwiseOR(rank)

    df = df.withColumn(placed, F.sort_array(F.transform(picked, by_place)))
    df = df.withColumn(b, run_starts(placed, BIN_SHIFT))

    def sketch(start: Column, r: Column) -> Column:
        pair = F.slice(placed, start + 1, run_end(placed, b, r) - start)
        hashed = F.xxhash64(F.transform(pair, lambda y: masked(y, MASK_RANK)))
        number = F.shiftleft(bin_of(F.get(placed, start)), BIN_SHIFT)
        return number.bitwiseOR(masked(hashed, MASK_TUPLE))

    return df.withColumn(out, F.transform(b, sketch)).drop(w, s, b, ranked, placed)


def likeness(left: str, right: str) -> Column:
    """Equal sketches as a share of the bins that either text fills."""
    bins = lambda a: F.transform(a, lambda x: F.shiftright(x, BIN_SHIFT))
    return F.size(F.array_intersect(left, right)) / F.size(F.array_union(bins(left), bins(right)))


def as_text(sketches: str) -> Column:
    return F.array_join(F.transform(sketches, lambda x: F.lower(F.lpad(F.hex(x), 16, "0"))), "")


def successors(docs: DataFrame) -> DataFrame:
    """(id, next_id, n_chars): each distinct id, the next lower one (the highest after the
    lowest), and the most characters of its texts. A missing id is the lowest of all.

    Ids are cut into ranges; inside a range the next id is a window away, and the last of
    a range is followed by the first of the next range that has any. Only one row a range
    is ordered as a whole.
    """
    ids = docs.select(key().alias("id"), F.length(text()).alias("n")).groupBy("id").agg(F.max("n").alias("n_chars"))
    ranged = stored(
        ids.repartitionByRange(F.desc("id")).withColumn("part", F.spark_partition_id()), "fingerprint-ids"
    )
    heads = ranged.groupBy("part").agg(F.max("id").alias("head"))
    after = F.lead("head").over(Window.orderBy("part"))
    whole = F.max("head").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = heads.select("part", F.coalesce(after, whole).alias("after"))
    inside = F.lead("id").over(Window.partitionBy("part").orderBy(F.desc("id")))
    return (
        ranged.withColumn("inside", inside).join(heads, "part")
        .select("id", F.coalesce("inside", "after").alias("next_id"), "n_chars")
    )


def key(name: str = "doc_id") -> Column:
    return F.coalesce(F.col(name).cast("bigint"), F.lit(MISSING))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Each row of ``docs`` (doc_id, text) fingerprinted beside its edited text.

    The edited text has the last half of the code points (rounded down) replaced by as
    many, or all, of the first of the next document in descending doc_id; after the last
    comes the first. Returns doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited and near_next. A null text is an empty one. Rows that
    share a doc_id each get a row; the next document of such an id is its least text.
    """
    # Both joins read this by the same key, so its exchange is made once and used twice.
    base = fingerprinted(docs.select(key().alias("id"), text().alias("text")), "text", "sketches")
    pairs = stored(successors(docs), "fingerprint-pairs")
    before = F.lag("id").over(Window.partitionBy("id").orderBy("text"))
    following = base.withColumn("before", before).filter("before is null").select(
        F.col("id").alias("next_id"), F.col("text").alias("next_text"), F.col("sketches").alias("next_sketches")
    )
    heads = pairs.join(following, "next_id").select(
        "id", F.left("next_text", F.floor(F.col("n_chars") / 2).cast("int")).alias("head"), "next_sketches"
    )
    length, half = F.length("text"), F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.left("text", length - half), F.left("head", half))
    whole = fingerprinted(base.join(heads, "id").withColumn("edited", edited), "edited", "edited_sketches")
    return whole.select(
        F.when(F.col("id") != MISSING, F.col("id")).alias("doc_id"),
        length.cast("bigint").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text("sketches").alias("fingerprint"),
        as_text("edited_sketches").alias("edited_fingerprint"),
        likeness("sketches", "edited_sketches").alias("near_edited"),
        likeness("sketches", "next_sketches").alias("near_next"),
    )
