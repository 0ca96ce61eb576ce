"""Phrase collocations, by merging sorted streams of counts.

1. Order by order, each task lower-cases A to Z, cuts its texts into pieces and words, and
   counts the runs of one, two or three words within pieces, a few megabytes of text at a
   time, so that a frequent phrase leaves a task as one number per few megabytes. Words are
   told apart by themselves, not by hashes. Order 0 counts all words of a language.
2. Counts are summed by phrase. A phrase is at most as frequent as its parts, so what is
   rarer than a candidate is dropped there, and the next order is counted only where both
   parts may be frequent: tasks have a bit for each frequent one. The bits only spare work;
   counts are exact, and what goes on is short beside the corpus.
3. Counts form a stream per order, read in two orders. Longer phrases in prefix order are
   merged in lockstep with their beginnings, which gives left counts, and in suffix order
   with their ends, which gives right counts; going the other way, the greatest count of a
   three-word stream in either order tells the pairs what extends them. All of these are
   sort-merge joins of sorted streams; no side is held in a hash table, and adaptive
   execution splits a run of one frequent word among tasks.
4. The cut of least score counts, in exact integers. Each language's first phrases are
   ranked after every task has kept no more than so many of its own.

Defined results: a missing text is empty, a missing lang is ``und``, one with that name
too; empty texts and tables give no phrases; repeated rows count each. Only lang and text
are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barline.llm.tables import stored, text
from barline.llm.words import GOLDEN, bounds, chunks, mix, raw, run_hashes

# What cuts texts and pieces, and the language of texts that name none.
PIECE_ENDS, BLANKS, NO_LANG = b".,;:!?\n\x0b\x0c\r", b" \t", "und"
SCALE = 1_000_000
CHUNK_BYTES = 4 << 20
SLICE_ROWS = 50_000
MARK_BITS = 26

KIND = np.zeros(256, np.uint8)
KIND[list(BLANKS)], KIND[list(PIECE_ENDS)] = 1, 2
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(words, the text each is in, whether the next one follows it in its piece)."""
    data, offsets = raw(texts)
    data = LOWER[data]
    kind = KIND[data]
    first, last = bounds(kind == 0, offsets)
    owner = np.searchsorted(offsets, first, "right") - 1
    piece = np.searchsorted(np.flatnonzero(kind == 2), first)
    follows = np.zeros(len(first), bool)
    if len(first):
        follows[:-1] = (piece[1:] == piece[:-1]) & (owner[1:] == owner[:-1])
    ends = np.concatenate([[0], np.cumsum(last - first + 1)]).astype(np.int64)
    inside = np.ascontiguousarray(data[kind == 0])
    words = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(ends), pa.py_buffer(inside))
    return words, owner, follows


def hashes(texts: pa.Array) -> np.ndarray:
    data, offsets = raw(texts)
    out = run_hashes(data, offsets[:-1], np.maximum(offsets[1:] - 1, 0)) if len(data) else np.zeros(len(texts), np.uint64)
    return np.where(np.diff(offsets) > 0, out, GOLDEN)


class Marks:
    """Which phrases of one order may be frequent: a bit for each frequent one, of a number
    that does not grow with the corpus. Bits that others share let a rare phrase pass, which
    its exact count then drops; no frequent one is lost."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def __getitem__(self, found: np.ndarray) -> np.ndarray:
        at = found >> np.uint64(64 - MARK_BITS)
        return (self.bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def counted(langs: pa.Array, texts: pa.Array, order: int, marks: Marks | None = None) -> Iterator[pa.RecordBatch]:
    """The phrases of ``order`` words in some texts with their counts, as rows (phrase, n);
    a phrase begins with its language and a line feed. Order 1 counts order 0 too.

    With ``marks`` of the order before, only phrases whose parts of that order are marked.
    """
    words, owner, follows = words_of(texts)
    if len(words) == 0:
        return
    langs, words = dictionary(langs), dictionary(words)
    lang, word = langs.indices.to_numpy()[owner].astype(np.int64), words.indices.to_numpy().astype(np.int64)
    many = len(words.dictionary)
    one, at, n = np.unique(lang * many + word, return_inverse=True, return_counts=True)
    held = (langs.dictionary, words.dictionary)
    lang_of, word_of = one // many, one % many
    if order == 1:
        yield from rows(*held, np.arange(len(langs.dictionary)), [], np.bincount(lang, minlength=len(langs.dictionary)))
        yield from rows(*held, lang_of, [word_of], n)
        return
    begins = np.flatnonzero(follows)
    marked = None
    if marks is not None:
        marked = mix(hashes(words.dictionary)[word_of] + GOLDEN * hashes(langs.dictionary)[lang_of])
        if order == 2:
            frequent = marks[marked][at]
            begins = begins[frequent[begins] & frequent[begins + 1]]
    pairs = at[begins] * len(one) + at[begins + 1]
    if order == 2:
        two, n = np.unique(pairs, return_counts=True)
        heads, tails = two // len(one), two % len(one)
        yield from rows(*held, lang_of[heads], [word_of[heads], word_of[tails]], n)
        return
    two, pair = np.unique(pairs, return_inverse=True)
    heads, tails = two // len(one), two % len(one)
    longer = np.flatnonzero(follows[begins + 1])  # pairs whose last word another follows
    if marks is not None:
        frequent = marks[joint(marked[heads], marked[tails])][pair]
        longer = longer[frequent[longer]]
        longer = longer[frequent[longer + 1]]  # the pair that begins at the last word's place
    three, n = np.unique(pair[longer] * len(one) + at[begins[longer] + 2], return_counts=True)
    parts = [two[three // len(one)] // len(one), two[three // len(one)] % len(one), three % len(one)]
    yield from rows(*held, lang_of[parts[0]], [word_of[x] for x in parts], n)


def joint(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(mix(first + GOLDEN) + second)


def dictionary(values: pa.Array) -> pa.DictionaryArray:
    found = values.dictionary_encode()
    return found.combine_chunks() if isinstance(found, pa.ChunkedArray) else found


def rows(langs: pa.Array, words: pa.Array, lang: np.ndarray, said: list[np.ndarray], n: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Phrases, a slice at a time, from the places of their languages and words."""
    blank, feed = pa.scalar(" ", pa.large_string()), pa.scalar("\n", pa.large_string())
    for low in range(0, len(n), SLICE_ROWS):
        part = slice(low, low + SLICE_ROWS)
        phrase = [words.take(pa.array(x[part])) for x in said]
        phrase = pc.binary_join_element_wise(*phrase, blank) if phrase else pa.array([""] * len(lang[part]), pa.large_string())
        phrase = pc.binary_join_element_wise(langs.take(pa.array(lang[part])), phrase, feed)
        yield pa.record_batch([phrase, pa.array(n[part], pa.int64())], names=["phrase", "n"])


def tally(order: int, marks=None):
    """Counts of one order over batches of (lang, text); ``marks`` is a broadcast of bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Marks(marks.value) if marks is not None else None
        for batch in batches:
            low = 0
            for part in chunks(batch.column(1), CHUNK_BYTES):
                yield from counted(batch.column(0).slice(low, len(part)).cast(pa.large_string()), part, order, known)
                low += len(part)
                pa.default_memory_pool().release_unused()

    return run


def marks_of(frequent: DataFrame, order: int):
    """The bits of frequent phrases, set by tasks, put together by Spark and broadcast: at
    most 2 to the ``MARK_BITS`` of them."""

    def hash_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, *words = (hashes(c.cast(pa.large_string())) for c in batch.columns)
            found = [mix(w + GOLDEN * lang) for w in words]
            at = (found[0] if order == 1 else joint(*found)) >> np.uint64(64 - MARK_BITS)
            yield pa.record_batch([pa.array(at.astype(np.int64))], names=["at"])

    given = frequent.select("lang", *(f"w{i + 1}" for i in range(order)))
    bits = given.mapInArrow(hash_up, "at bigint").groupBy(F.shiftright("at", 6).alias("slot")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits")
    ).toArrow()
    out = np.zeros(1 << (MARK_BITS - 6), np.uint64)
    out[bits.column("slot").to_numpy()] = bits.column("bits").to_numpy().view(np.uint64)
    return frequent.sparkSession.sparkContext.broadcast(out)


def counts(docs: DataFrame, least: int = 10) -> list[DataFrame]:
    """Four streams of counts, stored: (lang, n) of all words, then (lang, w1, n),
    (lang, w1, w2, n) and (lang, w1, w2, w3, n) of what occurs ``least`` times.

    A phrase is at most as frequent as its parts, so an order is counted only where both
    parts of the order before may be frequent. What is shuffled is so kept to a fraction of
    all runs of three words, nearly all of which are rare."""
    given = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"), text().alias("text"))
    streams: list[DataFrame] = []
    known = None
    for order in (1, 2, 3):
        each = given.mapInArrow(tally(order, known), "phrase string, n bigint")
        summed = each.groupBy("phrase").agg(F.sum("n").alias("n"))
        said = F.substring_index("phrase", "\n", -1)
        lang = F.expr("left(phrase, length(phrase) - length(substring_index(phrase, '\n', -1)) - 1)")
        words = F.split(said, " ")
        kept = stored(
            summed.filter((F.col("n") >= least) | (said == "")).select(
                lang.alias("lang"), *(F.get(words, F.lit(i)).alias(f"w{i + 1}") for i in range(order)), "n"
            ),
            f"phrases-{order}",
        )
        if order == 1:
            streams.append(kept.filter("w1 = ''").select("lang", "n"))
            kept = kept.filter("w1 <> ''")
        streams.append(kept)
        if order < 3:
            known = marks_of(kept, order)
    return streams


def merged(longer: DataFrame, shorter: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Two sorted streams in lockstep."""
    return longer.join(shorter.hint("merge"), on, how)


def scored(streams: list[DataFrame], share: int = 50) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the candidates that no longer one covers."""
    one, two, three = streams
    # Pairs: prefix order beside first words, suffix order beside last words.
    pairs = merged(two, one.select("lang", "w1", F.col("n").alias("n1")), ["lang", "w1"])
    pairs = merged(pairs, one.select("lang", F.col("w1").alias("w2"), F.col("n").alias("n2")), ["lang", "w2"])
    # Triples: prefix order beside first pairs, suffix order beside last pairs.
    begins = pairs.select("lang", "w1", "w2", F.col("n").alias("n12"), "n1")
    ends = pairs.select(
        "lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("n").alias("n23"), F.col("n2").alias("n3")
    )
    triples = merged(merged(three, begins, ["lang", "w1", "w2"]), ends, ["lang", "w2", "w3"])
    cuts = [(F.col("n1"), F.col("n23")), (F.col("n12"), F.col("n3"))]
    marks = [score(F.col("n"), left, right) for left, right in cuts]
    second = marks[1] < marks[0]
    triples = triples.select(
        "lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), F.col("n").alias("a"),
        F.when(second, cuts[1][0]).otherwise(cuts[0][0]).alias("l"),
        F.when(second, cuts[1][1]).otherwise(cuts[0][1]).alias("r"),
        F.least(*marks).alias("score"),
    )
    # Extensions: the most frequent triple after a pair in prefix order, before it in suffix order.
    after = three.groupBy("lang", "w1", "w2").agg(F.max("n").alias("after"))
    before = three.groupBy("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2")).agg(F.max("n").alias("before"))
    pairs = merged(merged(pairs, after, ["lang", "w1", "w2"], "left"), before, ["lang", "w1", "w2"], "left")
    longest = F.greatest(F.coalesce("after", F.lit(0)), F.coalesce("before", F.lit(0)))
    pairs = pairs.filter(longest * 100 < F.col("n") * share).select(
        "lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), F.col("n").alias("a"), F.col("n1").alias("l"),
        F.col("n2").alias("r"), score(F.col("n"), F.col("n1"), F.col("n2")).alias("score"),
    )
    return pairs.unionByName(triples)


def score(both: Column, left: Column, right: Column) -> Column:
    """floor(SCALE * both * both / (left * right)), exact: counts are below 10 to the 15th."""
    both, left, right = (x.cast("decimal(15,0)") for x in (both, left, right))
    return F.call_function("div", both * both * F.lit(SCALE).cast("decimal(7,0)"), left * right)


def collocations(docs: DataFrame, least: int = 10, share: int = 50, top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases."""
    totals, *streams = counts(docs, least)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = scored(streams, share).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
