"""Near duplicates by BagMinHash signatures, bands and a check of the real overlap.

A text is the multiset of its runs of five words. BagMinHash sees the weight of
a shingle as an interval of that length, cut at the powers of two. Each piece
holds a Poisson process of points in time; a point lies at a place in the piece
and belongs to one register of the signature, and counts for every text whose
weight reaches beyond its place. A register keeps its earliest point, so two
texts agree in it with a probability equal to their weighted Jaccard
similarity, without bias. Points are drawn in order of time and only until
they are later than the latest register, so a text costs little more than one
point for each distinct shingle and piece.

Four registers are a band: of texts with a similarity of 0.8, one pair in ten
million shares none of the 30 bands. Texts that share a band, or two bands side
by side, are compared with the least of their bucket, never with each other, so
candidates grow with the texts and not with the square of a bucket. The double
bands give a large bucket many leaders. The multiset overlap of each candidate
pair is then computed from the whole texts.

Where many texts are nearly alike, as those of one template are, most are unlike
the leader of their bucket and may be like each other. Texts of which some pair
was refused are dealt once more, by 300 keys of four bands: buckets so fine that
they are small even there, each with a leader of its own, drawn by hash so that
leaders differ. That adds at most 300 candidates a text. Components of all pairs
that reach the threshold are the classes.

What is joined with texts grows with them and has no bound, so those joins ask for a
sort-merge join at every size.
"""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barline.llm.components import components
from barline.llm.tables import ROW, digest, numbered_once, stored, text
from barline.llm.words import GOLDEN, chunks, mix, multisets, word_hashes

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BANDS, BAND_ROWS = 30, 4
REGISTERS = BANDS * BAND_ROWS
POINTS_AT_ONCE = 1 << 18
# Keys for texts that a leader refused: sets of four bands, drawn once.
FINE_KEYS, FINE_BANDS = 300, 4
FINE = sorted(sorted(random.Random(f"fine {i}").sample(range(BANDS), FINE_BANDS)) for i in range(FINE_KEYS))


def pieces(owner: np.ndarray, shingle: np.ndarray, weight: np.ndarray):
    """Cut [0, weight) at 1, 2, 4, ...: (text, seed, lower end, length, weight) per piece."""
    levels = 1 + np.ceil(np.log2(weight)).astype(np.int64)
    cell = np.repeat(np.arange(len(owner)), levels)
    level = np.arange(levels.sum()) - np.repeat(np.cumsum(levels) - levels, levels)
    lower = np.where(level == 0, 0, 1 << np.maximum(level - 1, 0))
    length = np.where(level == 0, 1, lower)
    seed = mix(shingle[cell] + GOLDEN * (level.astype(np.uint64) + np.uint64(1)))
    return owner[cell], seed, lower, length, weight[cell]


def signatures(words: np.ndarray, starts: np.ndarray, k: int = SHINGLE_WORDS, m: int = REGISTERS) -> np.ndarray:
    """The earliest point of each register, per text; infinite where a text has no word."""
    texts = len(starts) - 1
    registers = np.full(texts * m, np.inf)
    owner, seed, lower, length, weight = pieces(*multisets(words, starts, k))
    time, drawn = np.zeros(len(owner)), 0
    while len(owner):
        n = int(np.clip(POINTS_AT_ONCE // len(owner), 1, 64))
        steps = np.arange(drawn, drawn + n, dtype=np.uint64) * np.uint64(2)
        first = mix(seed[:, None] + GOLDEN * (steps + np.uint64(1)))
        second = mix(seed[:, None] + GOLDEN * (steps + np.uint64(2)))
        gap = -np.log(((first >> np.uint64(11)).astype(np.float64) + 1.0) / 2.0**53)
        times = time[:, None] + np.cumsum(gap / length[:, None], axis=1)
        register = ((second >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
        place = (second & np.uint64(0xFFFFFFFF)).astype(np.float64) / 2.0**32
        reached = lower[:, None] + np.floor(place * length[:, None]) < weight[:, None]
        slot = owner[:, None] * m + register.astype(np.int64)
        np.minimum.at(registers, slot[reached], times[reached])
        time, drawn = times[:, -1], drawn + n
        latest = registers.reshape(texts, m).max(axis=1)
        alive = time < latest[owner]
        owner, seed, lower, length, weight, time = (
            x[alive] for x in (owner, seed, lower, length, weight, time)
        )
    return registers.reshape(texts, m)


@F.arrow_udf(T.ArrayType(T.LongType()))
def band_hashes(texts: pa.Array) -> pa.Array:
    """One hash per band of each text's signature; none for a text without words."""
    values, sizes = [], []
    for part in chunks(texts):
        words, starts = word_hashes(part)
        bits = signatures(words, starts).view(np.uint64).reshape(len(part), BANDS, BAND_ROWS)
        bands = np.zeros(bits.shape[:2], np.uint64)
        for i in range(BAND_ROWS):
            bands = mix(bands + GOLDEN + bits[:, :, i])
        some = np.diff(starts) > 0
        values.append(bands[some].ravel().view(np.int64))
        sizes.append(np.where(some, BANDS, 0))
    if not sizes:
        return pa.array([], pa.list_(pa.int64()))
    ends = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(values)))


@F.arrow_udf(T.DoubleType())
def overlap(left: pa.Array, right: pa.Array) -> pa.Array:
    """Weighted Jaccard similarity of the shingle multisets of two texts."""
    out = []
    for a, b in zip(left, right, strict=True):
        keys, counts = [], []
        for value in (a, b):
            _, shingle, count = multisets(*word_hashes(pa.array([value.as_py() or ""], pa.large_string())), SHINGLE_WORDS)
            keys.append(shingle)
            counts.append(count)
        _, i, j = np.intersect1d(*keys, assume_unique=True, return_indices=True)
        shared = np.minimum(counts[0][i], counts[1][j]).sum()
        total = counts[0].sum() + counts[1].sum() - shared
        out.append(float(shared / total) if total else 0.0)
    return pa.array(out, pa.float64())


def candidates(nodes: DataFrame) -> DataFrame:
    """Pairs (node, leader) of the texts that share a band or two neighbouring bands, and
    whether any bucket they share is crowded: holds a third text."""
    single = F.transform("bands", lambda x, i: F.xxhash64(i, x))
    double = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 2), F.lit(2)),
        lambda i: F.xxhash64(F.lit("two"), i, F.get("bands", i), F.get("bands", i + 1)),
    )
    keyed = nodes.filter(F.size("bands") > 0).select(
        "node", F.explode(F.concat(single, double)).alias("bucket")
    )
    leaders = stored(
        keyed.groupBy("bucket").agg(F.min("node").alias("leader"), F.count("*").alias("n"))
        .filter("n > 1").select("bucket", "leader", (F.col("n") > 2).alias("crowded")),
        "neardup-leaders",
    )
    pairs = keyed.join(leaders, "bucket").filter("node <> leader")
    return pairs.groupBy("node", "leader").agg(F.max("crowded").alias("crowded"))


def fine_candidates(nodes: DataFrame, compared: DataFrame) -> DataFrame:
    """Pairs (node, leader), not compared yet, of the texts of refused pairs that share all
    bands of one of the fine keys. ``compared`` has every pair so far and whether it is alike.
    A bucket of two has no pair but the compared one, so only crowded ones count."""
    refused = compared.filter(~F.col("alike") & F.col("crowded"))
    doubted = stored(refused.select("node").union(refused.select("leader")).distinct(), "neardup-doubted")
    sets = F.array(*(F.array(*(F.lit(b) for b in bands)) for bands in FINE))
    key = lambda x, i: F.xxhash64(F.lit("fine"), i, *(F.get("bands", F.get(x, j)) for j in range(FINE_BANDS)))
    keyed = nodes.join(doubted.hint("merge"), "node", "left_semi").select("node", F.explode(F.transform(sets, key)).alias("bucket"))
    leaders = stored(
        keyed.groupBy("bucket").agg(F.min_by("node", F.xxhash64("bucket", "node")).alias("leader"), F.count("*").alias("n"))
        .filter("n > 1").select("bucket", "leader"),
        "neardup-fine-leaders",
    )
    pairs = keyed.join(leaders.hint("merge"), "bucket").filter("node <> leader").select("node", "leader").distinct()
    either = compared.select("node", "leader").union(compared.select("leader", "node"))
    return pairs.join(either.hint("merge"), ["node", "leader"], "left_anti")


def compared(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """``pairs`` with ``alike``: whether the overlap of their whole texts reaches ``similarity``."""
    return (
        pairs.join(texts.withColumnRenamed("text", "left_text").hint("merge"), "node")
        .join(texts.select(F.col("node").alias("leader"), F.col("text").alias("right_text")).hint("merge"), "leader")
        .select(*pairs.columns, (overlap("left_text", "right_text") >= similarity).alias("alike"))
    )


def spanning(alike: DataFrame) -> DataFrame:
    """Links (a, b) that hold together what the pairs (node, leader) do, and are far fewer
    where many texts share many leaders: a node keeps its least leader, and that one takes
    the others, in links that all such nodes have in common. A node has a leader a key at
    most, 345 of them, which bounds what is gathered for one."""
    gathered = alike.groupBy("node").agg(F.sort_array(F.collect_set("leader")).alias("leaders"))
    ends = F.concat(F.array("node"), F.slice("leaders", 2, F.size("leaders")))
    return gathered.select(F.explode(ends).alias("a"), F.get("leaders", F.lit(0)).alias("b")).distinct()


def classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with the class of its near duplicates.

    Returns the row's number, doc_id, class_id (the least doc_id of the class), class_size and
    keep, which is true for one row of each class: that with the least doc_id, and of
    equal ids the first. Rows with equal texts are one class. A null text is an empty one;
    a text without words is near no other, so its row is a class of its own.
    """
    rows = numbered_once(docs.select("doc_id", "text", *({ROW} & {*docs.columns})), "neardup-rows")
    rows = rows.select(ROW, F.col("doc_id").cast("bigint").alias("doc_id"), text().alias("text"))
    signed = stored(
        rows.select(ROW, "doc_id", digest(F.col("text")).alias("node"), band_hashes("text").alias("bands")),
        "neardup-signatures",
    )
    nodes = signed.groupBy("node").agg(F.first("bands").alias("bands"))
    pairs = stored(candidates(nodes), "neardup-candidates")
    wanted = pairs.select("node").union(pairs.select("leader")).distinct()
    texts = rows.select(digest(F.col("text")).alias("node"), "text").join(wanted.hint("merge"), "node", "left_semi")
    texts = stored(texts.dropDuplicates(["node"]), "neardup-texts")
    first = stored(compared(pairs, texts, similarity), "neardup-compared")
    # Its texts are of refused pairs, so they are among those of the first.
    second = stored(compared(fine_candidates(nodes, first), texts, similarity), "neardup-compared")
    alike = first.drop("crowded").union(second).filter("alike").select("node", "leader")
    found = components(stored(spanning(alike), "neardup-links"))
    # A text without words must not share a class with another row.
    own = F.when(F.size("bands") == 0, F.concat(F.lit("row"), F.col(ROW).cast("string")).cast("binary"))
    labelled = stored(
        signed.join(found, "node", "left").select(
            ROW, "doc_id", F.coalesce(own, F.col("label"), F.col("node")).alias("label")
        ),
        "neardup-labels",
    )
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", ROW)).alias("first")
    heads = stored(labelled.groupBy("label").agg(first, F.count("*").alias("class_size")), "neardup-heads")
    return labelled.join(heads, "label").select(
        ROW, "doc_id", F.col("first.doc_id").alias("class_id"), "class_size",
        (F.col(ROW) == F.col(f"first.{ROW}")).alias("keep"),
    )


def drop_near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` without those that a lesser doc_id of their class stands for."""
    rows = numbered_once(docs, "neardup-rows")
    gone = classes(rows, similarity).filter(~F.col("keep")).select(ROW)
    return rows.join(stored(gone, "neardup-gone").hint("merge"), ROW, "left_anti").select(docs.columns)
