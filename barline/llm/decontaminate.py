"""Benchmark decontamination by latent semantic retrieval.

1. Document frequencies of hashed terms are counted over every text.
2. The benchmark is cut into passages of at most 40 words and weighted by TF-IDF. A
   randomised SVD gives their latent space, by blocks of about 256 passages: a task
   multiplies the matrix of its block with random vectors, and again after each
   orthonormalisation. The driver gathers the spaces of the eight blocks that are
   searched in one pass over the texts.
3. Every text is cut into windows of 40 words, half overlapping. A window's TF-IDF
   vector is folded into the latent space; items with a cosine over the limit are
   candidates. Windows whose terms could not reach the limit beside any item, by the most
   that any item has of each term, are skipped, which is exact.
4. Around a candidate window the longest common subsequence of words with the item must
   reach 80 % of the item; or 50 %, if the item's last sentence, its answer, is there
   too, which is how a paraphrase of the question gives itself away.

An item or text shorter than a window is one window.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barline.llm.tables import ROW, numbered_once, stored, text
from barline.llm.words import GOLDEN, chunks, mix, word_hashes

FEATURE_BITS = 18
FEATURES = 1 << FEATURE_BITS
HALF_WINDOW = 20
BLOCK = 256
BLOCKS_A_PASS = 8  # searched in one pass over the texts: a task holds so many blocks
OVERSAMPLE, POWER_STEPS = 8, 1
ENERGY = 0.999
COSINE = 0.3
VERBATIM, PARAPHRASE, ANSWER = 0.8, 0.5, 0.8


def features(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)


# --- corpus statistics -------------------------------------------------------------


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """How many texts have each hashed term, and how many texts there are.

    Each task sums its own texts; what comes to the driver is one number a feature.
    """

    def count(batches):
        seen, total = np.zeros(FEATURES, np.int64), 0
        for batch in batches:
            for part in chunks(batch.column(0)):
                words, starts = word_hashes(part)
                owner = np.repeat(np.arange(len(part)), np.diff(starts))
                keys = np.unique((owner << FEATURE_BITS) | features(words))
                seen += np.bincount(keys & (FEATURES - 1), minlength=FEATURES)
                total += len(part)
        at = np.flatnonzero(seen)
        yield pa.record_batch(
            [pa.array(np.append(at, -1)), pa.array(np.append(seen[at], total))], names=["feature", "n"]
        )

    counted = docs.select(text().alias("text")).mapInArrow(count, "feature bigint, n bigint")
    rows = counted.groupBy("feature").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(FEATURES, np.int64)
    real = rows[rows.feature >= 0]
    out[real.feature.to_numpy()] = real.n.to_numpy()
    return out, int(rows[rows.feature < 0].n.sum())


# --- the benchmark's latent space ---------------------------------------------------


def passages(benchmark: DataFrame, idf: np.ndarray) -> DataFrame:
    """(passage, item_id, terms, weights): unit TF-IDF vectors of the items' windows.

    Passages are numbered from 0 by item and place."""

    def cut(batches):
        for batch in batches:
            for item, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words, _ = word_hashes(pa.array([value], pa.large_string()))
                for at in window_starts(len(words)):
                    terms, counts = np.unique(features(words[at : at + 2 * HALF_WINDOW]), return_counts=True)
                    weights = counts * idf[terms]
                    norm = np.linalg.norm(weights)
                    if norm > 0:
                        yield pa.RecordBatch.from_pylist(
                            [{"item_id": item, "at": at, "terms": terms.tolist(), "weights": (weights / norm).tolist()}],
                            schema,
                        )

    schema = pa.schema(
        [("item_id", pa.int64()), ("at", pa.int64()), ("terms", pa.list_(pa.int64())), ("weights", pa.list_(pa.float64()))]
    )
    items = benchmark.select(item_id(), text().alias("text")).distinct()
    return items.mapInArrow(cut, "item_id bigint, at bigint, terms array<bigint>, weights array<double>")


def item_id() -> Column:
    return F.coalesce(F.col("item_id").cast("bigint"), F.lit(-1)).alias("item_id")


def window_starts(n: int) -> range:
    return range(0, max(n - HALF_WINDOW, 1) if n else 0, HALF_WINDOW)


def random_rows(terms: np.ndarray, width: int) -> np.ndarray:
    """A row of standard normal numbers per term, the same wherever it is drawn."""
    seeds = mix(terms.astype(np.uint64) * GOLDEN + GOLDEN)[:, None] + np.arange(width, dtype=np.uint64) * GOLDEN
    unit = lambda salt: ((mix(seeds ^ np.uint64(salt)) >> np.uint64(11)).astype(np.float64) + 1) / 2.0**53
    return np.sqrt(-2 * np.log(unit(0))) * np.cos(2 * np.pi * unit(1 << 40))


def latent_space(row: np.ndarray, term: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(terms, V): the leading right singular vectors of the passages of a block, whose
    matrix has ``weight`` at (``row``, ``term``)."""
    size = int(row.max()) + 1
    terms, place = np.unique(term, return_inverse=True)
    a = np.zeros((size, len(terms)))
    a[row, place] = weight
    product = a.T @ (a @ random_rows(terms, size + OVERSAMPLE))
    for _ in range(POWER_STEPS):
        q, _ = np.linalg.qr(product)
        product = a.T @ (a @ q)
    q, _ = np.linalg.qr(product)
    product = a.T @ (a @ q)
    values, vectors = np.linalg.eigh(q.T @ product)
    order = np.argsort(values)[::-1]
    energy = np.cumsum(np.maximum(values[order], 0))
    k = min(len(order), 1 + int(np.searchsorted(energy, ENERGY * energy[-1])))
    return terms, (q @ vectors[:, order[:k]]).astype(np.float32)


SPACE = "block bigint, terms binary, folded binary, queries binary, owners binary"


def space(block: pd.DataFrame) -> pd.DataFrame:
    """A row of ``SPACE``: the latent space of a block of passages, and the passages in it."""
    block = block.sort_values(["item_id", "at"], ignore_index=True)
    sizes = block.terms.map(len).to_numpy()
    row, term, weight = np.repeat(np.arange(len(block)), sizes), np.concatenate(block.terms), np.concatenate(block.weights)
    terms, v = latent_space(row, term, weight)
    queries = np.zeros((len(block), v.shape[1]))
    np.add.at(queries, row, v[np.searchsorted(terms, term)] * weight[:, None])
    queries /= np.maximum(np.linalg.norm(queries, axis=1), 1e-9)[:, None]
    return pd.DataFrame([{
        "block": block.block[0], "terms": terms.astype(np.int64).tobytes(), "folded": v.tobytes(),
        "queries": queries.astype(np.float32).tobytes(), "owners": block.item_id.to_numpy(np.int64).tobytes(),
    }])


# --- search and check ----------------------------------------------------------------


def common_subsequence(left: list, right: list) -> int:
    """Length of the longest common subsequence, a bit of one integer per left element."""
    places: dict = {}
    for i, x in enumerate(left):
        places[x] = places.get(x, 0) | 1 << i
    full = (1 << len(left)) - 1
    row = full
    for x in right:
        hit = row & places.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(left) - row.bit_count()


def is_leak(item: list, answer: list, region: list) -> float:
    """The share of the item found in order, if that makes a leak, else 0."""
    share = common_subsequence(item, region) / len(item)
    if share >= VERBATIM:
        return share
    if share >= PARAPHRASE and answer and common_subsequence(answer, region) >= ANSWER * len(answer):
        return share
    return 0.0


HITS = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("share", T.DoubleType())]))


def searcher(models: Sequence[dict]):
    """A column function from texts to the items of some blocks found in them; a text is
    hashed and cut into windows once for all of them."""

    @F.arrow_udf(HITS)
    def search(texts: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("item_id", pa.int64()), ("share", pa.float64())]))
        out: list[list] = []
        for part in chunks(texts):
            words, starts = word_hashes(part)
            found: list[dict] = [{} for _ in range(len(part))]
            cut = Windows(words, starts, models[0]["idf"])
            for model in models:
                for doc, low, high, item in cut.candidates(model):
                    for wanted, answer in model["items"][item]:
                        reach = len(wanted)
                        region = words[max(starts[doc], low - reach) : min(starts[doc + 1], high + reach)].tolist()
                        share = is_leak(wanted, answer, region)
                        if share > found[doc].get(item, 0.0):
                            found[doc][item] = share
            out.extend([{"item_id": i, "share": s} for i, s in sorted(f.items())] for f in found)
        return pa.array(out, kind)

    return search


class Windows:
    """The windows of some texts, and the weight of each, whatever they are searched for."""

    def __init__(self, words: np.ndarray, starts: np.ndarray, idf: np.ndarray):
        self.idf, self.starts = idf, starts
        sizes = np.diff(starts)
        halves = -(-sizes // HALF_WINDOW)
        self.owner = np.repeat(np.arange(len(sizes)), halves)
        within = np.arange(halves.sum()) - np.repeat(np.cumsum(halves) - halves, halves)
        self.low = starts[:-1][self.owner] + within * HALF_WINDOW
        self.terms = features(words)
        self.weights = idf[self.terms]
        # A window is a half and the next of the same text; the last half of several is no window.
        self.paired = np.append(self.owner[1:] == self.owner[:-1], False) if len(self.owner) else np.zeros(0, bool)
        self.window = self.paired | (within == 0)
        self.least_norm = np.sqrt(self.summed(self.weights**2))  # repeated terms only raise a norm

    def summed(self, x: np.ndarray) -> np.ndarray:
        """Sums over each half's window."""
        if len(self.low) == 0:
            return np.zeros(0)
        x = np.add.reduceat(x, self.low)
        return x + np.where(self.paired, np.append(x[1:], 0), 0)

    def candidates(self, model: dict):
        """(text number, first word, end, item) of the windows near an item of a block."""
        if len(self.low) == 0:
            return
        idf, lookup, folded, queries, owners = self.idf, *(model[x] for x in ("lookup", "folded", "queries", "owners"))
        # No item's vector has more of a term than ``reach``, so what the window's terms could
        # add up to beside any item bounds its cosine; the cosine itself decides.
        most = self.summed(self.weights * model["reach"][self.terms])
        at = np.flatnonzero(self.window & (most > 0) & (most >= (COSINE - 1e-3) * self.least_norm))
        for some in np.array_split(at, max(1, len(at) // 4096)):
            if len(some) == 0:
                continue
            first = self.low[some]
            end = np.minimum(first + 2 * HALF_WINDOW, self.starts[1:][self.owner[some]])
            count = end - first
            place = np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            keys = np.repeat(np.arange(len(some)), count) << FEATURE_BITS | self.terms[place]
            keys, tf = np.unique(keys, return_counts=True)
            which, term = keys >> FEATURE_BITS, keys & (FEATURES - 1)
            value = (tf * idf[term]).astype(np.float32)
            norm = np.sqrt(np.bincount(which, value.astype(np.float64) ** 2, len(some)))
            inside = lookup[term] >= 0
            inner = np.sqrt(np.bincount(which[inside], value[inside].astype(np.float64) ** 2, len(some)))
            good = inner >= COSINE * norm  # no item can be nearer than the part it could share
            take = inside & good[which]
            if not take.any():
                continue
            rows, begin = np.unique(which[take], return_index=True)
            latent = np.add.reduceat(folded[lookup[term[take]]] * value[take, None], begin)
            near = (latent @ queries.T) / np.maximum(norm[rows], 1e-9)[:, None]
            for i, q in zip(*np.nonzero(near >= COSINE), strict=True):
                w = rows[i]
                yield int(self.owner[some[w]]), int(first[w]), int(end[w]), int(owners[q])


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(a row's number, doc_id, item_id, share) of every benchmark item found in a row of ``docs``.

    Null texts and items are empty: they hold nothing and are found nowhere. An item in
    which every term stands in every text has no weight and is not searched. Repeated items
    count once; of several texts with one item_id any counts. A missing item_id is -1.
    """
    rows = numbered_once(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text().alias("text")), "leaks-rows")
    found = docs.sparkSession.createDataFrame([], f"{ROW} bigint, doc_id bigint, item_id bigint, share double")
    for some in models(rows, benchmark):
        hits = rows.select(ROW, "doc_id", F.explode(searcher(some)("text")).alias("hit"))
        found = found.union(hits.select(ROW, "doc_id", "hit.item_id", "hit.share"))
    return found.groupBy(ROW, "doc_id", "item_id").agg(F.max("share").alias("share"))


def models(docs: DataFrame, benchmark: DataFrame):
    """What the search needs of the benchmark's blocks, those of one pass after the other."""
    seen, total = document_frequencies(docs)
    idf = np.log((total + 1) / (seen + 1.0)) + 1e-3
    cut = stored(passages(benchmark, idf), "leaks-passages")
    blocks = -(-cut.count() // BLOCK)
    # Blocks are dealt by a hash of item and place, half full on average, so that none is
    # much larger than BLOCK.
    dealt = 2 * blocks if blocks > 1 else 1
    cut = cut.withColumn("block", F.pmod(F.xxhash64("item_id", "at"), F.lit(dealt)))
    for low in range(0, dealt, BLOCKS_A_PASS):
        if some := pass_models(cut.filter(F.col("block").between(low, low + BLOCKS_A_PASS - 1)), benchmark, idf):
            yield some


def pass_models(cut: DataFrame, benchmark: DataFrame, idf: np.ndarray) -> list[dict]:
    """What the search tasks need of some blocks: bounded by the blocks, not by the texts.
    A task works out the space of a block; the driver gathers the results."""
    texts = benchmark.select(item_id(), text().alias("text")).distinct()
    items: dict[int, dict[int, list]] = {}
    for block, item, value in texts.join(cut.select("block", "item_id").distinct(), "item_id").select("block", "item_id", "text").collect():
        words, _ = word_hashes(pa.array([value], pa.large_string()))
        if len(words):
            sentences = [s for s in value.replace("\n", ". ").split(". ") if s.strip(" .")]
            answer, _ = word_hashes(pa.array([sentences[-1] if len(sentences) > 1 else ""], pa.large_string()))
            items.setdefault(block, {}).setdefault(item, []).append((words.tolist(), answer.tolist()))
    out = []
    for row in sorted(cut.groupBy("block").applyInPandas(space, SPACE).collect(), key=lambda r: r.block):
        terms, owners = np.frombuffer(row.terms, np.int64), np.frombuffer(row.owners, np.int64)
        folded = np.frombuffer(row.folded, np.float32).reshape(len(terms), -1)
        queries = np.frombuffer(row.queries, np.float32).reshape(len(owners), -1)
        lookup = np.full(FEATURES, -1, np.int32)
        lookup[terms] = np.arange(len(terms))
        reach = np.zeros(FEATURES, np.float32)
        reach[terms] = np.abs(folded @ queries.T).max(1)
        out.append({
            "idf": idf, "lookup": lookup, "folded": folded, "queries": queries, "items": items.get(row.block, {}),
            "reach": reach, "owners": owners,
        })
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item."""
    kept = docs
    for some in models(docs, benchmark):
        kept = kept.filter(F.size(searcher(some)(text())) == 0)
    return kept
