"""Toxicity by a subsequence string kernel, Nyström landmarks and a linear SVM.

A word (a run between blanks, lower-cased, with its marks) is described by its
subsequences of four bytes that span at most six, its opening blank among them, each
weighted by 0.7 to the power of its gaps, so ``id-iot`` and ``idiiot`` still share most
of ``idiot``. The kernel of
two words is the product of these vectors, scaled by the words' lengths; a sentence's
is the sum over its words. Up to 320 landmark words, most of them those which toxic
labels favour, span the space in which a linear SVM is trained (Nyström). A
subsequence's weight in the trained machine is then a single number, so scoring costs a
table lookup for each subsequence and no kernel with a landmark.

Labels are of whole documents. A toxic document has some toxic sentence: each round
takes the one scored highest (multiple-instance learning), and for clean documents the
highest too, which is their hardest. A sentence is at most 12 words. A document's score
is that of its highest sentence, through a logistic fitted on the training documents.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barline.llm.tables import about, stored, text
from barline.llm.words import bounds, chunks, raw, run_hashes

TRAIN_TOXIC, TRAIN_CLEAN, TRAIN_CHARS = 1500, 2000, 12000
SENTENCE = 12
SPAN, GAP = 6, 0.7
BUCKETS = 1 << 18
LANDMARKS, CLEAN_LANDMARKS = 256, 64
ROUNDS, RIDGE, START_CLEAN = 4, 1e-2, 3000

IS_MARK = np.ones(256, bool)
IS_MARK[[9, 10, 11, 12, 13, 32]] = False
# The distances between the four bytes of a subsequence.
GAPS = [
    (a, b, c) for a in range(1, SPAN) for b in range(1, SPAN) for c in range(1, SPAN) if a + b + c < SPAN
]
PRIME, SPREAD = np.uint32(0x01000193), np.uint32(0x9E3779B1)


@dataclass
class Model:
    weights: np.ndarray  # of every subsequence
    bias: float
    slope: float  # of the logistic that turns a margin into a score
    shift: float


@dataclass
class Tokens:
    data: np.ndarray
    first: np.ndarray
    last: np.ndarray
    starts: np.ndarray
    broken: np.ndarray  # whether a sentence may begin here


def read(texts: pa.Array) -> Tokens:
    data, offsets = raw(pc.utf8_lower(texts))
    first, last = bounds(IS_MARK[data], offsets)
    stop = np.isin(data[last], np.frombuffer(b".!?", np.uint8)) if len(last) else np.zeros(0, bool)
    broken = np.ones(len(first), bool)
    broken[1:] = stop[:-1]
    return Tokens(data, first, last, np.searchsorted(first, offsets), broken)


def subsequences(tokens: Tokens):
    """For each choice of gaps: (word number, bucket, weight) of the subsequences, by word.

    A word's bytes follow one blank."""
    sizes = tokens.last - tokens.first + 2
    owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    left = np.repeat(sizes, sizes) - 1 - within
    code = np.where(within == 0, np.uint8(32), tokens.data[np.maximum(np.repeat(tokens.first, sizes) + within - 1, 0)])
    code = code.astype(np.uint32)
    for a, b, c in GAPS:
        place = np.flatnonzero(left >= a + b + c)
        h = ((code[place] * PRIME + code[place + a]) * PRIME + code[place + a + b]) * PRIME + code[place + a + b + c]
        yield owner[place], (h * SPREAD) >> np.uint32(32 - 18), GAP ** (a + b + c - 3)


def scale(tokens: Tokens) -> np.ndarray:
    """One over the length of each word's vector, were its subsequences all different."""
    sizes = tokens.last - tokens.first + 2
    square = sum(np.maximum(sizes - a - b - c, 0) * GAP ** (2 * (a + b + c - 3)) for a, b, c in GAPS)
    return 1 / np.sqrt(np.maximum(square, 1.0))


def word_margins(tokens: Tokens, weights: np.ndarray) -> np.ndarray:
    out = np.zeros(len(tokens.first))
    for owner, bucket, weight in subsequences(tokens):
        out += np.bincount(owner, weights[bucket], len(out)) * weight
    return out * scale(tokens)


def sentences(tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """(first word, text number) of each sentence; none crosses a text, all words are in one."""
    n = len(tokens.first)
    begin = tokens.broken.copy()
    begin[tokens.starts[:-1][np.diff(tokens.starts) > 0]] = True
    run = np.flatnonzero(begin)
    sizes = np.diff(np.append(run, n))
    parts = -(-sizes // SENTENCE)
    low = np.repeat(run - SENTENCE * (np.cumsum(parts) - parts), parts) + SENTENCE * np.arange(parts.sum())
    return low, np.searchsorted(tokens.starts, low, "right") - 1


def highest(values: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    """The sentence with the highest value of each text, -1 where there is none."""
    out = np.full(texts, -1)
    order = np.lexsort((-values, owner))
    first = np.ones(len(order), bool)
    first[1:] = owner[order][1:] != owner[order][:-1]
    out[owner[order][first]] = order[first]
    return out


def svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, start: np.ndarray) -> np.ndarray:
    """A linear machine with squared hinge loss, by Newton steps on its active rows."""
    w = start
    for _ in range(30):
        gap = 1 - y * (x @ w)
        on = gap > 0
        xs = x[on] * cost[on, None]
        grad = RIDGE * w - xs.T @ (gap[on] * y[on])
        step = np.linalg.solve(RIDGE * np.eye(len(w)) + xs.T @ x[on], grad)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


def strength(toxic: np.ndarray, clean: np.ndarray) -> np.ndarray:
    """How much toxic texts favour each word: its log odds, weighted by how sure they are."""
    odds = np.log((toxic + 0.5) / (toxic.sum() + 1)) - np.log((clean + 0.5) / (clean.sum() + 1))
    return odds * np.sqrt(toxic)


def landmark_words(toxic: np.ndarray, clean: np.ndarray) -> list[int]:
    """The words most favoured by toxic texts, and the most common clean ones."""
    numbers = np.arange(len(toxic))
    favoured = np.lexsort((numbers, -strength(toxic, clean)))[:LANDMARKS]
    common = np.lexsort((numbers, -clean))[:CLEAN_LANDMARKS]
    return sorted({*favoured.tolist(), *common.tolist()})


def train(texts: list[str], labels: list[int]) -> Model:
    """The machine from labelled texts, all on the driver: the sample is bounded."""
    y = np.asarray(labels)
    part = next(chunks(pa.array(texts, pa.large_string()), 1 << 40))
    tokens = read(part)
    hashes = run_hashes(tokens.data, tokens.first, tokens.last)
    _, where, word = np.unique(hashes, return_index=True, return_inverse=True)
    owner = np.repeat(np.arange(len(texts)), np.diff(tokens.starts))
    pairs = np.unique(word.astype(np.int64) * len(texts) + owner)
    seen, label = pairs // len(texts), y[pairs % len(texts)]
    toxic, clean = (np.bincount(seen[label == c], minlength=len(where)) for c in (1, 0))
    words = [tokens.data[tokens.first[i] : tokens.last[i] + 1].tobytes().decode("utf8", "replace") for i in where]
    chosen = landmark_words(toxic, clean)
    # The landmarks' vectors, the words' products with them, and the Nyström map.
    spots = read(pa.array([words[i] for i in chosen], pa.large_string()))
    found = list(subsequences(spots))
    used = np.unique(np.concatenate([bucket for _, bucket, _ in found]))
    row_of = np.zeros(BUCKETS, np.int32)  # row 0 is of all that no landmark has
    row_of[used] = 1 + np.arange(len(used))
    vectors = np.zeros((1 + len(used), len(chosen)))
    for own, bucket, weight in found:
        np.add.at(vectors, (row_of[bucket], own), weight * scale(spots)[own])
    values, axes = np.linalg.eigh(vectors.T @ vectors + 1e-6 * np.eye(len(chosen)))
    vectors = (vectors @ (axes / np.sqrt(np.maximum(values, 1e-6)))).astype(np.float32)
    unique = Tokens(tokens.data, tokens.first[where], tokens.last[where], np.array([0, len(where)]), tokens.broken[where])
    begin, text_of = sentences(tokens)
    ends = np.append(begin[1:], len(word))
    target = np.where(y[text_of] == 1, 1.0, -1.0)
    # At first the toxic sentence is the one with the word most favoured by toxic texts.
    value = np.maximum.reduceat(strength(toxic, clean)[word], begin)
    rng = np.random.default_rng(3)
    plain = np.flatnonzero(target < 0)
    hard = np.sort(rng.choice(plain, min(len(plain), START_CLEAN), replace=False))
    w = np.zeros(len(chosen) + 1)
    for _ in range(ROUNDS):
        top = highest(value, text_of, len(texts))
        top = top[top >= 0]
        hard = np.union1d(hard, top[target[top] < 0])
        rows = np.concatenate([top[target[top] > 0], hard])
        w = svm(embedded(unique, word, begin[rows], ends[rows], vectors, row_of), target[rows], balance(target[rows]), w)
        value = np.add.reduceat(word_margins(unique, (vectors @ w[:-1])[row_of])[word], begin) + w[-1]
    top = highest(value, text_of, len(texts))
    slope, shift = logistic(value[top[top >= 0]], y[top >= 0])
    return Model((vectors @ w[:-1])[row_of], float(w[-1]), slope, shift)


def embedded(unique: Tokens, word, begin, end, vectors: np.ndarray, row_of: np.ndarray) -> np.ndarray:
    """The Nyström vectors of sentences, sums of their words', and a one for the bias."""
    sizes = end - begin
    place = np.repeat(begin - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
    needed, back = np.unique(word[place], return_inverse=True)
    some = Tokens(unique.data, unique.first[needed], unique.last[needed], np.array([0, len(needed)]), unique.broken[needed])
    out = np.zeros((len(needed), vectors.shape[1]), np.float32)
    for own, bucket, weight in subsequences(some):
        for low in range(0, len(own), 1 << 16):
            who = own[low : low + (1 << 16)]
            edge = np.flatnonzero(np.diff(who, prepend=-1))
            out[who[edge]] += np.add.reduceat(vectors[row_of[bucket[low : low + (1 << 16)]]], edge) * np.float32(weight)
    out *= scale(some)[:, None].astype(np.float32)
    x = np.ones((len(begin), vectors.shape[1] + 1))
    x[:, :-1] = np.add.reduceat(out[back], np.cumsum(sizes) - sizes)
    return x


def balance(target: np.ndarray) -> np.ndarray:
    """Weights that give both classes the same sum."""
    positive = max(1, int((target > 0).sum()))
    negative = max(1, len(target) - positive)
    return np.where(target > 0, len(target) / (2 * positive), len(target) / (2 * negative))


def logistic(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic of margins, with classes of equal weight."""
    weight, a, b = balance(np.where(y == 1, 1.0, -1.0)), 1.0, 0.0
    goal = np.where(y == 1, 0.98, 0.02)
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        slope, curve = weight * (p - goal), weight * p * (1 - p) + 1e-3
        h = np.array([[(curve * margin**2).sum() + 1e-3, (curve * margin).sum()], [(curve * margin).sum(), curve.sum()]])
        step = np.linalg.solve(h, [(slope * margin).sum(), slope.sum()])
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(max(a, 1e-3)), float(b)


def fitted(docs: DataFrame, labels: DataFrame, usable: Column) -> Model | None:
    """A machine from the labelled rows for which ``usable`` holds; None unless both
    labels are there. A row with contradicting labels is toxic."""
    marks = labels.filter("toxic is not null").groupBy(F.col("doc_id").alias("marked")).agg(F.max("toxic").alias("toxic"))
    ids = docs.select("doc_id", usable.alias("usable")).filter("usable").select("doc_id").distinct()
    marked = stored(ids.join(marks, F.col("doc_id") == F.col("marked")).select("marked", "toxic"), "toxicity-marked")
    bounds_of = ((1, TRAIN_TOXIC), (0, TRAIN_CLEAN))
    chosen = [about(marked.filter(F.col("toxic") == c), n, "marked").limit(2 * n) for c, n in bounds_of]
    # At most twice the two bounds of ids: small enough to send to every task.
    wanted = F.broadcast(chosen[0].union(chosen[1]))
    texts = docs.select("doc_id", F.left(text(), F.lit(TRAIN_CHARS)).alias("text"))
    texts = texts.join(wanted, F.col("doc_id") == F.col("marked")).groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    sample = sorted(texts.collect(), key=lambda r: r.doc_id)
    if len({r.toxic for r in sample}) < 2:
        return None
    return train([r.text for r in sample], [int(r.toxic) for r in sample])


def scorer(model: Model):
    """A column function from texts to scores; a text without words has a margin of zero
    words, the machine's bias."""

    @F.arrow_udf(T.DoubleType())
    def score(texts: pa.Array) -> pa.Array:
        out = []
        for part in chunks(texts, 1 << 19):
            tokens = read(part)
            top = np.full(len(part), model.bias)
            if len(tokens.first):
                begin, owner = sentences(tokens)
                margins = np.add.reduceat(word_margins(tokens, model.weights), begin) + model.bias
                best = highest(margins, owner, len(part))
                top = np.where(best >= 0, margins[best], top)
            out.append(1 / (1 + np.exp(-np.clip(model.slope * top + model.shift, -700, 700))))
        return pa.array(np.concatenate(out) if out else np.zeros(0), pa.float64())

    return score


def scored(docs: DataFrame, labels: DataFrame, held_out: Column, usable: Column) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``.

    Null texts are empty ones. Without both labels to learn from, every score is 0."""
    model = fitted(docs, labels, usable)
    value = F.lit(0.0) if model is None else scorer(model)(text())
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out.alias("held_out"), value.alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
