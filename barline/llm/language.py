"""Language of words and texts by a linear-chain conditional random field.

Words of a text form chains. A word's score for a language is a sum of learned weights
of its byte n-grams of two to four, those with a blank at either end being its affixes,
and of the word itself, the lexicon. A learned matrix scores the language of a word
after that of the one before. Forward-backward gives every word its probabilities, so a
foreign passage inside a text gets a label of its own, and the sum over words is the
text's distribution. Chains are cut every 64 words, which bounds their padding; every
word of every text is labelled.

Training takes a bounded sample of labelled texts: about ``TRAIN_TEXTS``, as many of each
language as it has and the others leave room for, so that rare languages are learned. Of
a longer text it takes ``TRAIN_CHARS`` code points from a place drawn by hash, so every
part of every text may be drawn. It makes a third of the chains code-switched by splicing
two of them, and climbs the chains' likelihood by AdaGrad from a naive Bayes start. A
model takes about 4 MB a language.

The field must choose among the languages it knows. Whether a text is in any of them is
told by its fit: how likely its byte trigrams are under those of the sample, in spreads
from what texts of the sample have when the other half of the sample judges them.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barline.llm.tables import DRAWS, ROW, drawn, text
from barline.llm.words import bounds, chunks, raw, release, run_hashes

UNKNOWN = "und"
TRAIN_TEXTS, TRAIN_CHARS = 1600, 2000
CHAIN = 64
BUCKETS = 1 << 18
GRAMS = (2, 3, 4)
ROUNDS, RATE, DECAY = 6, 0.1, 1e-6
MIN_SPREAD = 0.01

# Letters, ASCII or beyond; digits and marks belong to no language.
IS_LETTER = np.zeros(256, bool)
IS_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


@dataclass
class Model:
    """A field, and the usual trigrams of its languages."""

    languages: list[str]
    grams: np.ndarray  # (len(GRAMS) + 1, BUCKETS, languages): n-grams by length, then words
    moves: np.ndarray  # (languages, languages)
    usual: Usual


@dataclass
class Usual:
    """What trigrams texts of the sample have."""

    logs: np.ndarray  # log probability by bucket, languages weighing alike
    center: np.ndarray  # by language: the mean of a usual text's trigrams
    spread: np.ndarray  # by language: variance between texts
    noise: float  # variance within texts, for one trigram


@dataclass
class Words:
    """The words of some texts: their n-gram buckets and where they begin."""

    slots: list[np.ndarray]
    begins: np.ndarray
    lexicon: np.ndarray
    starts: np.ndarray


def read(texts: pa.Array) -> Words:
    data, offsets = raw(pc.utf8_lower(texts))
    first, last = bounds(IS_LETTER[data], offsets)
    hashes = run_hashes(data, first, last)
    sizes = last - first + 1
    # Each word with a blank before and after it, one word after the other.
    padded = np.full(int((sizes + 2).sum()), 32, np.uint32)
    begins = np.cumsum(sizes + 2) - sizes - 2
    within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    padded[np.repeat(begins + 1, sizes) + within] = data[np.repeat(first, sizes) + within]
    room = (np.repeat(begins + sizes + 2, sizes + 2) - np.arange(len(padded))).astype(np.int32)
    slots, code = [], padded.copy()
    for n in range(2, max(GRAMS) + 1):
        code = code * np.uint32(0x01000193)
        code[: len(code) - n + 1] += padded[n - 1 :]
        if n in GRAMS:
            # A gram that would leave its word is one that says nothing.
            h = np.where(room >= n, code, np.uint32(0)) * np.uint32(0x9E3779B1)
            slots.append((h >> np.uint32(32 - 18)).astype(np.int32))
    return Words(slots, begins, (hashes >> np.uint64(64 - 18)).astype(np.int64), np.searchsorted(first, offsets))


def word_scores(words: Words, grams: np.ndarray) -> np.ndarray:
    """(word, language) sums of the weights of each word's n-grams and of itself."""
    total = grams[-1][words.lexicon].astype(np.float32)
    if len(words.begins):
        for slot, weights in zip(words.slots, grams, strict=False):
            total += np.add.reduceat(weights[slot], words.begins)
    return total


def chained(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word numbers, present) of all chains, each CHAIN long; no chain crosses a text."""
    sizes = np.diff(starts)
    counts = -(-sizes // CHAIN)
    within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    low = np.repeat(starts[:-1], counts) + within * CHAIN
    end = np.repeat(starts[1:], counts)
    place = low[:, None] + np.arange(CHAIN)
    present = place < end[:, None]
    return np.where(present, place, low[:, None]), present


def forward_backward(scores: np.ndarray, present: np.ndarray, moves: np.ndarray):
    """Probabilities (chain, word, language) and of moves (chain, from, to) summed over words.

    Scores are shifted to a peak of zero and each step is normalised, so nothing
    overflows. Places that are not present pass the state on unchanged."""
    local = np.exp(np.maximum(scores - scores.max(axis=2, keepdims=True), -60)).astype(np.float64)
    step = np.exp(moves)
    n, length, k = local.shape
    ahead = np.empty((n, length, k))
    ahead[:, 0] = local[:, 0]
    ahead[:, 0] /= ahead[:, 0].sum(1, keepdims=True)
    for t in range(1, length):
        x = (ahead[:, t - 1] @ step) * local[:, t]
        x /= x.sum(1, keepdims=True)
        ahead[:, t] = np.where(present[:, t, None], x, ahead[:, t - 1])
    behind = np.ones((n, length, k))
    pairs = np.zeros((n, k, k))
    for t in range(length - 1, 0, -1):
        x = local[:, t] * behind[:, t]
        x /= x.sum(1, keepdims=True)
        joint = ahead[:, t - 1, :, None] * step * x[:, None, :]
        joint /= joint.sum((1, 2), keepdims=True)
        pairs += joint * present[:, t, None, None]
        back = x @ step.T
        back /= back.sum(1, keepdims=True)
        behind[:, t - 1] = np.where(present[:, t, None], back, behind[:, t])
    both = ahead * behind
    return both / both.sum(2, keepdims=True) * present[:, :, None], pairs


def trigram_logs(slot: np.ndarray, own: np.ndarray, k: int) -> np.ndarray:
    """Log probability of each trigram bucket; every language has the same weight."""
    total = np.zeros(BUCKETS)
    for s in range(k):
        counts = np.bincount(slot[own == s], minlength=BUCKETS)
        total += counts / max(counts.sum(), 1)
    # A bucket that the sample lacks counts as half of one place in it.
    return np.log(np.maximum(total / k, 0.5 / max(len(slot), 1))).astype(np.float32)


def text_fits(words: Words, logs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The mean log probability of each text's trigrams, how many there are, and the part of
    the mean's variance that falls as texts grow: words vary, trigrams of one do so together."""
    n = len(words.starts) - 1
    if not len(words.begins):
        return np.zeros(n), np.zeros(n), np.zeros(n)
    slot, owner = words.slots[GRAMS.index(3)], np.repeat(np.arange(n), np.diff(words.starts))
    told = slot != 0  # bucket 0 is that of grams which leave their word
    sums = np.add.reduceat(np.where(told, logs[slot], 0).astype(np.float64), words.begins)
    sizes = np.add.reduceat(told.astype(np.int64), words.begins)
    total = np.bincount(owner, sizes, n)
    mean = np.bincount(owner, sums, n) / np.maximum(total, 1)
    noise = np.bincount(owner, (sums - mean[owner] * sizes) ** 2, n) / np.maximum(total, 1)
    return mean, total, noise


def usual_trigrams(words: Words, word_of: np.ndarray, labels: np.ndarray, k: int) -> Usual:
    """What is usual in the sample: texts of either half are judged by the other half."""
    slot, text_of = words.slots[GRAMS.index(3)], np.repeat(np.arange(len(labels), dtype=np.int32), np.diff(words.starts))
    of_gram, told = text_of[word_of], slot != 0
    half = np.zeros(len(labels), bool)
    for s in range(k):
        half[np.flatnonzero(labels == s)[::2]] = True
    mean, noise, total = np.zeros(len(labels)), np.zeros(len(labels)), np.zeros(len(labels))
    for side in (True, False):
        some = told & (half[of_gram] != side)
        logs = trigram_logs(slot[some], labels[of_gram[some]], k)
        a, total, b = text_fits(words, logs)
        mean, noise = np.where(half == side, a, mean), np.where(half == side, b, noise)
    some = total > 0

    def middle(which: np.ndarray) -> tuple[float, float]:
        if not which.any():
            return np.inf, 0.0
        center = float(np.median(mean[which]))
        return center, (1.4826 * float(np.median(np.abs(mean[which] - center)))) ** 2

    # A language with little to learn from is judged by its own texts where they fit less.
    every, own = middle(some), [middle(some & (labels == s)) for s in range(k)]
    return Usual(
        trigram_logs(slot[told], labels[of_gram[told]], k),
        np.array([min(c, every[0]) for c, _ in own]), np.array([max(v, every[1], MIN_SPREAD) for _, v in own]),
        float(noise[some].mean()) if some.any() else 1.0,
    )


def train(texts: list[str], labels: list[int], languages: list[str]) -> Model:
    """The field's weights from labelled texts, all on the driver: the sample is bounded."""
    k = len(languages)
    parts = list(chunks(pa.array(texts, pa.large_string()), 1 << 30))
    words = read(parts[0])
    owner = np.repeat(np.asarray(labels), np.diff(words.starts))
    grams = np.zeros((len(GRAMS) + 1, BUCKETS, k), np.float32)
    word_of = np.repeat(np.arange(len(owner), dtype=np.int32), np.diff(np.append(words.begins, len(words.slots[0]))))
    for i, slot in enumerate([*words.slots, words.lexicon]):
        own = owner[word_of] if i < len(GRAMS) else owner
        counts = np.stack([np.bincount(slot[own == s], minlength=BUCKETS) for s in range(k)], 1) + 0.1
        odds = np.log(counts / counts.sum(0))
        # An even split of the evidence over the features that share a word.
        grams[i] = (odds - odds.mean(1, keepdims=True)) * (0.1 if i < len(GRAMS) else 0.3)
    usual = usual_trigrams(words, word_of, np.asarray(labels, np.int32), k)
    place, present = chained(words.starts)
    gold = owner[place]
    rng = np.random.default_rng(7)
    for i in rng.choice(len(place), len(place) // 3, replace=False):
        other, cut = rng.integers(len(place)), int(rng.integers(8, CHAIN - 8))
        place[i, cut:], gold[i, cut:], present[i, cut:] = place[other, cut:], gold[other, cut:], present[other, cut:]
    present &= np.cumprod(present, axis=1).astype(bool)
    moves = np.where(np.eye(k, dtype=bool), 0.0, -3.0)
    seen, seen_moves = np.full(grams.shape, 1e-2, np.float32), np.full((k, k), 1e-2)
    want = np.eye(k)[gold] * present[:, :, None]
    want_moves = np.zeros((k, k))
    np.add.at(want_moves, (gold[:, :-1][present[:, 1:]], gold[:, 1:][present[:, 1:]]), 1)
    for _ in range(ROUNDS):
        scores = word_scores(words, grams)
        marginal, pairs = forward_backward(scores[place], present, moves)
        short = np.zeros((len(owner), k))
        np.add.at(short, place[present], (want - marginal)[present])
        for i, slot in enumerate([*words.slots, words.lexicon]):
            for s in range(k):
                part = short[:, s][word_of] if i < len(GRAMS) else short[:, s]
                slope = np.bincount(slot, part, BUCKETS) - DECAY * grams[i, :, s]
                seen[i, :, s] += slope**2
                grams[i, :, s] += RATE * slope / np.sqrt(seen[i, :, s])
        slope = want_moves - pairs.sum(0)
        seen_moves += slope**2
        moves += RATE * slope / np.sqrt(seen_moves)
    return Model(languages, grams, moves, usual)


def shares_of(counts: dict[str, int], total: int = TRAIN_TEXTS) -> list[tuple[str, float]]:
    """The share of each language's texts to draw, so that about ``total`` are drawn: all of
    a rare language, and as many of each of the others."""
    out, left = [], total
    for i, (lang, n) in enumerate(sorted(counts.items(), key=lambda x: (x[1], x[0]))):
        take = min(n, left / (len(counts) - i))
        out.append((lang, take / n))
        left -= take
    return out


def fitted(docs: DataFrame, usable: Column) -> Model | None:
    """A model of the texts with a language for which ``usable`` holds; None without any."""
    labelled = docs.select("doc_id", text().alias("text"), "lang", usable.alias("usable")).filter(
        "usable and lang is not null and text <> ''"
    )
    found = labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()
    if not found:
        return None
    share = F.create_map(*chain.from_iterable((F.lit(x), F.lit(int(s * DRAWS))) for x, s in shares_of({r.lang: r.n for r in found})))
    begin = F.pmod(F.xxhash64(F.lit("window"), "doc_id"), F.greatest(F.length("text") - TRAIN_CHARS + 1, F.lit(1)))
    window = F.substr("text", (begin + 1).cast("int"), F.lit(TRAIN_CHARS)).alias("text")
    sample = labelled.filter(drawn("doc_id") < share[F.col("lang")]).select("doc_id", "lang", window)
    rows = sorted(sample.limit(2 * TRAIN_TEXTS).collect(), key=lambda r: (r.doc_id is None, r.doc_id, r.text))
    if not rows:
        return None
    languages = sorted({r.lang for r in rows})
    model = train([r.text for r in rows], [languages.index(r.lang) for r in rows], languages)
    release()
    return model


LABEL = T.StructType([
    T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("fit", T.DoubleType()),
])


def fits(words: Words, best: np.ndarray, usual: Usual) -> np.ndarray:
    """How far each text's trigrams are from what is usual in its language, in spreads; a
    short text may be further away."""
    mean, total, _ = text_fits(words, usual.logs)
    room = usual.spread[best] + usual.noise / np.maximum(total, 1)
    return (mean - usual.center[best]) / np.sqrt(room)


def shares(words: Words, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """(text, language) sums of the words' probabilities, and how many words there are."""
    n, k = len(words.starts) - 1, len(model.languages)
    out = np.zeros((n, k))
    if len(words.begins):
        scores = word_scores(words, model.grams)
        place, present = chained(words.starts)
        owner = np.repeat(np.arange(n), -(-np.diff(words.starts) // CHAIN))
        for low in range(0, len(place), 2048):
            some = slice(low, low + 2048)
            marginal, _ = forward_backward(scores[place[some]], present[some], model.moves)
            np.add.at(out, owner[some], marginal.sum(1))
    return out, np.diff(words.starts)


def labeller(model: Model):
    """A column function from texts to (lang, score, fit): the language with the largest
    share of the words' probabilities, that share, and how usual the text is in it (0 and
    above: as the sample's texts); ``und`` and 0 without a letter."""

    @F.arrow_udf(LABEL)
    def label(texts: pa.Array) -> pa.Array:
        names, scores, usual = [], [], []
        for part in chunks(texts, 1 << 19):
            words = read(part)
            share, size = shares(words, model)
            best = share.argmax(1)
            some = (size > 0) & np.array(pc.match_substring_regex(part, r"\p{L}"))
            names.extend(model.languages[b] if s else UNKNOWN for b, s in zip(best, some, strict=True))
            top = share[np.arange(len(best)), best] / np.maximum(size, 1)
            scores.extend(np.where(some, np.clip(top, 0, 1), 0.0).tolist())
            usual.extend(np.where(some, fits(words, best, model.usual), 0.0).tolist())
        release()
        columns = [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(usual, pa.float64())]
        return pa.StructArray.from_arrays(columns, names=["lang", "score", "fit"])

    return label


def labelled(docs: DataFrame, model: Model | None) -> Column:
    """The (lang, score, fit) column of ``docs``; without a model every text is ``und``."""
    if model is None:
        return F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"), F.lit(0.0).alias("fit"))
    return labeller(model)(text())


REJECT_BELOW, REJECT_FIT = 0.3, -14.0
FOUND = f"{ROW}_lang"


def keep_known(docs: DataFrame, usable: Column | None = None) -> DataFrame:
    """The rows of ``docs`` in a language that the field knows.

    Null texts, texts without a letter, those in which no language has a share of 0.3 and
    those whose trigrams are ``REJECT_FIT`` spreads from any known language's go: other
    scripts and languages, random letters, codes. If no row has a language to learn from, nothing can be judged and all with a
    letter stay."""
    model = fitted(docs, F.lit(True) if usable is None else usable)
    if model is None:
        return docs.filter(F.coalesce(F.col("text"), F.lit("")).rlike(r"\p{L}"))
    rows = docs.withColumn(FOUND, labelled(docs, model))
    known = (F.col(f"{FOUND}.score") >= REJECT_BELOW) & (F.col(f"{FOUND}.fit") >= REJECT_FIT)
    rows = rows.filter((F.col(f"{FOUND}.lang") != UNKNOWN) & known)
    return rows.select(docs.columns)


def languages(docs: DataFrame, held_out: Column, usable: Column) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row of ``docs``."""
    model = fitted(docs, usable)
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), held_out.alias("held_out"), labelled(docs, model).alias("found")
    )
    return rows.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))
