"""Words of many texts at once, as 64-bit hashes in numpy arrays.

A word is a run of letters and digits of the lower-cased text; every byte of a
character beyond ASCII counts as a letter. Texts are taken a few megabytes at a
time, so memory does not grow with an Arrow batch, only with the longest text.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 21
IS_WORD = np.zeros(256, bool)
IS_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True

# Constants of the SplitMix64 generator, and an odd base for the rolling hash.
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
MIX_A, MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
BASE = 0x100000001B3 * 0x9E3779B1 | 1
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def release() -> None:
    """Give memory that a batch has used back to the system: Python workers outlive their
    tasks, and wait beside those of the next stage."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim is not None:
        trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finishing steps: a bijection that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of each."""
    if len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES)
        for i, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            steps = np.full(size, base % (1 << 64), np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[pa.Array]:
    """Slices of at most ``limit`` bytes or one text; missing texts become empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if len(texts) == 0:
        return
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    low = 0
    while low < len(texts):
        before = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield texts.slice(low, high - low)
        low = high


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a chunk and where each text begins in them, with the end."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def bounds(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last places of the runs of ``inside``; no run crosses a text's edge."""
    if len(inside) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(len(inside) + 1, bool)
    edge[offsets] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last[:-1] &= ~inside[1:] | edge[1:-1]
    return np.flatnonzero(first), np.flatnonzero(last)


def run_hashes(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """One hash per run of bytes, equal for equal runs."""
    if len(first) == 0:
        return np.zeros(0, np.uint64)
    power, inverse = powers(len(data))
    terms = (data.astype(np.uint64) + np.uint64(1)) * power[: len(data)]
    sums = np.cumsum(terms)
    return mix((sums[last] - sums[first] + terms[first]) * inverse[first])


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words in order, where each text begins among them, with the end)."""
    data, offsets = raw(pc.utf8_lower(texts))
    first, last = bounds(IS_WORD[data], offsets)
    return run_hashes(data, first, last), np.searchsorted(first, offsets)


def shingles(words: np.ndarray, starts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of every run of ``k`` words; a shorter text is one run."""
    sizes = np.diff(starts)
    counts = np.where(sizes > 0, np.maximum(sizes - k + 1, 1), 0)
    owner = np.repeat(np.arange(len(sizes)), counts)
    within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    at, end = starts[:-1][owner] + within, starts[1:][owner]
    out = np.zeros(len(at), np.uint64)
    for i in range(k):
        there = at + i < end
        word = np.where(there, words[np.minimum(at + i, len(words) - 1)], np.uint64(0)) if len(words) else out
        out = mix(out + GOLDEN + word)
    return out, owner


def multisets(words: np.ndarray, starts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, shingle, count) of the distinct shingles, sorted; 40 bits of a hash
    tell the shingles of one text apart, and a chunk has fewer than 2**24 texts."""
    hashes, owner = shingles(words, starts, k)
    keys = np.sort((owner.astype(np.uint64) << np.uint64(40)) | (hashes >> np.uint64(24)))
    fresh = np.ones(len(keys), bool)
    fresh[1:] = keys[1:] != keys[:-1]
    at = np.flatnonzero(fresh)
    counts = np.diff(np.append(at, len(keys)))
    keys = keys[at]
    return (keys >> np.uint64(40)).astype(np.int64), keys & np.uint64((1 << 40) - 1), counts
