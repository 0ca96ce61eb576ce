"""Packing documents into training sequences by lexical retrieval.

A document's token ids, with an end id, are cut into whole sequences of 4096 and a
rest. Whole sequences stand alone. Rests are dealt to shards; a shard builds a BM25
inverted index of its rests' words, with statistics of its own as sharded indexes
have. The longest unused rest is the seed of a sequence; the unused rests most like
it, by BM25, fill the window in that order. One that is too long for what is left is
passed over, and the next best is tried; when no neighbour fits, the most like it, or
failing that the longest left, is cut, and what is over becomes a rest again. So only
the last sequence of a shard is padded.

A rest has fewer than 4096 tokens and a shard about 2048 rests, which bounds a task
whatever the texts are. Shards are dealt by the row, so equal documents spread.
"""

from __future__ import annotations

import heapq
import os
import zlib
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barline.llm.tables import text
from barline.llm.words import chunks, release

LENGTH = 4096
END_ID = 2
SHARD_ROWS = 2048
K1, B = 1.2, 0.75
FORGET = 0.8  # an index is made smaller when fewer of its rests are left
# A worker holds a chunk with its words and a vocabulary beside its Arrow batch, and every core has a worker.
CHUNK_BYTES = 1 << 22
WORDS = 1 << 17  # of a chunk whose ids are written out at a time
JOINED = 1 << 9  # words encoded as one text
CACHED_BYTES = 1 << 24
# A letter, but not one of those that are a letter and a mark when composed and lower-cased: signs join with marks.
LETTER = (
    r"[^\PL\x{130}\x{958}-\x{95f}\x{9dc}\x{9dd}\x{9df}\x{a33}\x{a36}\x{a59}-\x{a5b}\x{a5e}\x{b5c}\x{b5d}"
    r"\x{f43}\x{f4d}\x{f52}\x{f57}\x{f5c}\x{f69}\x{fb1d}-\x{fb4e}]"
)
PLAIN = "^[a-z\u00df-\u00f6\u00f8-\u00ff]+$"
SIGN = r"[!-&(-/:;=?@\[-`{|}~]$"
SIGNED = "^[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+" + SIGN.replace("]$", "]*$")

PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def crc(ids: np.ndarray) -> int:
    """crc32 of ids as little-endian unsigned 32-bit numbers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())


@lru_cache(maxsize=2)
def tokenizer(path: str):
    """The tokenizer, on one thread: the other cores have tasks of their own."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def strings(values: pa.Array) -> list[str]:
    """The values as Python strings, without a scalar object for each."""
    return values.to_numpy(zero_copy_only=False).tolist()


class Vocabulary:
    """Token ids of the parts of words, each encoded once.

    The tokenizer drops blanks, never joins what they part, and never joins a letter with
    a full stop or comma after it; it also lower-cases. So the ids of a text are those of
    its words' parts, and a part is encoded once and not at every place it stands.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.encode = tokenizer(path)
        suffix = self.encode.model.end_of_word_suffix
        self.plain = Tokenizer(self.encode.model)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.CharDelimiterSplit(" "), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        ])
        # Which ids end a run of letters or signs; without a mark for that, words are encoded one by one.
        self.last = np.zeros(self.encode.get_vocab_size(), bool) if suffix else None
        if suffix:
            self.last[[n for token, n in self.encode.get_vocab(False).items() if token.endswith(suffix)]] = True
        # Part 0 is the empty one: the tail of a word without one, and a word between two blanks.
        self.parts = pa.array([""], pa.large_string())
        self.ids = np.zeros(0, np.uint32)
        self.ends = np.zeros(2, np.int64)
        self.hashes = np.zeros(1, np.uint32)
        self.again = np.ones(1, bool)

    def room(self) -> int:
        """Bytes that the parts take."""
        return self.parts.nbytes + self.ids.nbytes + self.ends.nbytes + self.hashes.nbytes + self.again.nbytes

    def thin(self) -> None:
        """Keep the parts that were met in a later chunk than their first, or none if those are many."""
        kept = np.flatnonzero(self.again)
        kept = kept[:1] if len(kept) * 2 > len(self.again) else kept
        sizes = np.diff(self.ends)[kept]
        self.ids = self.ids[flat(self.ends[kept], sizes)]
        self.ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
        self.hashes, self.parts = self.hashes[kept], self.parts.take(pa.array(kept))
        self.again = np.arange(len(kept)) == 0

    def split(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of each word's head and of the stops and commas after it."""
        head = pc.utf8_rtrim(words, ".,")
        head = pc.if_else(pc.match_substring_regex(head, LETTER + "$"), head, words)
        cut = np.flatnonzero(pc.not_equal(head, words).to_numpy(zero_copy_only=False))
        sizes = pc.utf8_length(head.take(cut)).to_numpy().tolist()
        tails = [w[n:] for w, n in zip(strings(words.take(cut)), sizes, strict=True)]
        simple = pc.and_(pc.string_is_ascii(head), pc.invert(pc.match_substring(head, "<")))
        head = pc.if_else(simple, pc.ascii_lower(head), head)
        numbers = self.numbers(pa.concat_arrays([head, pa.array(tails, head.type)]))
        tail = np.zeros(len(words), np.int64)
        tail[cut] = numbers[len(words) :]
        return numbers[: len(words)], tail

    def numbers(self, values: pa.Array) -> np.ndarray:
        """The numbers of parts; those not known are encoded."""
        known = pc.index_in(values, self.parts)
        missing = known.is_null()
        numbers = known.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        self.again[numbers] = True
        fresh = values.filter(missing).dictionary_encode()
        numbers[missing.to_numpy(zero_copy_only=False)] = len(self.parts) + fresh.indices.to_numpy()
        self.add(fresh.dictionary)
        return numbers

    def add(self, fresh: pa.Array) -> None:
        """Encode parts that are new."""
        # Normalising and cutting leave composed lower-case letters as they are, so those go to the merges
        # at once. Signs after letters of either case are one more run: how many runs there are tells words apart.
        plain, signed = (pc.match_substring_regex(fresh, x).to_numpy(zero_copy_only=False) for x in (PLAIN, SIGNED))
        if self.last is None:
            plain, signed = np.zeros(len(fresh), bool), np.zeros(len(fresh), bool)
        signed &= ~plain
        runs = 1 + pc.match_substring_regex(fresh.filter(pa.array(signed)), SIGN).to_numpy(zero_copy_only=False)
        some = strings(fresh.filter(pa.array(~plain & ~signed)))
        others = [x.ids for x in self.encode.encode_batch_fast(some, add_special_tokens=False)]
        found = [
            self.joined(self.plain, strings(fresh.filter(pa.array(plain))), np.ones(plain.sum(), np.int64)),
            self.joined(self.encode, strings(fresh.filter(pa.array(signed))), runs),
            (np.fromiter(chain.from_iterable(others), np.uint32), np.fromiter(map(len, others), np.int64, len(others))),
        ]
        ids, sizes = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(np.concatenate([np.flatnonzero(x) for x in (plain, signed, ~plain & ~signed)]))
        begin = np.cumsum(sizes) - sizes
        self.ids = np.concatenate([self.ids, ids[flat(begin[order], sizes[order])]])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes[order])])
        hashes = map(zlib.crc32, fresh.cast(pa.large_binary()).to_numpy(zero_copy_only=False))
        self.hashes = np.concatenate([self.hashes, np.fromiter(hashes, np.uint32, len(fresh))])
        self.again = np.concatenate([self.again, np.zeros(len(fresh), bool)])
        self.parts = pa.concat_arrays([self.parts, fresh])

    def joined(self, encode, words: list[str], runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, how many each has) for words of so many runs, encoded as texts of many words."""
        texts = (" ".join(words[i : i + JOINED]) for i in range(0, len(words), JOINED))
        each = [np.array(encode.encode_batch_fast([x], add_special_tokens=False)[0].ids, np.uint32) for x in texts]
        ids = np.concatenate([np.zeros(0, np.uint32), *each])
        ends = np.flatnonzero(self.last[ids])[np.cumsum(runs) - 1] + 1 if words else np.zeros(0, np.int64)
        return ids, np.diff(ends, prepend=0)


@lru_cache(maxsize=1)
def shared_vocabulary(path: str) -> Vocabulary:
    """One vocabulary for all tasks of a worker, made smaller past ``CACHED_BYTES``."""
    return Vocabulary(path)


def flat(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of every run, one after the other."""
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


def tokenized(texts: pa.Array, vocabulary: Vocabulary):
    """Of each text its ids, as 32 bits, and the words of its rest: (ids, their hashes, their counts)."""
    words = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
    distinct = pc.dictionary_encode(words.flatten())
    heads, tails = vocabulary.split(distinct.dictionary)
    codes, starts, ends = distinct.indices.to_numpy(), words.offsets.to_numpy(), vocabulary.ends
    # The ids of the chunk's words, each with its tail, stand together here.
    parts = np.stack([heads, tails], 1).ravel()
    begin, count = ends[parts], ends[parts + 1] - ends[parts]
    near, size = vocabulary.ids[flat(begin, count)], count[::2] + count[1::2]
    first, hashes, real = np.cumsum(size) - size, vocabulary.hashes[heads], heads > 0
    low = 0
    while low < len(texts):
        high = max(low + 1, int(np.searchsorted(starts, starts[low] + WORDS, "right")) - 1)
        code, edge = codes[starts[low] : starts[high]], starts[low : high + 1] - starts[low]
        count = size[code]
        upto = np.concatenate([np.zeros(1, np.int64), np.cumsum(count)])
        ids, stop = near[flat(first[code], count)], upto[edge]
        # A rest begins after the whole sequences, which count the end id; a word is in it that ends in it.
        rest = stop[:-1] + (np.diff(stop) + 1) // LENGTH * LENGTH
        owner = np.repeat(np.arange(high - low), np.diff(edge))
        own = np.flatnonzero(real[code] & (upto[1:] > rest[owner]))
        keys = np.sort((owner[own].astype(np.uint64) << np.uint64(32)) | hashes[code[own]])
        at = np.flatnonzero(np.diff(keys, prepend=~keys[:1]))
        counts = np.minimum(np.diff(np.append(at, len(keys))), 65535).astype("<u2")
        terms, keys = keys[at].astype("<u4"), keys[at] >> np.uint64(32)
        bounds = np.searchsorted(keys, np.arange(high - low + 1, dtype=np.uint64)).tolist()
        stop = stop.tolist()
        for i in range(high - low):
            a, b = bounds[i], bounds[i + 1]
            yield np.append(ids[stop[i] : stop[i + 1]], np.uint32(END_ID)), terms[a:b], counts[a:b]
        low = high


RESTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("shard", T.LongType()), T.StructField("start", T.LongType()),
    T.StructField("doc_tokens", T.LongType()), T.StructField("crc", T.LongType()), T.StructField("ids", T.BinaryType()),
    T.StructField("terms", T.BinaryType()), T.StructField("counts", T.BinaryType()),
])
RESTS_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("shard", pa.int64()), ("start", pa.int64()), ("doc_tokens", pa.int64()),
    ("crc", pa.int64()), ("ids", pa.binary()), ("terms", pa.binary()), ("counts", pa.binary()),
])


def cutter(path: str):
    """A function over batches of (doc_id, shard, text): whole sequences by their checksum
    alone, and rests with their ids and the words that begin in them."""

    def cut(batches):
        for batch in batches:
            # The worker may come from another stage, whose memory is released here too.
            release()
            at = 0
            for part in chunks(batch.column(2), CHUNK_BYTES):
                vocabulary = shared_vocabulary(path)
                if vocabulary.room() > CACHED_BYTES:
                    vocabulary.thin()
                n, rows = len(part), []
                keys = zip(batch.column(0).slice(at, n).to_pylist(), batch.column(1).slice(at, n).to_pylist(), strict=True)
                at += n
                for (doc, shard), (ids, terms, counts) in zip(keys, tokenized(part, vocabulary), strict=True):
                    whole = len(ids) // LENGTH * LENGTH
                    for start in range(0, whole, LENGTH):
                        rows.append((doc, shard, start, len(ids), crc(ids[start : start + LENGTH]), None, None, None))
                    if whole < len(ids):
                        rows.append((
                            doc, shard, whole, len(ids), None, ids[whole:].astype("<u2").tobytes(),
                            terms.tobytes(), counts.tobytes(),
                        ))
                columns = zip(*rows, strict=True) if rows else ([] for _ in RESTS_ARROW)
                yield pa.record_batch(
                    [pa.array(list(c), f.type) for c, f in zip(columns, RESTS_ARROW, strict=True)], schema=RESTS_ARROW
                )
            release()

    return cut


class Index:
    """A BM25 inverted index of the rests of a shard."""

    def __init__(self, terms: list[np.ndarray], counts: list[np.ndarray]):
        n, sizes = len(terms), np.array([len(t) for t in terms], np.int64)
        lengths = np.array([c.sum() for c in counts], np.float64)
        # Sorted by word, then by place: a word's postings are in order of their rests.
        every = np.concatenate([np.zeros(0, np.uint32), *terms])
        keys = np.sort((every.astype(np.uint64) << np.uint64(32)) | np.arange(len(every), dtype=np.uint64))
        order, word = (keys & np.uint64(0xFFFFFFFF)).astype(np.int64), keys >> np.uint64(32)
        number = np.cumsum(word != np.concatenate([word[:1], word[:-1]]))
        tf = np.concatenate([np.zeros(0), *counts])[order]
        owner = np.repeat(np.arange(n), sizes)[order]
        df = np.bincount(number)
        # Words of more than half the rests count for nothing rather than against a neighbour.
        idf = np.maximum(np.log((n - df + 0.5) / (df + 0.5)), 0)
        norm = K1 * (1 - B + B * lengths / max(lengths.mean() if n else 1.0, 1.0))
        weight = idf[number] * tf * (K1 + 1) / (tf + norm[owner])
        kept = weight > 0
        self.n, self.owner, self.weight = n, owner[kept], weight[kept]
        self.begin = np.searchsorted(number[kept], np.arange(len(df) + 1))
        place = np.empty(len(every), np.int64)
        place[order] = number
        self.own = np.split(place, np.cumsum(sizes)[:-1]) if n else []

    def like(self, seed: int) -> np.ndarray:
        """Scores of all rests for the words of ``seed``."""
        words = self.own[seed]
        begin, size = self.begin[words], self.begin[words + 1] - self.begin[words]
        at = flat(begin, size)
        return np.bincount(self.owner[at], self.weight[at], self.n)

    def keep(self, left: np.ndarray) -> None:
        """Forget the postings of rests that are used; the scores of others stay as they are."""
        kept = left[self.owner]
        self.begin = np.concatenate([np.zeros(1, np.int64), np.cumsum(kept)])[self.begin]
        self.owner, self.weight = self.owner[kept], self.weight[kept]


def fill(sizes: list[int], index: Index):
    """Sequences as lists of (rest, from, to), which cover every rest once, in order."""
    sizes = np.array(sizes, np.int64)
    begin, size, left = np.zeros(len(sizes), np.int64), sizes.copy(), np.ones(len(sizes), bool)
    count = indexed = len(sizes)
    longest = list(zip((-sizes).tolist(), range(len(sizes)), strict=True))
    heapq.heapify(longest)

    def head() -> int | None:
        """The longest unused rest; entries of what it was before are passed over."""
        while longest and (not left[longest[0][1]] or -longest[0][0] != size[longest[0][1]]):
            heapq.heappop(longest)
        return longest[0][1] if longest else None

    while count:
        seed = head()
        took, room = [(seed, int(begin[seed]), int(sizes[seed]))], LENGTH - int(size[seed])
        left[seed], count = False, count - 1
        passed = None
        if room:
            if count < indexed * FORGET:
                index.keep(left)
                indexed = count
            scores = index.like(seed)
            near = np.flatnonzero((scores > 0) & left)
            near = near[np.argsort(-scores[near], kind="stable")]
            while room and len(near):
                fits = np.flatnonzero(size[near] <= room)
                if passed is None and (len(fits) == 0 or fits[0]):
                    passed = int(near[0])
                if len(fits) == 0:
                    break
                i = int(near[fits[0]])
                took.append((i, int(begin[i]), int(sizes[i])))
                room -= int(size[i])
                left[i], count = False, count - 1
                # What was too long for the room before is too long for less; the first such is still sought.
                near = near[1:] if passed is None else near[fits[1:]]
        while room and count:
            other = passed if passed is not None and left[passed] else head()
            passed = None
            n = min(room, int(size[other]))
            took.append((other, int(begin[other]), int(begin[other]) + n))
            begin[other] += n
            size[other] -= n
            room -= n
            if size[other]:
                heapq.heappush(longest, (-int(size[other]), other))
            else:
                left[other], count = False, count - 1
        yield took


def packed_shard(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    shard = int(key[0]) << 32
    rows = rows.sort_values(["doc_id", "start", "ids"], na_position="first", kind="stable")
    whole, rest = rows[rows.ids.isna()], rows[rows.ids.notna()]
    out = [
        (r.doc_id, r.start, LENGTH, r.crc, r.doc_tokens, shard + i, 0) for i, r in enumerate(whole.itertuples(index=False))
    ]
    ids = [np.frombuffer(x, "<u2") for x in rest.ids]
    index = Index([np.frombuffer(x, "<u4") for x in rest.terms], [np.frombuffer(x, "<u2") for x in rest.counts])
    docs, starts, tokens = rest.doc_id.tolist(), rest.start.tolist(), rest.doc_tokens.tolist()
    for n, took in enumerate(fill([len(x) for x in ids], index), len(out)):
        offset = 0
        for i, low, high in took:
            out.append((docs[i], starts[i] + low, high - low, crc(ids[i][low:high]), tokens[i], shard + n, offset))
            offset += high - low
    frame = pd.DataFrame(out, columns=[c.split()[0] for c in PIECES.split(", ")])
    return frame.astype({c: "Int64" for c in frame.columns})


def packed(docs: DataFrame, tokenizer_path: str, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The pieces of all documents in their sequences (see ``PIECES``).

    A null text is an empty one: its only token is the end id. Rows that share a doc_id
    are packed each for itself. A piece's ``start`` counts its document's ids before it,
    ``doc_tokens`` includes the end id, and ``offset`` has no gaps within a sequence.
    """
    shards = max(1, -(-docs.count() // shard_rows))
    dealt = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), F.lit(shards)).alias("shard"),
        text().alias("text"),
    )
    rests = dealt.mapInArrow(cutter(tokenizer_path), RESTS)
    return rests.groupBy("shard").applyInPandas(packed_shard, PIECES)
