"""Conversation structure repair by a shortest path whose weights are single integers.

A conversation is right if the initials of its roles are ``(s?(ua)+)?``. Its rows, in
order, are kept, given another role or deleted, and empty turns are inserted before, between
and after them; the cheapest edits win, and of equally cheap ones the ASCII-least string of
their initials, the audit.

A path through rows and states (nothing yet, system, user, assistant last) has one integer
as its weight. Its high digits are the cost. Below are as many octal digits as a path can
have edits: the first edit's letter in the highest, each next in the next lower, and zeros
after the last, so that the integers' order is the order of (cost, audit). The plain
minimum in every state decides everything. This is safe because two different paths to a
state with equal cost cannot be beginnings of each other: the longer would have inserts
alone more, which cost.

Nothing needs a conversation in one place, but for its own result. Rows are sorted by
ranges, which cut a long conversation among tasks, and stored. Blocks of at most 512 of its
rows give a weight for each pair of states, each block in its own group. The blocks are then
read in order: weights of two parts add up to one of both, and what all four best paths have
in common is set down and taken off, so integers stay short. Last, the rows pass by in order
beside their audit; SHA-256 of a conversation's text is a stream by its nature.

Defined results: a null role or text is one space, a null turn comes first, a null conv_id is
a conversation of its own. Rows with equal turns are in order of role, then text; repeated
rows stay and count as duplicates. An empty table gives an empty one. Only conv_id, turn,
role and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.llm.tables import digest, file_number, stored
from barline.session import fresh_path

# Costs, letters in ASCII order as octal digits, characters that do not count
# as text, ends of a whole sentence, and the damage that a remainder stands for.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
LETTERS = {"D": 1, "I": 2, "K": 3, "R": 4}
SPACES = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
USER, ASSISTANT = "user", "assistant"
DAMAGES, DROP, EMPTY, UNSTOP, REPEAT, RENAME = 20, 0, 1, 2, 3, 4

BLOCK_BITS = 9
START, SYSTEM, HUMAN, MODEL = range(4)
STATES = range(4)
# The state after a turn with an initial, from each state that may have it next.
NEXT = {
    "s": {START: SYSTEM}, "u": {START: HUMAN, SYSTEM: HUMAN, MODEL: HUMAN}, "a": {HUMAN: MODEL}, "o": {},
}
SPREAD = 2 * INSERT + DELETE
ADDABLE = {**NEXT["u"], **NEXT["a"]}  # by a turn that is inserted or renamed
INITIALS = "suao"  # o: any other
LEGAL = {"su", "ua", "au"}


# --- rows ----------------------------------------------------------------------------


def key() -> Column:
    """A conversation's id as text; a missing one is empty, which no id is."""
    return F.coalesce(F.col("conv_id").cast("string"), F.lit(""))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with the faults that a hash of id and turn picks."""
    shown = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))), F.lit(DAMAGES))
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        shown("role").alias("role"), shown("text").alias("text"), kind.alias("kind"),
    ).filter(F.col("kind") != DROP)
    said = F.when(F.col("kind") == EMPTY, "").when(
        F.col("kind") == UNSTOP, F.translate("text", "".join(ENDS), "")
    ).otherwise(F.col("text"))
    role = F.when(F.col("kind") == RENAME, USER).otherwise(F.col("role"))
    times = F.when(F.col("kind") == REPEAT, 2).otherwise(1)
    return rows.select("conv_id", "turn", role.alias("role"), said.alias("text"), F.sequence(F.lit(1), times).alias("i")).select(
        "conv_id", "turn", "role", "text", F.explode("i")
    ).drop("col")


def placed(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, text, at): stored in order; ``at`` grows with it.

    Ranges are dealt by the beginnings of texts, so that no long text goes into a sample."""
    given = rows.select(
        key().alias("conv"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    )
    path = fresh_path(rows.sparkSession, "chat-rows")
    given.repartitionByRange("conv", "turn", "role", F.substring("text", 1, 64)).sortWithinPartitions(
        "conv", "turn", "role", "text"
    ).write.parquet(path)
    at = F.shiftleft(file_number(), 40) + F.col("_metadata.row_index")
    return rows.sparkSession.read.schema(given.schema).parquet(path).withColumn("at", at)


def faults(rows: DataFrame) -> DataFrame:
    """(conv, turn, at, initial, blank, duplicate, truncated) of placed rows; a row has its
    first fault alone. Duplicates are found from the least place of each role and text, a
    sum that is formed before the shuffle, however many rows are alike."""
    said = F.rtrim(F.col("text"), F.lit(SPACES))
    head = F.substring("role", 1, 1)
    narrow = rows.select(
        "conv", "turn", "at", F.when(head.isin("s", "u", "a"), head).otherwise("o").alias("initial"),
        (said == "").alias("blank"), (~F.right(said, F.lit(1)).isin(*ENDS)).alias("open"),
        digest(F.concat(F.col("role"), F.lit("\n"), F.col("text"))).alias("said"),
    )
    firsts = narrow.groupBy("conv", "said").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    firsts = firsts.filter("n > 1").drop("n")
    again = F.coalesce(F.col("at") > F.col("first"), F.lit(False))
    return narrow.join(firsts, ["conv", "said"], "left").select(
        "conv", "turn", "at", "initial", "blank", (~F.col("blank") & again).alias("duplicate"),
        (~F.col("blank") & ~again & F.col("open")).alias("truncated"),
    )


def blocks(found: DataFrame) -> DataFrame:
    """One row for each run of at most 512 rows of a conversation, with its weights."""
    code = F.concat(
        "initial", F.when(F.col("blank") | F.col("duplicate"), "x").when(F.col("truncated"), "t").otherwise("k")
    )
    runs = found.groupBy("conv", F.shiftright("at", BLOCK_BITS).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("at", "turn", code.alias("code")))).alias("run"),
        *(F.sum(F.col(c).cast("bigint")).alias(c) for c in ("blank", "duplicate", "truncated")),
    )
    turns = F.filter(F.transform("run", lambda r: r.turn), lambda t: t.isNotNull())
    told = runs.select(
        "conv", "block", F.array_join(F.transform("run", lambda r: r.code), "").alias("codes"),
        F.array_min(turns).alias("first_turn"), F.array_max(turns).alias("last_turn"),
        F.size(F.array_distinct(turns)).cast("bigint").alias("turns"), "blank", "duplicate", "truncated",
    )
    fields = [(f.name, f.dataType.simpleString()) for f in told.schema.fields]
    schema = ", ".join(f"{n} {t}" for n, t in fields) + ", illegal bigint, weights array<binary>"

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = batch.column("codes").to_pylist()
            illegal = pa.array([wrong_pairs(c[::2]) for c in codes], pa.int64())
            weights = pa.array([packed(c) for c in codes], pa.list_(pa.binary()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, illegal, weights], names=[*batch.schema.names, "illegal", "weights"]
            )

    return told.mapInArrow(weigh, schema)


def wrong_pairs(initials: str) -> int:
    return sum(initials[i : i + 2] not in LEGAL for i in range(len(initials) - 1))


# --- weights -------------------------------------------------------------------------


class Paths:
    """The best path to each state: (weight, edits), with room for ``width`` edits."""

    def __init__(self, width: int, start: int):
        self.width, self.best = width, {start: (0, 0)}

    def plus(self, path: tuple[int, int], letter: str, cost: int) -> tuple[int, int]:
        weight, edits = path
        digit = LETTERS[letter] << 3 * (self.width - 1 - edits)
        return weight + (cost << 3 * self.width) + digit, edits + 1

    def insert(self) -> None:
        """Up to two turns: a third would come back to the state that one leads to."""
        last = self.best
        for _ in range(2):
            last = {ADDABLE[q]: self.plus(p, "I", INSERT) for q, p in sorted(last.items(), key=lambda x: x[1], reverse=True)}
            self.best = least([*self.best.items(), *last.items()])

    def row(self, initial: str, kind: str) -> None:
        found = [(q, self.plus(p, "D", DELETE)) for q, p in self.best.items()]
        if kind != "x":
            extra = TRUNCATED if kind == "t" else 0
            for q, p in self.best.items():
                if q in NEXT[initial]:
                    found.append((NEXT[initial][q], self.plus(p, "K", KEEP + extra)))
                found.append((ADDABLE[q], self.plus(p, "R", REROLE + extra)))
        self.best = least(found)


def least(paths) -> dict[int, tuple[int, int]]:
    best: dict[int, tuple[int, int]] = {}
    for q, p in paths:
        if q not in best or p < best[q]:
            best[q] = p
    return best


@lru_cache(maxsize=4096)
def packed(codes: str) -> list[bytes | None]:
    """The weights of a block from each state to each, in octal room for three edits a row."""
    out: list[bytes | None] = []
    for start in STATES:
        paths = Paths(3 * (len(codes) // 2), start)
        for i in range(0, len(codes), 2):
            paths.insert()
            paths.row(codes[i], codes[i + 1])
        for q in STATES:
            weight = paths.best[q][0] if q in paths.best else None
            out.append(None if weight is None else weight.to_bytes((weight.bit_length() + 7) // 8, "big"))
    return out


def edits_in(weight: int, width: int) -> int:
    """How many digits a weight's audit has: zeros are at its end alone."""
    audit = weight & ((1 << 3 * width) - 1)
    return width - ((audit & -audit).bit_length() - 1) // 3 if audit else 0


class Conversation:
    """The blocks of one conversation, taken in order."""

    def __init__(self):
        self.paths, self.said, self.cost = Paths(0, START), [], 0
        self.sums = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0)
        self.first_turn = self.last_turn = self.initial = None

    def take(self, block: dict) -> None:
        for name in self.sums:
            self.sums[name] += block[name]
        if self.initial is not None:
            self.sums["illegal"] += wrong_pairs(self.initial + block["codes"][0])
        self.initial = block["codes"][-2]
        if block["first_turn"] is not None:
            self.sums["turns"] -= block["first_turn"] == self.last_turn
            self.first_turn = block["first_turn"] if self.first_turn is None else self.first_turn
            self.last_turn = block["last_turn"]
        self.join(block["weights"], 3 * (len(block["codes"]) // 2))
        self.settle()

    def join(self, weights: list[bytes | None], more: int) -> None:
        """Paths and a block's paths end to end: costs add, digits follow each other."""
        width = self.paths.width
        found = []
        for p, (weight, edits) in self.paths.best.items():
            cost, audit = weight >> 3 * width, weight & ((1 << 3 * width) - 1)
            for q in STATES:
                if (data := weights[len(STATES) * p + q]) is not None:
                    step = int.from_bytes(data, "big")
                    digits = step & ((1 << 3 * more) - 1)
                    whole = (audit << 3 * more) + (digits << 3 * (width - edits))
                    total = (cost + (step >> 3 * more)) << 3 * (width + more)
                    found.append((q, (total + whole, edits + edits_in(step, more))))
        self.paths.width, self.paths.best = width + more, least(found)

    def settle(self) -> None:
        """Set down the edits that all best paths begin with, and the cost that all have.

        A path that costs over ``SPREAD`` more than another cannot win: from any state, two
        inserted turns and one deleted system row do for what any other allows later."""
        width = self.paths.width
        low = min(w >> 3 * width for w, _ in self.paths.best.values())
        paths = self.paths.best = {q: p for q, p in self.paths.best.items() if p[0] >> 3 * width <= low + SPREAD}
        audits = {q: w & ((1 << 3 * width) - 1) for q, (w, _) in paths.items()}
        one = next(iter(audits.values()))
        differ = 0
        for a in audits.values():
            differ |= a ^ one
        same = min(width - -(-differ.bit_length() // 3), *(e for _, e in paths.values()))
        spare = min(width - e for _, e in paths.values())  # zeros that no path has used
        self.said.append(letters(one >> 3 * (width - same), same))
        self.cost += low
        left = width - same - spare
        self.paths.best = {
            q: ((((w >> 3 * width) - low) << 3 * left) + ((audits[q] & ((1 << 3 * (width - same)) - 1)) >> 3 * spare), e - same)
            for q, (w, e) in paths.items()
        }
        self.paths.width = left

    def result(self) -> dict:
        more = 2
        self.paths.best = {
            q: (((w >> 3 * self.paths.width) << 3 * (self.paths.width + more))
                + ((w & ((1 << 3 * self.paths.width) - 1)) << 3 * more), e)
            for q, (w, e) in self.paths.best.items()
        }
        self.paths.width += more
        self.paths.insert()
        weight, edits = min(p for q, p in self.paths.best.items() if q in (START, MODEL))
        width = self.paths.width
        audit = (weight & ((1 << 3 * width) - 1)) >> 3 * (width - edits)
        known = self.first_turn is not None
        return {
            "gaps": self.last_turn - self.first_turn + 1 - self.sums["turns"] if known else 0,
            **{n: self.sums[n] for n in ("blank", "duplicate", "truncated", "illegal")},
            "cost": self.cost + (weight >> 3 * width), "audit": "".join(self.said) + letters(audit, edits),
        }


def letters(audit: int, edits: int) -> str:
    if not edits:
        return ""
    return f"{audit:0{edits}o}".translate({ord(str(n)): c for c, n in LETTERS.items()})


REPORT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"


def plans(parts: DataFrame) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit) of each conversation
    with rows; its blocks pass by in order."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, whole = None, None
        for batch in batches:
            done = []
            for block in batch.to_pylist():
                if block["conv"] != now:
                    if whole is not None:
                        done.append({"conv": now, **whole.result()})
                    now, whole = block["conv"], Conversation()
                whole.take(block)
            yield report(done)
        if whole is not None:
            yield report([{"conv": now, **whole.result()}])

    return parts.repartition("conv").sortWithinPartitions("conv", "block").mapInArrow(fold, f"conv string, {REPORT}")


def report(done: list[dict]) -> pa.RecordBatch:
    kinds = [(x.split()[0], pa.string() if x.endswith("string") else pa.int64()) for x in f"conv string, {REPORT}".split(", ")]
    return pa.RecordBatch.from_pylist(done, schema=pa.schema(kinds))


# --- repaired rows -------------------------------------------------------------------


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(conv, place, role, text) of placed rows after the edits of ``plans``, in order
    within each partition; a conversation of which nothing is left has no row."""
    edits = found.select("conv", F.lit(-1).cast("bigint").alias("at"), F.lit("").alias("role"), F.col("audit").alias("text"))
    both = rows.select("conv", "at", "role", "text").unionByName(edits)

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: Edited | None = None
        for batch in batches:
            out: list[tuple] = []
            for conv, at, role, said in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at < 0:
                    if now is not None:
                        out += now.inserted()
                    now = Edited(conv, said)
                else:
                    out += now.row(role, said)
            yield written(out)
        if now is not None:
            yield written(now.inserted())

    return both.repartition("conv").sortWithinPartitions("conv", "at").mapInArrow(edit, "conv string, place bigint, role string, text string")


def written(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * 4
    kinds = (pa.string(), pa.int64(), pa.large_string(), pa.large_string())
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["conv", "place", "role", "text"])


class Edited:
    """A conversation's rows as its audit changes them."""

    def __init__(self, conv: str, audit: str):
        self.conv, self.audit, self.used, self.place, self.state = conv, audit, 0, 0, START

    def add(self, role: str, said: str) -> tuple:
        self.state = NEXT[role[0]][self.state]
        self.place += 1
        return self.conv, self.place, role, said

    def wanted(self) -> str:
        return ASSISTANT if self.state == HUMAN else USER

    def inserted(self) -> list[tuple]:
        out = []
        while self.audit[self.used : self.used + 1] == "I":
            self.used += 1
            out.append(self.add(self.wanted(), ""))
        return out

    def row(self, role: str, said: str) -> list[tuple]:
        out = self.inserted()
        letter = self.audit[self.used]
        self.used += 1
        if letter != "D":
            out.append(self.add(role if letter == "K" else self.wanted(), said))
        return out


def digests(rows: DataFrame) -> DataFrame:
    """(conv, repaired_sha256) of rows as ``repaired`` streams them, in its partitions."""

    def hash_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha = None, None
        kept: list[tuple] = []
        for batch in batches:
            for conv, role, said in zip(*(batch.column(c).to_pylist() for c in ("conv", "role", "text")), strict=True):
                if conv != now:
                    if sha is not None:
                        kept.append((now, sha.hexdigest()))
                    now, sha = conv, hashlib.sha256()
                else:
                    sha.update(b"\n")
                sha.update(f"{role}:{said}".encode())
            yield pa.RecordBatch.from_pylist([dict(zip(("conv", "repaired_sha256"), x, strict=True)) for x in kept], schema)
            kept = []
        if sha is not None:
            yield pa.RecordBatch.from_pylist([{"conv": now, "repaired_sha256": sha.hexdigest()}], schema)

    schema = pa.schema([("conv", pa.string()), ("repaired_sha256", pa.string())])
    return rows.mapInArrow(hash_up, "conv string, repaired_sha256 string")


def summary(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """One row for every conversation that ``conversations`` names: what is wrong with its
    ``rows``, the cheapest edits and the digest of what they leave."""
    in_order = placed(rows)
    found = stored(plans(blocks(faults(in_order))), "chat-plans")
    names = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct().withColumn("conv", key())
    zeros = {x.split()[0]: F.lit(0).cast("bigint") for x in REPORT.split(", ")} | {"audit": F.lit("")}
    return names.join(found, "conv", "left").join(digests(repaired(in_order, found)), "conv", "left").select(
        "conv_id", *(F.coalesce(c, z).alias(c) for c, z in zeros.items()),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
