"""Personal data by base patterns and bootstrapped contexts.

Base patterns find e-mail addresses, IP addresses, card and phone numbers. They are the
seeds of a bootstrap: what stands before and after a seed is a lexical pattern, and what
else stands in the same place may be an identifier too, in a form no base pattern
knows. Spark keeps the graph of patterns and instances as a table of distinct edges. In
each round a pattern's confidence in a kind is the share of its instances that are known
to be of that kind, a pattern with enough of them is trusted, and an instance gets the
chance that any of its trusted patterns is right; instances over the limit are known in
the next round. Rounds end when no instance is new. Finally, every place where a known instance stands in a trusted pattern
is a span.

An instance is a run between blanks that holds a digit or an at sign, without the marks
around it, or up to nine groups of digits with single blanks between them; a place inside
a longer one that is found too is not listed. So tables of the bootstrap grow with identifiers, not with prose.
"""

from __future__ import annotations

import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barline.llm.tables import ROW, numbered, stored, text

# The base patterns, in the order in which spans are listed.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
COMPILED = {k: re.compile(p) for k, p in PATTERNS.items()}

MIN_KNOWN, CONFIDENCE, BELIEF = 3, 0.8, 0.8
MIN_INSTANCE = 6


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def valid(kind: str, found: str) -> bool:
    if kind == "email":
        return True
    if kind == "ip":
        return all(int(p[-4:]) <= 255 and len(p.lstrip("0")) <= 3 for p in found.split("."))
    digits = re.sub("[^0-9]", "", found)
    return 16 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 8 <= len(digits) <= 15


def runs_with(mark: re.Pattern, value: str):
    """(start, end) of the runs between blanks that hold a match of ``mark``."""
    at = 0
    while m := mark.search(value, at):
        start, at = m.start(), m.end()
        while start and not value[start - 1].isspace():
            start -= 1
        blank = BLANK.search(value, at)
        at = blank.start() if blank else len(value)
        yield start, at


AT, BLANK, DIGIT_OR_AT = re.compile("@"), re.compile(r"\s"), re.compile("[0-9@]")


def base_spans(value: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) by the base patterns; leftmost, each kind for itself.

    An address holds no blank, so its pattern is tried in the runs with an at sign only."""
    out = []
    for n, kind in enumerate(KINDS):
        spots = runs_with(AT, value) if kind == "email" else [(0, len(value))]
        for low, high in spots:
            out.extend(
                (n, m.start(), m.end()) for m in COMPILED[kind].finditer(value, low, high) if valid(kind, m.group())
            )
    return out


MARKS = " \t\r\n.,;:!?\"'()[]{}<>|*`"


def context(value: str, start: int, end: int) -> list[str]:
    """The lexical patterns around a place: two words before, and one on either side.

    Digits are written 0, so that numbers in a pattern do not keep it apart."""
    before = value[max(0, start - 80) : start].lower().split()[-2:]
    after = value[end : end + 40].lower().split()[:1]
    left = [re.sub("[0-9]", "0", w.strip(MARKS)) or w for w in before]
    right = [re.sub("[0-9]", "0", w.strip(MARKS)) or w for w in after]
    patterns = []
    if len(left) == 2:
        patterns.append(f"{left[0]} {left[1]} _")
    if left and right:
        patterns.append(f"{left[-1]} _ {right[0]}")
    return patterns


GROUP = r"[0-9][0-9().+/-]*"
GROUPS = re.compile(
    rf"(?<![^\s\"'\[{{<:;,])[(+]{{0,2}}[A-Za-z]{{0,3}}{GROUP}(?:[ \t\u00a0]\(?{GROUP}){{1,8}}(?![^\s,;:!?\"'\]}}>])(?!\s\(?[0-9])"
)


def digit_groups(value: str):
    """(start, end) of the runs of two to nine groups of digits with one blank between them."""
    for m in GROUPS.finditer(value):
        low, high = m.span()
        while value[high - 1] in "(.+/-" or value[high - 1] == ")" and "(" not in value[low:high]:
            high -= 1
        if value[low] == "(" and ")" not in value[low:high]:
            low += 1
        if any(c.isspace() for c in value[low:high]):
            yield low, high


def instances(value: str, base: list[tuple[int, int, int]]) -> list[tuple]:
    """(kind number or -1, start, end, instance, patterns) of base spans and other runs."""
    out = [(k, s, e, value[s:e].lower(), context(value, s, e)) for k, s, e in base]
    taken = sorted((s, e) for _, s, e in base)
    for low, high in runs_with(DIGIT_OR_AT, value):
        while low < high and value[low] in MARKS:
            low += 1
        while high > low and value[high - 1] in MARKS:
            high -= 1
        if high - low >= MIN_INSTANCE and not any(s < high and low < e for s, e in taken):
            out.append((-1, low, high, value[low:high].lower(), context(value, low, high)))
    for low, high in digit_groups(value):
        if high - low >= MIN_INSTANCE and not any(s < high and low < e for s, e in taken):
            out.append((-1, low, high, " ".join(value[low:high].lower().split()), context(value, low, high)))
    return out


FOUND = T.ArrayType(T.StructType([
    T.StructField("kind", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
    T.StructField("instance", T.StringType()), T.StructField("patterns", T.ArrayType(T.StringType())),
]))
FOUND_ARROW = pa.list_(pa.struct([
    ("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("instance", pa.string()),
    ("patterns", pa.list_(pa.string())),
]))


@F.arrow_udf(FOUND)
def places(texts: pa.Array) -> pa.Array:
    """Base spans and further candidates of each text, with their contexts."""
    names = ("kind", "start", "end", "instance", "patterns")
    some = pc.fill_null(pc.match_substring_regex(texts, "[0-9@]"), False).to_pylist()
    out = []
    for value, worth in zip(texts, some, strict=True):
        if not worth:
            out.append([])
            continue
        value = value.as_py()
        out.append([dict(zip(names, x, strict=True)) for x in instances(value, base_spans(value))])
    return pa.array(out, FOUND_ARROW)


def bootstrap(seen: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(known, trusted) from occurrences (kind, instance, patterns): instances by kind, and
    patterns by kind with their confidence, once a round finds nothing new."""
    edges = stored(
        seen.select("kind", "instance", F.explode("patterns").alias("pattern")).distinct(), "pii-edges"
    )
    graph = stored(edges.select("pattern", "instance").distinct(), "pii-graph")
    sizes = graph.groupBy("pattern").agg(F.count("*").alias("n"))
    known = stored(seen.filter("kind >= 0").select("kind", "instance").distinct(), "pii-known")
    count, before = known.count(), -1
    while True:
        hits = graph.join(known, "instance").groupBy("pattern", "kind").agg(F.count("*").alias("hits"))
        scored = hits.filter(F.col("hits") >= MIN_KNOWN).join(sizes, "pattern")
        scored = scored.withColumn("confidence", F.col("hits") / F.col("n")).filter(F.col("confidence") >= CONFIDENCE)
        trusted = stored(scored.select("pattern", "kind", "confidence"), "pii-trusted")
        if count == before:
            return known, trusted
        doubt = F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-6)))))
        believed = graph.join(trusted, "pattern").groupBy("kind", "instance").agg((1 - doubt).alias("belief"))
        believed = believed.filter(F.col("belief") >= BELIEF).select("kind", "instance")
        known = stored(known.union(believed).distinct(), "pii-known")
        count, before = known.count(), count


def find(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` with its spans: the row's number, doc_id, base and added, both arrays
    of (kind, start, end) sorted by kind as listed, then start.

    Null and empty texts have none. A place that several trusted patterns give several
    kinds gets the first of them. Added spans never touch base ones.
    """
    rows = numbered(docs).select(
        ROW, F.col("doc_id").cast("bigint").alias("doc_id"), places(text()).alias("found")
    )
    rows = stored(rows, "pii-places")
    spots = rows.select(ROW, F.explode("found").alias("f")).select(ROW, "f.*")
    known, trusted = bootstrap(spots)
    loose = spots.filter("kind < 0").select(ROW, "start", "end", "instance", F.explode("patterns").alias("pattern"))
    added = loose.join(trusted.select("pattern", "kind"), "pattern").join(known, ["kind", "instance"], "left_semi")
    added = added.groupBy(ROW, "start", "end").agg(F.min("kind").alias("kind"))
    added = added.groupBy(ROW).agg(F.collect_list(F.struct("kind", "start", "end")).alias("added"))
    inside = lambda x, y: (y.start <= x.start) & (x.end <= y.end) & (y.end - y.start > x.end - x.start)
    added = added.withColumn("added", F.filter("added", lambda x: ~F.exists("added", lambda y: inside(x, y))))
    base = F.filter("found", lambda x: x.kind >= 0)
    base = F.sort_array(F.transform(base, lambda x: F.struct(x.kind.alias("kind"), x.start.alias("start"), x.end.alias("end"))))
    none = F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>")
    return rows.select(ROW, "doc_id", base.alias("base")).join(added, ROW, "left").withColumn(
        "added", F.sort_array(F.coalesce("added", none))
    )


def listed(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    one = lambda x: F.concat_ws(":", F.get(names, x.kind), x.start.cast("string"), x.end.cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def summary(found: DataFrame) -> DataFrame:
    """Counts of base spans by kind, their digest, and the list of all spans."""
    # A second parameter of the function, with or without a default, would be given the element's place.
    of = lambda n: F.filter("base", lambda x: x.kind == n)
    counts = [F.size(of(n)).cast("bigint").alias(f"n_{kind}") for n, kind in enumerate(KINDS)]
    every = F.sort_array(F.concat("base", "added"))
    return found.select(
        "doc_id", *counts, F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(every).alias("spans"),
        F.size("added").cast("bigint").alias("n_added"),
    )
