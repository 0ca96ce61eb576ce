"""Collocations against plain counting."""

import random
import re
from collections import Counter

import pyarrow as pa

from barline.llm import collocations

KINDS = "doc_id long, text string, lang string, w1 string, n long, phrase string, rank int"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, g, "x", 1, "y", 2) for i, (t, g) in enumerate(rows)], KINDS)


def lowered(text):
    return re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), text or "")


def counted(rows):
    f, n = Counter(), Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text)):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            n[lang or "und"] += len(words)
            for k in (1, 2, 3):
                f.update((lang or "und", *words[i : i + k]) for i in range(len(words) - k + 1))
    return f, n


def plain(rows, least, share, top):
    f, n = counted(rows)
    candidates = {g: a for g, a in f.items() if len(g) > 2 and a >= least}
    out = []
    for g, a in candidates.items():
        longer = [b for h, b in candidates.items() if len(h) > len(g) and h[0] == g[0]
                  and any(h[i : i + len(g) - 1] == g[1:] for i in range(1, len(h)))]
        if any(100 * b >= share * a for b in longer):
            continue
        cuts = [(10**6 * a * a // (f[g[: k + 1]] * f[g[:1] + g[k + 1 :]]), k) for k in range(1, len(g) - 1)]
        score, k = min(cuts)
        out.append((g[0], " ".join(g[1:]), a, f[g[: k + 1]], f[g[:1] + g[k + 1 :]], n[g[0]], score))
    ranked = []
    for lang in {x[0] for x in out}:
        own = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))[:top]
        ranked += [(x[0], i + 1, *x[1:]) for i, x in enumerate(own)]
    return sorted(ranked)


def texts(seed, n):
    rng = random.Random(seed)
    words = ["a", "B", "c", "É", "é", "\U0001f600", "new", "york", "New", "of", " ", "x-y", "'"]
    joins = [" "] * 12 + ["\t ", ".", ", ", "\n", "\x0b", "  ", "; "]
    odd = [(None, "en"), ("", None), (" \t", "en"), (".,;:!?\n\r", ""), ("one", "und"), ("a " * 500, "xx"), ("New York " * 40, None)]
    return odd + [("".join(rng.choice(words) + rng.choice(joins) for _ in range(rng.randint(0, 60))), rng.choice(["en", "de", None])) for _ in range(n)]


def test_phrases_match_plain_counting(spark):
    for seed, least, share, top in ((1, 3, 50, 2000), (2, 2, 20, 2000), (3, 5, 80, 4)):
        rows = texts(seed, 80)
        got = collocations.collocations(docs(spark, rows), least, share, top)
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert sorted(tuple(r) for r in got.collect()) == plain(rows, least, share, top)


def test_counts_of_parts_add_up_to_those_of_the_whole():
    rows = texts(4, 60)
    table = pa.record_batch([pa.array([g or "und" for _, g in rows], pa.string()), pa.array([t for t, _ in rows], pa.string())], names=["lang", "text"])
    f, n = counted(rows)
    want = Counter({g[0] + "\n" + " ".join(g[1:]): c for g, c in f.items()})
    want.update({f"{g}\n": c for g, c in n.items() if c})
    for size in (1, 7, 1000):
        got = Counter()
        for order in (1, 2, 3):
            for batch in collocations.tally(order)(table.slice(i, size) for i in range(0, len(rows), size)):
                for r in batch.to_pylist():
                    got[r["phrase"]] += r["n"]
        assert +got == +want


def test_scores_are_exact_beyond_64_bits(spark):
    cases = [(10**12 - 7, 10**12 - 1, 10**13 + 3), (10**14 + 1, 10**14 + 1, 10**14 + 1), (10, 10, 10), (3, 7, 9)]
    table = spark.createDataFrame(cases, "a long, l long, r long")
    got = [tuple(x) for x in table.select("a", "l", "r", collocations.score(*(table[c] for c in "alr"))).collect()]
    assert got == [(a, b, c, 10**6 * a * a // (b * c)) for a, b, c in cases]


def test_very_long_and_no_texts(spark):
    long = "ab cd " * 300_000
    (row,) = collocations.collocations(docs(spark, [(long, "en")])).filter("phrase = 'ab cd ab'").collect()
    assert (row.a, row.l, row.r, row.n) == (299_999, 300_000, 300_000, 600_000)  # the cut after two words scores least
    assert collocations.collocations(docs(spark, [])).count() == 0
    assert collocations.collocations(docs(spark, [(None, None), ("", "en")])).count() == 0
