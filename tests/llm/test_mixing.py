"""Mixing against exact fractions, and its edge cases."""

import random
import re
from fractions import Fraction

import pytest

from barline.llm import mixing


def shares(sizes):
    """Targets of (source -> words) by the rule, in fractions: share, stop, share the rest anew."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, left, free = {}, Fraction(sum(sizes.values())), set(names)
    while True:
        each = left / sum(weight[s] for s in free) if free else 0
        above = {s for s in free if weight[s] * each > 3 * sizes[s]}
        if not above:
            return target | {s: weight[s] * each for s in free}
        target |= {s: Fraction(3 * sizes[s]) for s in above}
        left -= sum(target[s] for s in above)
        free -= above


def docs(spark, rows):
    kinds = "doc_id long, text string, source string, size string, target int, draw string, salt int, doc string, Copies int"
    return spark.createDataFrame([(*r, "x", 1, "y", 2, "z", 3) for r in rows], kinds)


def result(df):
    return sorted(((r.doc_id, r.text, r.source, r.size, r.source_size, r.target, r.copies) for r in df.collect()), key=str)


def test_targets_are_the_exact_shares(spark):
    rng = random.Random(5)
    for case in range(4):
        names = [None, "", "b", "B", "é", "\U0001f600", "￿", *(f"s{i}" for i in range(case * 6))]
        sizes = {s: rng.choice([0, 1, 3, 40, 900, 20_000]) for s in names}
        rows = [(i, " ".join(["w"] * n), s) for i, (s, n) in enumerate(sizes.items())]
        got = {r.source: r for r in mixing.rates(docs(spark, rows)).collect()}
        want = shares(sizes)
        assert {s: r.source_size for s, r in got.items()} == sizes
        for s, r in got.items():
            assert r.target == pytest.approx(float(want[s]), rel=1e-12)
            assert r.rate == pytest.approx(float(want[s] / sizes[s]) if sizes[s] else 0, rel=1e-12)
            assert r.target <= 3 * sizes[s]


def test_documents_are_taken_near_their_source_s_target(spark):
    rng = random.Random(6)
    rows = [(i, "a b\tc\x0bd" * rng.randint(0, 9), rng.choice(["x"] * 20 + ["y", "z"])) for i in range(6000)]
    got = mixing.allotted(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    assert all(r.size == len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in got)
    for source in "xyz":
        own = [r for r in got if r.source == source]
        assert sum(r.size for r in own) == own[0].source_size
        assert sum(r.size * r.copies for r in own) == pytest.approx(own[0].target, rel=0.1)
        rate = own[0].target / own[0].source_size
        assert {r.copies for r in own} <= {int(rate), int(rate) + 1} and max(r.copies for r in own) <= 3


def test_joins_by_salt_and_by_broadcast_agree_and_reruns_too(spark):
    rows = [(None, f"t{i} u", "hot") for i in range(300)] + [(i, f"a b {i}", f"s{i % 7}") for i in range(200)]
    table = docs(spark, rows)
    first = result(mixing.allotted(table))
    assert first == result(mixing.allotted(table.repartition(7), broadcast_sources=0))
    assert len({r[-1] for r in first if r[0] is None}) > 1  # rows without an id draw apart


def test_mix_holds_every_copy_and_all_columns(spark):
    rows = [(i, "a b c", "s") for i in range(5)] + [(9, None, None), (9, None, None), (10, "", "s"), (11, " \n", None)]
    table = docs(spark, rows)
    allotted = mixing.allotted(table)
    assert set(allotted.columns) == {"doc_id", "text", "source", "draw", "salt", "doc", *mixing.ADDED}
    assert {(r.target, r.copies) for r in allotted.filter("source is null").collect()} == {(0.0, 0)}
    mix = mixing.mixed(table).collect()
    assert len(mix) == sum(r.copies for r in allotted.collect())
    assert len({(r.doc_id, r.copy) for r in mix}) == len(mix)
    assert mixing.allotted(docs(spark, [])).count() == mixing.mixed(docs(spark, [])).count() == 0
