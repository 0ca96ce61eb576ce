"""Places, blocks and running values, with a key that holds most rows and sparse ones."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from barline.operators import rolling
from barline.operators.batches import batch_ids
from barline.operators.series import POS, Series, over_series, running

WHOLE = Series(months=12_000)
PLANS = [WHOLE, Series(), Series(months=5), Series(months=1)]
START = date(1996, 11, 5)


@pytest.fixture(scope="module")
def rows():
    """One key with two thirds of the rows, one short, one with gaps of months and of years,
    one that ends early, and some of one row."""
    chance = random.Random(4)
    days = {"HOT": range(2000), "WARM": range(900), "GAPS": range(0, 3000, 47), "RARE": (3, 900, 2400), "DEAD": range(70)}
    days |= {f"K{i}": (i * 31,) for i in range(60)}
    out = [
        (key, START + timedelta(days=d), chance.randint(1, 9) if chance.random() > 0.3 else None)
        for key, when in days.items() for d in when
    ]
    chance.shuffle(out)
    return out


@pytest.fixture(scope="module")
def bars(spark, rows):
    return spark.createDataFrame(rows, "ticker string, trade_date date, x int").repartition(7)


def in_order(rows):
    series = {}
    for key, day, x in sorted(rows, key=lambda r: r[:2]):
        series.setdefault(key, []).append((day, x))
    return series


def values(df, *columns):
    return sorted(tuple(r) for r in df.select("ticker", "trade_date", *columns).collect())


@pytest.mark.parametrize("series", PLANS, ids=str)
def test_rows_are_placed_from_one(bars, rows, series):
    got = values(over_series(bars, series, 0, lambda df, _: df), POS)
    assert got == sorted((k, day, i + 1) for k, own in in_order(rows).items() for i, (day, _) in enumerate(own))


@pytest.mark.parametrize("series", PLANS, ids=str)
def test_frames_reach_across_blocks(bars, rows, series):
    def build(df, frame):
        last = frame.last(30)
        df = df.withColumns({"s": F.sum("x").over(last), "n": F.count("x").over(last)})
        return df.withColumn("d", rolling.difference(F.col("x"), frame))

    want = []
    for key, own in in_order(rows).items():
        for i, (day, x) in enumerate(own):
            frame = [v for _, v in own[max(i - 29, 0) : i + 1] if v is not None]
            before = own[i - 1][1] if i else None
            change = None if x is None or before is None else x - before
            want.append((key, day, sum(frame) if frame else None, len(frame), change))
    got = over_series(bars, series, 30, build, columns=["x"])
    assert str(values(got, "s", "n", "d")) == str(sorted(want, key=lambda r: r[:2]))


@pytest.mark.parametrize("kind", ["sum", "max", "ffill"])
@pytest.mark.parametrize("series", PLANS, ids=str)
def test_running_values_carry_over_blocks(bars, rows, series, kind):
    want = []
    for key, own in in_order(rows).items():
        now = None
        for day, x in own:
            if x is not None:
                now = x if now is None or kind == "ffill" else now + x if kind == "sum" else max(now, x)
            want.append((key, day, now))
    assert str(values(running(bars, series, "x", kind, "y"), "y")) == str(sorted(want, key=lambda r: r[:2]))


def test_running_sums_equal_sliding_ones(bars):
    def build(df, frame):
        df = df.withColumn("slow", F.coalesce(F.sum("x").over(frame.last(20)), F.lit(0)))
        return rolling.with_rolling_sums(df, frame, {"fast": ("x", 20)})

    assert all(over_series(bars, series, 20, build).filter("slow <> fast").count() == 0 for series in PLANS)


def test_no_block_holds_more_than_its_rows_and_copies(bars):
    sizes = []

    def build(df, frame):
        sizes.append(df.groupBy(*frame.by).count().agg(F.max("count")).first()[0])
        return df

    over_series(bars, Series(months=3), 20, build)
    assert 92 < sizes[0] <= 92 + 20


def test_no_job_runs_while_plans_are_built(spark):
    from barline.queries import REGISTRY

    names = "enriched_bars sma ema macd drawdown ffill momentum all_strategies portfolio backtest_report".split()
    sf = "/root/testdata/sf0.001"
    for name in names:
        REGISTRY[name].run(spark, sf)  # writes the tables they read, once
    context = spark.sparkContext
    context.setJobGroup("plans", "plans")
    try:
        for name in names:
            REGISTRY[name].run(spark, sf)
        assert not context.statusTracker().getJobIdsForGroup("plans")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def test_batches_cut_the_sorted_list(bars):
    got = batch_ids(bars.select("ticker", "trade_date"), ("ticker", "trade_date"), 500)
    rows = sorted((r.ticker, r.trade_date, r.batch_id) for r in got.collect())
    assert [r[2] for r in rows] == [i // 500 for i in range(len(rows))]


def test_percent_change_from_zero(spark):
    rows = [("A", START + timedelta(days=i), x) for i, x in enumerate([0.0, 2.0, 3.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "ticker string, trade_date date, x double")
    added = rolling.add_columns(df, Series(), 1, lambda f: {"r": rolling.percent_change(F.col("x"), f)})
    assert [r.r for r in added.orderBy("trade_date").collect()] == [None, float("inf"), 0.5, -1.0, None]


def test_drawdown_from_a_peak_of_zero(spark, monkeypatch):
    """As its SQL: not a number while the highest close is zero, and ordinary after."""
    import math
    from decimal import Decimal

    from barline.queries import windows

    closes = {"Z": ["0", "0", "2", "1", "0"], "A": ["4", "2"]}
    table = spark.createDataFrame(
        [(k, START + timedelta(days=i), Decimal(x), float(x)) for k, own in closes.items() for i, x in enumerate(own)],
        "ticker string, trade_date date, close_price decimal(19,4), x double",
    )
    monkeypatch.setattr(windows, "with_price", lambda *_: (table, Series()))
    got = {}
    for ticker, _, fall in values(windows.drawdown(spark, ""), "drawdown"):
        got.setdefault(ticker, []).append(fall)
    assert all(math.isnan(x) for x in got["Z"][:2]) and got["Z"][2:] == [0.0, -0.5, -1.0]
    assert got["A"] == [0.0, -0.5]
