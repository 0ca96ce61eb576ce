"""Merges, history, incremental models and stored tables."""

import random
import re
import time
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from barline import schemas
from barline.functions.keys import file_key
from barline.operators import history, merge
from barline.operators.series import Series
from barline.plans import models, refresh
from barline.sources import listed, tables, versions

T0, T1, T2 = datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2024, 1, 3)
KEY = schemas.STOCK_KEY


def bar(ticker, day, close, at=T0):
    price = Decimal(str(close))
    return (ticker, date(2020, 1, 1) + timedelta(days=day), price, price + 1, price - 1, price, 10, price, 3, at)


@pytest.fixture
def bars(spark):
    def make(*rows):
        return spark.createDataFrame([bar(*r) for r in rows], schemas.STOCK_BARS)

    return make


def rows(df, *columns):
    return sorted(tuple(str(v) for v in r) for r in df.select(*(columns or df.columns)).collect())


def test_upsert_replaces_inserts_and_is_idempotent(bars):
    target, batch = bars(("A", 0, 5), ("A", 1, 6)), bars(("A", 1, 7), ("B", 0, 8))
    once = merge.upsert(target, batch, KEY, T1)
    assert rows(once, "ticker", "close", "inserted_at") == [
        ("A", "5.0000", str(T0)), ("A", "7.0000", str(T1)), ("B", "8.0000", str(T1)),
    ]
    assert rows(merge.upsert(once, batch, KEY, T1)) == rows(once)


def test_upsert_stamps_unchanged_rows_unless_told_not_to(bars):
    target, batch = bars(("A", 0, 5), ("A", 1, 6)), bars(("A", 0, 5), ("A", 1, 7))
    assert merge.upsert(target, batch, KEY, T1).filter(F.col("inserted_at") == T1).count() == 2
    changed = merge.upsert(target, batch, KEY, T1, only_if_changed=True)
    assert rows(changed, "close", "inserted_at") == [("5.0000", str(T0)), ("7.0000", str(T1))]


def test_latest_by_key_is_the_last_whatever_the_input_order(spark):
    data = [("A", i, float(i * 7 % 11)) for i in range(50)] + [("B", 1, 1.0)]
    want = [("A", "49", str(float(49 * 7 % 11))), ("B", "1", "1.0")]
    for seed in range(3):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "k string, seq int, v double").repartition(5)
        assert rows(merge.latest_by_key(df, ("k",), ("seq",))) == want


def test_upsert_columns_keeps_the_named_ones(spark):
    old = spark.createDataFrame([("t1", "old name", "pass")], "test_id string, test_name string, status string")
    new = spark.createDataFrame([("t1", "new name", "fail"), ("t2", "second", "pass")], old.schema)
    got = merge.upsert_columns(old, new, ("test_id",), ("test_name",))
    assert rows(got) == [("t1", "old name", "fail"), ("t2", "second", "pass")]


def test_newer_than_an_empty_table_is_everything(bars):
    source = bars(("A", 0, 5), ("A", 1, 6, T1))
    assert merge.newer_than(source, source.limit(0), "inserted_at").count() == 2
    assert merge.newer_than(source, bars(("A", 0, 5)), "inserted_at").count() == 1
    assert merge.newer_than(source, source, "inserted_at").count() == 0


def test_history_keeps_one_open_version_and_no_gaps(bars):
    h = history.first_snapshot(bars(("A", 0, 5), ("B", 0, 6), ("C", 0, 7)), KEY)
    h = history.snapshot(h, bars(("A", 0, 9, T1), ("B", 0, 6)), KEY)  # A changed, C vanished
    h = history.snapshot(h, bars(("A", 0, 10, T2), ("B", 0, 6), ("D", 0, 1, T2)), KEY)
    assert rows(h, "ticker", "close", "valid_from", "valid_to") == [
        ("A", "10.0000", str(T2), "None"), ("A", "5.0000", str(T0), str(T1)), ("A", "9.0000", str(T1), str(T2)),
        ("B", "6.0000", str(T0), "None"), ("C", "7.0000", str(T0), "None"), ("D", "1.0000", str(T2), "None"),
    ]
    assert h.select("scd_id").distinct().count() == 6
    open_rows = history.current(h)
    assert open_rows.count() == open_rows.select(*KEY).distinct().count() == 4
    again = history.snapshot(h, bars(("A", 0, 10, T2)), KEY)
    assert rows(again) == rows(h)


@pytest.mark.parametrize("seed", range(3))
def test_incremental_models_equal_a_full_rebuild(bars, seed):
    chance = random.Random(seed)
    old = {(t, d): chance.randint(50, 90) / 10 for t in ("A", "B", "C") for d in range(0, 300, chance.randint(1, 2))}
    batch = {(t, d): chance.randint(50, 90) / 10 for t in ("A", "D") for d in chance.sample(range(320), 4)}
    before = bars(*[(t, d, x) for (t, d), x in old.items()])
    fixes = bars(*[(t, d, x, T1) for (t, d), x in batch.items()])

    def enriched(raw):
        staged = models.stage_stock_bars(history.first_snapshot(raw, KEY))
        return models.enrich_stock_bars(staged, Series())

    after = merge.upsert(before, fixes, KEY, T1)
    staged = models.stage_stock_bars(history.first_snapshot(after, KEY))
    got = refresh.recompute_enriched(enriched(before), staged, fixes)
    assert rows(got) == rows(enriched(after))


def staged_bars(raw):
    return models.stage_stock_bars(history.first_snapshot(raw, KEY))


def option(spark, *rows):
    """Staged options: (symbol, ticker, day, strike)."""
    symbols = "option_symbol string, underlying_ticker string, trade_date date, expiration_date date, strike_price decimal(19,4)"
    one = F.lit("1").cast("decimal(19,4)")
    df = spark.createDataFrame([(n, t, date(2020, 1, 1) + timedelta(days=d), date(2021, 1, 1), Decimal(x)) for n, t, d, x in rows], symbols)
    prices = ("open_price", "high_price", "low_price", "close_price", "volume_weighted_average_price")
    return df.select(
        F.concat("option_symbol", F.lit("_"), "trade_date").alias("option_bar_id"), "*", F.lit("call").alias("option_type"),
        *[one.alias(c) for c in prices], F.lit(1).cast("bigint").alias("volume"), F.lit(1).cast("bigint").alias("transactions"),
        F.lit(T0).alias("loaded_at"),
    )


def month(m, year=2020):
    return date(year, m, 1)


def test_one_late_bar_reads_and_writes_the_periods_it_reaches(spark, bars, tmp_path):
    """Daily bars of two years: a bar of 9 June 2020 alters rows up to October and those
    read bars from February on; a ticker that is not in the batch is left alone."""
    to = refresh.Models(str(tmp_path))
    old = bars(*[("A", d, 50 + d * 7 % 13) for d in range(720)], *[("B", d, 3) for d in range(0, 720, 9)])
    contracts = [("OA", "A", 165, 9), ("OA", "A", 400, 9), ("OB", "B", 160, 9), ("OB", "B", 162, 9)]
    options = option(spark, *contracts)
    build(spark, history.first_snapshot(old, KEY), options, to)
    before = {name: versions.pinned(spark, to.path(name)).periods for name in refresh.TABLES}
    batch = bars(("A", 160, 99, T1))
    seen = refresh.update(spark, to, staged_bars(batch))
    assert seen.read["stg_stock_bars"] == {month(m) for m in range(2, 11)}
    assert seen.written["enriched_stock_bars"] == seen.written["fct_stock_performance"] == {month(m) for m in range(6, 11)}
    assert seen.written["stocks_options_joined"] == {date(2020, 6, 14)} and "enriched_option_bars" not in seen.written
    for name in refresh.TABLES:
        after = versions.pinned(spark, to.path(name)).periods
        changed = {date.fromisoformat(p) for p in after if after[p] != before[name].get(p)}
        assert changed == seen.written.get(name, set()), name
    inputs = versions.read(spark, to.path("stg_stock_bars"), periods=seen.read["stg_stock_bars"]).inputFiles()
    assert {f.split("period=")[1][:7] for f in inputs} == {f"2020-{m:02}" for m in range(2, 11)}
    same_as_rebuild(spark, to, merge.upsert(old, batch, KEY, T1), options, tmp_path)


def build(spark, stock_history, staged_options, to):
    """``refresh`` from staged options, as these tests have them."""
    original = models.stage_option_bars
    models.stage_option_bars = lambda rows: rows
    try:
        refresh.refresh(spark, stock_history, staged_options, to)
    finally:
        models.stage_option_bars = original


def same_as_rebuild(spark, to, raw, staged_options, tmp_path):
    anew = refresh.Models(str(tmp_path / "anew"), to.stock_grain, to.option_grain)
    build(spark, history.first_snapshot(raw, KEY), staged_options, anew)
    for name in refresh.TABLES:
        got, want = versions.read(spark, to.path(name)), versions.read(spark, anew.path(name))
        assert rows(got, *want.columns) == rows(want), name


def test_updates_by_random_batches_equal_a_rebuild(spark, bars, tmp_path):
    chance = random.Random(7)
    to = refresh.Models(str(tmp_path), "month", "month")
    stock = {(t, d): chance.randint(50, 90) / 10 for t in "ABC" for d in range(0, 500, chance.randint(1, 40))}
    contracts = {(f"O{t}", t, d): chance.randint(4, 9) for t in "ABZ" for d in chance.sample(range(500), 12)}
    build(spark, history.first_snapshot(bars(*[(*k, x) for k, x in stock.items()]), KEY), option(spark, *[(*k, x) for k, x in contracts.items()]), to)
    for _ in range(2):
        late = {(t, d): chance.randint(50, 90) / 10 for t in chance.sample("ABCD", 2) for d in chance.sample(range(520), 3)}
        more = {(f"O{t}", t, d): chance.randint(4, 9) for t in "AB" for d in chance.sample(range(500), 2)}
        refresh.update(spark, to, staged_bars(bars(*[(*k, x) for k, x in late.items()])), option(spark, *[(*k, x) for k, x in more.items()]))
        stock |= late
        contracts |= more
    same_as_rebuild(spark, to, bars(*[(*k, x) for k, x in stock.items()]), option(spark, *[(*k, x) for k, x in contracts.items()]), tmp_path)


def shuffle_files(spark):
    """Names of the shuffle files that the session has on its disk."""
    kept = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    names = set()
    while kept.hasNext():
        names.add(kept.next().getName())
    return {n for n in names if n.startswith("shuffle_")}


def test_a_written_table_leaves_no_shuffled_rows_on_disk(spark, tmp_path):
    before = shuffle_files(spark)
    many = spark.range(1000).withColumn("trade_date", F.expr("date_add(date'2020-01-01', int(id % 400))"))
    summed = many.groupBy("trade_date").agg(F.sum("id").alias("x"))
    versions.commit(summed, str(tmp_path / "days"), "month")
    tables.rebuild(summed, str(tmp_path / "plain"))
    ends = time.time() + 20  # removal goes by messages
    while (left := shuffle_files(spark) - before) and time.time() < ends:
        time.sleep(0.2)
    assert not left
    assert versions.read(spark, str(tmp_path / "days")).count() == 400 == spark.read.parquet(str(tmp_path / "plain")).count()
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"


def exchanged(df):
    """How often the rows that a plan returns, not those joined to them, are shuffled; by adaptive execution's first plan."""
    return re.findall(r"(?:Exchange|SortMergeJoin)", re.sub(r"BroadcastExchange.*", "", df._jdf.queryExecution().executedPlan().toString(), flags=re.S))


@pytest.mark.parametrize("most", [100_000, 1])
def test_options_meet_the_bars_of_their_days_where_they_are(spark, bars, tmp_path, monkeypatch, most):
    """As long as these are few, however many bars other tickers have; the rows are those of the plain join."""
    monkeypatch.setattr(refresh, "MOST_DAYS", most)
    stocks = models.enrich_stock_bars(staged_bars(bars(*[(t, d, 5 + d) for t in ("A", "B", "Z") for d in range(40)])), Series())
    options = models.enrich_option_bars(option(spark, *[("OA", "A", 3, 9), ("OA", "A", 5, 9), ("OB", "B", 5, 4), ("OB", "B", 90, 4), ("OC", "C", 5, 4)]))
    for name, rows_of in (("stocks", stocks), ("options", options)):
        versions.commit(rows_of, str(tmp_path / name), "month")
    options, stocks = (versions.read(spark, str(tmp_path / name)) for name in ("options", "stocks"))
    plainly = rows(models.join_options_to_stocks(options, stocks))
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name in names:
            spark.conf.set(name, "-1")  # as if all tables were large
        with refresh.beside(options, stocks) as (joined, laid):
            assert laid == (most > 1) and bool(exchanged(joined)) == (most == 1)
            assert rows(joined) == plainly and len(plainly) == 5
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.mark.parametrize("grain, laid", [("year", False), ("month", True), ("month", False)])
def test_rows_are_dealt_by_period_only_where_that_saves_files(spark, tmp_path, monkeypatch, grain, laid):
    path, plans = str(tmp_path / "bars"), []
    days = spark.range(900).select(F.expr("date_add(date'2020-01-01', int(id))").alias("trade_date"), "id")
    versions.commit(days, str(tmp_path / "source"), grain)
    writer = type(days.write)

    def parquet(self, *given, real=writer.parquet, **more):
        plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return real(self, *given, **more)

    monkeypatch.setattr(writer, "parquet", parquet)
    versions.commit(versions.read(spark, str(tmp_path / "source")), path, grain, laid=laid)
    assert ("Exchange" in plans[0]) == (grain == "month" and not laid)
    assert rows(versions.read(spark, path)) == rows(days)
    assert set(periods_of(spark, path)) == {str(r[0]) for r in days.select(versions.period(grain)).distinct().collect()}


def test_new_periods_are_merged_without_a_shuffle(spark, bars, tmp_path):
    """Nothing is stored of them, so no bar can be replaced."""
    path = str(tmp_path / "bars")
    versions.commit(bars(("A", 0, 5)), path, "year")
    merged = merge.replace_by_key(versions.read(spark, path, periods={date(2021, 1, 1)}), bars(("A", 400, 6)), KEY)
    assert "Exchange" not in merged._jdf.queryExecution().executedPlan().toString()
    assert rows(merged, "ticker", "close") == [("A", "6.0000")]


def periods_of(spark, path):
    return versions.pinned(spark, str(path)).periods


def test_history_tables_touch_only_the_given_periods(spark, bars, tmp_path):
    raw, kept = str(tmp_path / "raw"), tmp_path / "history"
    first = bars(("A", 0, 5), ("A", 40, 6)).drop("inserted_at")
    touched = tables.upsert_table(spark, raw, schemas.STOCK_BARS, first, KEY, T0)
    tables.snapshot_table(spark, str(kept), schemas.STOCK_BARS, raw, KEY, touched)
    old = periods_of(spark, kept)
    touched = tables.upsert_table(spark, raw, schemas.STOCK_BARS, bars(("A", 40, 9)), KEY, T1)
    for _ in range(2):
        tables.snapshot_table(spark, str(kept), schemas.STOCK_BARS, raw, KEY, touched)
    history_rows = versions.read(spark, str(kept), tables.history_schema(schemas.STOCK_BARS))
    assert rows(history_rows, "close", "valid_from", "valid_to") == [
        ("5.0000", str(T0), "None"), ("6.0000", str(T0), str(T1)), ("9.0000", str(T1), "None"),
    ]
    new = periods_of(spark, kept)
    assert new["2020-01-01"] == old["2020-01-01"] and new["2020-02-01"] != old["2020-02-01"]


BEFORE = [("A", "5.0000", str(T0)), ("A", "6.0000", str(T0)), ("B", "7.0000", str(T0))]
AFTER = [("A", "5.0000", str(T0)), ("A", "9.0000", str(T1)), ("B", "7.0000", str(T0)), ("C", "1.0000", str(T1))]


def loaded(spark, bars, path):
    first = bars(("A", 0, 5), ("A", 40, 6), ("B", 40, 7)).drop("inserted_at")
    tables.upsert_table(spark, path, schemas.STOCK_BARS, first, KEY, T0)
    return bars(("A", 40, 9), ("C", 41, 1)).drop("inserted_at")


def shown(spark, path, version=None):
    return rows(versions.read(spark, path, schemas.STOCK_BARS, version=version), "ticker", "close", "inserted_at")


def test_upserts_rewrite_only_touched_periods(spark, bars, tmp_path):
    path = str(tmp_path / "bars")
    batch = loaded(spark, bars, path)
    untouched = periods_of(spark, path)["2020-01-01"]
    pinned = versions.read(spark, path, schemas.STOCK_BARS)
    for _ in range(2):  # a rerun of the batch changes nothing
        tables.upsert_table(spark, path, schemas.STOCK_BARS, batch, KEY, T1)
        assert shown(spark, path) == AFTER
    assert periods_of(spark, path)["2020-01-01"] == untouched
    assert rows(pinned, "ticker", "close", "inserted_at") == BEFORE == shown(spark, path, 1)  # a reader keeps its version
    # Each row was written once: 3 of the first commit, 3 of each other's one period.
    assert spark.read.parquet(f"{path}/data").count() == 3 + 3 + 3


@pytest.mark.parametrize("when", ["before", "after"])
@pytest.mark.parametrize("step", ["write", "names_in", "publish", "draft"])
def test_a_stop_at_any_step_of_a_commit_hides_and_loses_nothing(spark, bars, tmp_path, monkeypatch, step, when):
    path = str(tmp_path / "bars")
    batch = loaded(spark, bars, path)
    with monkeypatch.context() as patch:
        if step == "draft":  # the list is written in part, or whole, and not yet renamed
            def stop(spark, path, version):
                (tmp_path / "bars/versions/.draft-x").write_text("{" if when == "before" else "{}")
                raise RuntimeError("lost")

            patch.setattr(versions, "publish", stop)
        else:
            real, calls = getattr(versions, step), []

            def stop(*given):
                calls.append(given)
                if step == "names_in" and not str(given[1]).startswith(f"{path}/data"):
                    return real(*given)
                if when == "after":
                    real(*given)
                raise RuntimeError("lost")

            patch.setattr(versions, step, stop)
        with pytest.raises(RuntimeError, match="lost"):
            tables.upsert_table(spark, path, schemas.STOCK_BARS, batch, KEY, T1)
    spark.catalog.clearCache()
    assert shown(spark, path) == (AFTER if (step, when) == ("publish", "after") else BEFORE)
    tables.upsert_table(spark, path, schemas.STOCK_BARS, batch, KEY, T1)
    assert shown(spark, path) == AFTER
    versions.vacuum(spark, path, keep=1)
    assert shown(spark, path) == AFTER and not list((tmp_path / "bars/versions").glob(".draft-*"))
    assert spark.read.parquet(f"{path}/data").count() == len(AFTER)


@pytest.mark.parametrize("stop_at", range(6))
def test_a_stop_at_any_deletion_hides_and_loses_nothing(spark, bars, tmp_path, monkeypatch, stop_at):
    path = str(tmp_path / "bars")
    batch = loaded(spark, bars, path)
    for at in (T1, T1, T1):
        tables.upsert_table(spark, path, schemas.STOCK_BARS, batch, KEY, at)
    real, calls = versions.delete, []

    def stop(spark, place):
        calls.append(place)
        if len(calls) > stop_at:
            if place.endswith(".json") is False:  # half of a folder is gone
                next(iter(sorted((tmp_path / "bars").glob("data/" + place.split("/data/")[1] + "/**/*.parquet")))).unlink()
            raise RuntimeError("lost")
        real(spark, place)

    with monkeypatch.context() as patch:
        patch.setattr(versions, "delete", stop)
        try:
            versions.vacuum(spark, path, keep=1)
        except RuntimeError:
            pass
    assert shown(spark, path) == AFTER
    versions.vacuum(spark, path, keep=1)
    assert shown(spark, path) == AFTER and versions.version_numbers(spark, path) == [4]


def test_two_writers_of_one_version_are_told_apart(spark, bars, tmp_path):
    path = str(tmp_path / "bars")
    loaded(spark, bars, path)
    with pytest.raises(RuntimeError, match="one writer"):
        versions.publish(spark, path, versions.pinned(spark, path))


def test_stored_numbers_round_as_typed_columns_do(spark):
    df = spark.createDataFrame([(2.5, 1.00005), (-2.5, 2.0), (2.4, None)], "volume double, close double")
    got = schemas.conform(df, schemas.STOCK_BARS).orderBy("volume").collect()
    assert [r.volume for r in got] == [-3, 2, 3]


def test_unmatched_options_are_kept_out_of_the_money(spark):
    option = "option_bar_id string, option_symbol string, underlying_ticker string, trade_date date, expiration_date date, strike_price decimal(19,4), option_type string, open_price decimal(19,4), high_price decimal(19,4), low_price decimal(19,4), close_price decimal(19,4), volume bigint, volume_weighted_average_price decimal(19,4), transactions bigint, loaded_at timestamp, days_to_expiration int"
    day, one = date(2020, 1, 1), Decimal("1")

    def contract(name, ticker, strike, kind):
        return (name, name, ticker, day, day, Decimal(strike), kind, one, one, one, one, 1, one, 1, T0, 0)

    options = spark.createDataFrame(
        [contract("itm", "A", "4", "call"), contract("atm", "A", "5", "put"), contract("otm", "A", "4", "put"),
         contract("put", "A", "6", "put"), contract("lost", "Z", "1", "call"), contract("null", None, "1", "call")], option
    )
    stocks = spark.createDataFrame(
        [("A", day, Decimal("5.00"), one, one, one)],
        "ticker string, trade_date date, close_price decimal(19,4), moving_avg_20d decimal(19,4), moving_avg_50d decimal(19,4), moving_avg_120d decimal(19,4)",
    )
    joined = models.join_options_to_stocks(options, stocks)
    assert dict(joined.select("option_bar_id", "moneyness").collect()) == {
        "itm": "in-the-money", "atm": "at-the-money", "otm": "out-of-the-money", "put": "in-the-money",
        "lost": "out-of-the-money", "null": "out-of-the-money",
    }


def test_manifests_and_seeds(spark, tmp_path):
    paths = spark.createDataFrame([("raw_data/A_1.json",), ("raw_data/A_1.json",), ("raw_data/B_1.json",)], "path string")
    tables.write_manifest(paths, str(tmp_path / "manifest"))
    assert tables.read_manifest(spark, str(tmp_path / "manifest")).count() == 2
    (tmp_path / "blank").write_text("\n raw_data/C_1.json \n\n")
    assert rows(tables.read_manifest(spark, str(tmp_path / "blank"))) == [("raw_data/C_1.json",)]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tables.read_manifest(spark, str(tmp_path / "missing")).count()
    (tmp_path / "seed.csv").write_text('ticker,company_name,sector\nA,"Apple, Inc",Tech\n')
    assert rows(tables.read_seed(spark, str(tmp_path / "seed.csv"))) == [("A", "Apple, Inc", "Tech")]


def test_manifest_reads_the_listed_files_alone(spark, tmp_path):
    names = ["C D_1.json", "A%_1.json", "B+x_1.json", "E_1.json"]
    for day in ("d1", "d2"):
        (tmp_path / day).mkdir()
        for name in names:
            (tmp_path / day / name).write_text(f"{day} {name}")
    # Neither can be read, and neither is listed: a link to nothing and a folder without rights.
    (tmp_path / "d1/broken.json").symlink_to(tmp_path / "nowhere")
    (tmp_path / "d1/locked").mkdir(mode=0)
    lines = ["d1/C D_1.json", "d1/C D_1.json", f"{tmp_path}/d1/A%_1.json", f"file://{tmp_path}/d1/B+x_1.json", "d1/gone.json", "d9/gone.json"]
    manifest = spark.createDataFrame([(x,) for x in lines], "path string")
    docs, missing = listed.listed_documents(spark, manifest, str(tmp_path))
    got = docs.withColumn("key", file_key(F.col("path"))).select("doc", "key")
    assert sorted(rows(got)) == [("d1 A%_1.json", "A%"), ("d1 B+x_1.json", "B+x"), ("d1 C D_1.json", "C D")]
    assert sorted(rows(missing)) == [("d1/gone.json",), ("d9/gone.json",)]


@pytest.mark.parametrize("size", [1, 7, 64, 1 << 20])
def test_lines_have_their_places_whatever_the_ranges(spark, tmp_path, size):
    texts = {"a": b"one\ntwo\r\n\n\xc3\xa9 three\nlast", "b": b"", "c": b"\n", "d": b"x" * 300 + b"\n" + b"y" * 5 + b"\n"}
    want = []
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text)
        at = 0
        for line in text.split(b"\n")[: None if text and not text.endswith(b"\n") else -1]:
            want.append((name, at, line.removesuffix(b"\r").decode()))
            at += len(line) + 1
    manifest = spark.createDataFrame([(name,) for name in texts], "path string")
    docs, _ = listed.listed_documents(spark, manifest, str(tmp_path), one_per_file=False, range_bytes=size)
    got = [(r.path.rsplit("/", 1)[1], r["at"][0], r.doc) for r in docs.collect()]
    assert sorted(got) == sorted(want)


def test_option_bars_are_added_up_by_hashing(spark, tmp_path):
    """Bars against a count by hand, with lines and orders that come twice, ties, missing prices and
    keys; no sort by all that places a line once lines have met their order."""
    import io
    import random
    from contextlib import redirect_stdout
    from datetime import datetime

    from barline import fixtures as fx

    rng = random.Random(8)
    day = lambda n: datetime(1996, 1, 1 + n)
    orders = [(k, k % 3, 10000.0 * (k % 2), day(k % 2)) for k in range(1, 30)] + [(None, 1, 5.0, day(0))]
    orders += orders[4:6]
    lines = [
        (rng.choice([*range(1, 32), None]), rng.choice([1, 2, None]), rng.randint(1, 2), rng.choice([1, None]),
         float(rng.randint(1, 9)), rng.choice([None, 1000.0 * rng.randint(1, 50)]), rng.choice("OF"), day(rng.randint(0, 2)))
        for _ in range(400)
    ]
    lines += lines[:40]
    tables = {
        "customer": ([(0, "A"), (1, "A"), (2, "B")], "c_custkey long, c_mktsegment string"),
        "orders": (orders, "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp"),
        "lineitem": (lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double,"
                            " l_extendedprice double, l_linestatus string, l_shipdate timestamp"),
    }
    for name, (rows, fields) in tables.items():
        spark.createDataFrame(rows, fields).repartition(3).write.parquet(f"{tmp_path}/{name}.parquet")
    segment, groups = dict(tables["customer"][0]), {}
    for o, customer, total, ordered in orders:
        for k, n, part, supplier, quantity, price, status, shipped in lines:
            if k is not None and k == o:
                at = (segment[customer], shipped.date(), ordered.date(), int(total // 10000), "call" if status == "O" else "put")
                first = tuple((x is not None, x or 0) for x in (k, n, part, supplier, price))
                groups.setdefault(at, []).append((first, price, int(quantity)))
    want = {}
    for at, rows in groups.items():
        prices, in_order = [p for _, p, _ in rows if p is not None], sorted(rows, key=lambda r: r[0])
        units = lambda p: None if p is None else p / 10000
        want[at] = (
            units(in_order[0][1]), units(max(prices, default=None)), units(min(prices, default=None)),
            units(in_order[-1][1]), sum(q for *_, q in rows), len(rows),
        )
    bars = fx._option_bars(spark, str(tmp_path))
    got = {
        (r.underlying_ticker, r.trade_date, r.expiration_date, int(r.strike_price), r.option_type):
        (*(None if x is None else float(x) for x in (r.open, r.high, r.low, r.close)), r.volume, r.transactions)
        for r in bars.collect()
    }
    assert got == want
    with redirect_stdout(io.StringIO()) as plan:
        bars.explain()
    assert "HashAggregate(keys=[underlying_ticker" in plan.getvalue()
    assert "SortAggregate(key=[underlying_ticker" not in plan.getvalue()


def test_queries_bound_what_is_dealt_to_a_task(spark):
    from barline.queries.registry import REGISTRY

    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "64m")
        REGISTRY["epoch_date"].run(spark, "/root/testdata/sf0.001")
        assert spark.conf.get(name) == "16m"
    finally:
        spark.conf.set(name, before)
