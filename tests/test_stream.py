"""Stream loads: new files only, quarantine, corrections, option feeds."""

import json
from datetime import datetime, timedelta

import pytest

from barline import schemas
from barline.sources.tables import history_schema
from barline.sources.versions import read
from barline.streaming import loads

TIME = 1704205800000


def clock(batch_id):
    return datetime(2024, 1, 1) + timedelta(days=batch_id)


def drop(folder, name, ticker, close, **changes):
    bar = {"v": 1, "vw": 1, "o": 1, "c": close, "h": 9, "l": 1, "t": TIME, "n": 1}
    folder.mkdir(exist_ok=True)
    doc = {"ticker": ticker, "resultsCount": 1, "results": [bar]} | changes
    (folder / name).write_text(json.dumps(doc, indent=2))


def run(spark, tmp_path, feed="stock_bars", **options):
    query = loads.start_load(
        spark, str(tmp_path / "raw"), loads.FEEDS[feed], str(tmp_path / "table"), str(tmp_path / "checkpoint"),
        clock, quarantine=str(tmp_path / "quarantine"), **options,
    )
    query.awaitTermination()
    return read(spark, str(tmp_path / "table"), loads.FEEDS[feed].schema)


def test_corrections_overwrite_and_reach_the_history(spark, tmp_path):
    raw, kept = tmp_path / "raw", str(tmp_path / "history")
    drop(raw, "A_1.json", "A", 5)
    drop(raw, "B_1.json", "B", 6)
    drop(raw, "C_1.json", "C", 7, resultsCount=0)
    table = run(spark, tmp_path, history=kept)
    assert sorted((r.ticker, float(r.close)) for r in table.collect()) == [("A", 5.0), ("B", 6.0)]
    refused = spark.read.parquet(str(tmp_path / "quarantine"))
    assert [r.reject_reason for r in refused.collect()] == ["no single result"]

    drop(raw, "A_2.json", "A", 8)
    table = run(spark, tmp_path, history=kept)
    got = {r.ticker: (float(r.close), r.inserted_at) for r in table.collect()}
    assert got == {"A": (8.0, clock(1)), "B": (6.0, clock(0))}
    history = read(spark, kept, history_schema(schemas.STOCK_BARS))
    versions = sorted((r.ticker, float(r.close), r.valid_from, r.valid_to) for r in history.collect())
    assert versions == [
        ("A", 5.0, clock(0), clock(1)), ("A", 8.0, clock(1), None), ("B", 6.0, clock(0), None),
    ]
    assert run(spark, tmp_path, history=kept).count() == 2  # nothing new: nothing happens


def test_the_last_file_of_a_key_wins_within_a_batch(spark, tmp_path):
    for i, close in enumerate([3, 1, 2]):
        drop(tmp_path / "raw", f"A_{i}.json", "A", close)
    assert [float(r.close) for r in run(spark, tmp_path).collect()] == [2.0]


def test_option_feed(spark, tmp_path):
    drop(tmp_path / "raw", "x.json", "O:SPY251219C00150000", 5)
    drop(tmp_path / "raw", "y.json", "no symbol", 5)
    row = run(spark, tmp_path, "option_bars").first()
    assert (row.option_symbol, row.underlying_ticker, float(row.strike_price)) == ("O:SPY251219C00150000", "SPY", 150.0)


def test_small_batches_and_archive(spark, tmp_path):
    for name in "ABC":
        drop(tmp_path / "raw", f"{name}_1.json", name, 5)
    archive = tmp_path / "processed"
    table = run(spark, tmp_path, files_per_batch=1, archive=str(archive))
    assert table.count() == 3
    assert len(list(archive.rglob("*.json"))) == 2 and len(list((tmp_path / "raw").glob("*.json"))) == 1


def lines(path, closes):
    bar = {"v": 1, "vw": 1, "o": 1, "h": 9, "l": 1, "t": TIME, "n": 1}
    path.parent.mkdir(exist_ok=True)
    path.write_text("".join(json.dumps({"ticker": "A", "resultsCount": n, "results": [bar | {"c": c}]}) + "\n" for c, n in closes))


@pytest.mark.parametrize("split", ["200", "1000", "128m"])
def test_a_later_line_wins_whatever_its_value_and_the_splits(spark, tmp_path, split):
    lines(tmp_path / "raw/a.json", [(9, 1), (3, 1), (8, 2), (7, 1), (1, 1), (5, 1), (2, 1)] + [(6, 2)] * 9)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        table = run(spark, tmp_path, one_per_file=False)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [float(r.close) for r in table.collect()] == [2.0]


def test_a_batch_is_scanned_once_for_the_table_and_the_quarantine(spark, tmp_path):
    lines(tmp_path / "raw/a.json", [(9, 1), (8, 2), (7, 1)])
    query = loads.start_load(
        spark, str(tmp_path / "raw"), loads.FEEDS["stock_bars"], str(tmp_path / "table"), str(tmp_path / "checkpoint"),
        clock, quarantine=str(tmp_path / "quarantine"), history=str(tmp_path / "history"), one_per_file=False,
    )
    query.awaitTermination()
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [3]
    assert spark.read.parquet(str(tmp_path / "quarantine")).count() == 1
    assert not list((tmp_path / "table.parsed").glob("batch=*"))
