"""Documents read from files, good, odd and broken."""

import json
from datetime import date

import pytest

from barline.functions import symbols
from barline.sources import documents as docs
from barline.sources import versions
from pyspark.sql import functions as F

BAR = {"v": 10.5, "vw": 1.23456, "o": 1, "c": 2, "h": 3, "l": 0.5, "t": 1704205800000, "n": 7}


def envelope(**changes):
    doc = {"ticker": "A", "queryCount": 1, "resultsCount": 1, "adjusted": True, "results": [BAR], "status": "OK"}
    return {k: v for k, v in (doc | changes).items() if v != "drop"}


@pytest.fixture
def folder(spark, tmp_path):
    def write(files):
        for name, content in files.items():
            (tmp_path / name).write_text(content if isinstance(content, str) else json.dumps(content))
        return docs.read_documents(spark, str(tmp_path))

    return write


def reasons(rows):
    return {r.path.split("/")[-1]: r.reject_reason for r in rows.collect()}


def test_stock_documents(folder):
    read = folder({
        "good.json": envelope(), "pretty.json": json.dumps(envelope(), indent=2),
        "two.json": envelope(results=[BAR, BAR | {"c": 99}]), "cut.json": json.dumps(envelope())[:-9],
        "none.json": envelope(results=[]), "zero.json": envelope(resultsCount=0), "many.json": envelope(resultsCount=2),
        "timeless.json": envelope(results=[{k: v for k, v in BAR.items() if k != "t"}]),
        "nameless.json": envelope(ticker="drop"), "sparse.json": envelope(results=[{"t": BAR["t"]}]), "text.json": "hello",
        "huge.json": envelope(results=[BAR | {"h": 1e15}]),
    })
    rows = docs.stock_bars(read)
    assert reasons(rows) == {
        "good.json": None, "pretty.json": None, "two.json": None, "sparse.json": None,
        "cut.json": "malformed json", "text.json": "malformed json", "none.json": "no single result",
        "zero.json": "no single result", "many.json": "no single result", "timeless.json": "no time", "nameless.json": "no ticker", "huge.json": "number out of range",
    }
    good = docs.accepted(rows).filter("path like '%two.json'").first()
    assert (good.ticker, good.trade_date, good.close, good.volume) == ("A", date(2024, 1, 2), 2.0, 10.5)
    assert docs.loaded_paths(rows).count() == 4 and docs.rejected(rows).count() == 8


def test_option_documents(folder):
    def option(ticker, **changes):
        return envelope(ticker=ticker, **changes)

    rows = docs.option_bars(folder({
        "good.json": option("O:SPY251219C00150500"), "dot.json": option("O:BRK.B251219P00150000"),
        "suffix.json": option("SPY251219C00150000X"), "word.json": option("SPY"), "digit.json": option("O:SPY1251219C00150000"),
        "month.json": option("O:SPY259919C00150000"), "none.json": option("drop"), "empty.json": option("O:SPY251219C00150000", results=[]),
    }))
    assert reasons(rows) == {
        "good.json": None, "dot.json": None, "suffix.json": None, "word.json": "unreadable symbol", "digit.json": "unreadable symbol",
        "month.json": "impossible expiry", "none.json": "no ticker", "empty.json": "no single result",
    }
    good = rows.filter("path like '%good.json'").first()
    assert (good.underlying_ticker, good.expiration_date, good.option_type, float(good.strike_price)) == (
        "SPY", date(2025, 12, 19), "call", 150.5,
    )


DAY = {"date": "2024-01-02", "open": 1, "high": 2, "low": 0.5, "close": 1.5, "volume": 10}


def test_history_documents(folder):
    read = folder({
        "A_1.json": {"history": {"day": DAY}}, "B_1.json": {"history": {"day": [DAY, DAY | {"date": "2024-01-03", "vwap": 1.1}]}},
        "C_1.json": {"history": None}, "D_1.json": {"history": {"day": None}}, "E_1.json": {"history": {"day": []}},
        "F_1.json": {}, "G_1.json": '{"history": {"day"', "H_1.json": {"history": {"day": [DAY | {"date": "soon"}]}},
        "I_1.json": {"history": {"day": DAY | {"volume": 1e19}}},
    })
    rows = docs.history_bars(read)
    assert sorted((r.ticker, str(r.trade_date), r.vwap) for r in docs.accepted(rows).collect()) == [
        ("A", "2024-01-02", None), ("B", "2024-01-02", None), ("B", "2024-01-03", 1.1),
    ]
    assert reasons(docs.rejected(rows)) == {
        "C_1.json": "no history", "D_1.json": "no history", "E_1.json": "no history", "F_1.json": "no history",
        "G_1.json": "malformed json", "H_1.json": "no trade date", "I_1.json": "number out of range",
    }


def test_option_histories_take_the_contract_from_the_file_name(folder):
    rows = docs.option_history_bars(folder({
        "SPY251219C00150000_1.json": {"history": {"day": DAY}}, "BRK.B251219C00150000_1.json": {"history": {"day": DAY}},
    }))
    assert reasons(rows) == {"SPY251219C00150000_1.json": None, "BRK.B251219C00150000_1.json": "unreadable symbol"}


def frame(spark, schema, *rows):
    return spark.createDataFrame([tuple(json.dumps(c) if isinstance(c, dict) else c for c in r) for r in rows], schema)


def test_grouped_documents_fan_out_to_listed_tickers(spark):
    read = frame(
        spark, "path string, doc string",
        ("1", {"resultsCount": 2, "request_id": "r1", "results": [BAR | {"T": "A"}, BAR | {"T": "B"}]}),
        ("2", {"resultsCount": 0, "results": [BAR | {"T": "A"}]}), ("3", {"resultsCount": 0}),
    )
    allowed = frame(spark, "ticker string", ("A",), ("Z",))
    landed = docs.landing(docs.grouped_bars(read, allowed)).collect()
    assert [r.key for r in landed] == ["raw_data/A_2024-01-02.json"]
    doc = json.loads(landed[0].doc)
    assert doc["ticker"] == "A" and doc["resultsCount"] == 1 and doc["request_id"] == "r1"
    assert doc["results"][0]["c"] == 2 and doc["results"][0]["t"] == BAR["t"]
    back = docs.accepted(docs.stock_bars(frame(spark, "path string, doc string", ("x", landed[0].doc)))).first()
    assert (back.ticker, back.vwap) == ("A", 1.23456)


def test_landing_replaces_documents_by_symbol_and_date(spark, tmp_path):
    path = str(tmp_path / "landing")

    def landed(*bars):
        rows = frame(spark, "path string, doc string", ("1", {"resultsCount": len(bars), "results": [BAR | b for b in bars]}))
        return docs.landing(docs.grouped_bars(rows, frame(spark, "ticker string", ("A",), ("B",))))

    later = {"T": "A", "t": BAR["t"] + 86_400_000}
    docs.land(landed({"T": "A"}, {"T": "B"}, later), path)
    before = versions.pinned(spark, path).periods
    for _ in range(2):  # one symbol of one date comes again, and again
        docs.land(landed({"T": "A", "c": 7}), path)
    found = docs.accepted(docs.stock_bars(docs.landed(spark, path)))
    assert sorted((r.ticker, str(r.trade_date), r.close) for r in found.collect()) == [
        ("A", "2024-01-02", 7.0), ("A", "2024-01-03", 2.0), ("B", "2024-01-02", 2.0),
    ]
    after = versions.pinned(spark, path).periods
    assert after["2024-01-03"] == before["2024-01-03"] and after["2024-01-02"] != before["2024-01-02"]
    assert len(docs.landed(spark, path).inputFiles()) == 2  # a file a date, not one a document


def test_ranges_and_pages(spark):
    read = frame(spark, "path string, doc string", ("1", {"ticker": "O:X", "resultsCount": 2, "results": [BAR, BAR | {"t": BAR["t"] + 86400000}]}))
    assert [str(r.trade_date) for r in docs.range_bars(read).orderBy("trade_date").collect()] == ["2024-01-02", "2024-01-03"]
    pages = frame(spark, "doc string", ({"results": [{"ticker": "a"}, {"ticker": "b"}], "next_url": "u"},), ({"results": []},), ({},))
    assert sorted(r[0] for r in docs.contract_symbols(pages).collect()) == ["a", "b"]


def test_chains_of_one_many_and_none(spark):
    dates = frame(
        spark, "underlying string, doc string", ("A", {"expirations": {"date": "2024-01-05"}}),
        ("B", {"expirations": {"date": ["2024-01-05", "2024-01-12"]}}), ("C", {"expirations": None}), ("D", {}),
    )
    chains = frame(
        spark, "underlying string, expiration string, doc string", ("A", "2024-01-05", {"options": {"option": {"symbol": "A1"}}}),
        ("B", "2024-01-05", {"options": {"option": [{"symbol": "B1"}, {"symbol": "B2"}]}}), ("B", "2024-01-12", {"options": None}),
        ("B", "2024-01-19", {"options": {"option": {"symbol": "unlisted"}}}), ("C", "2024-01-05", {"options": {"option": {"symbol": "C1"}}}),
    )
    assert sorted(r.option_symbol for r in docs.chain_symbols(dates, chains).collect()) == ["A1", "B1", "B2"]


def test_tickers_are_valid_on_an_exact_match_only(spark):
    def reply(*names):
        found = [{"symbol": n} for n in names]
        return {"securities": {"security": found[0] if len(found) == 1 else found}}

    lookups = frame(
        spark, "ticker string, doc string", ("A", reply("A")), ("B", reply("BB", "B")), ("C", reply("CC")),
        ("D", {"securities": None}), ("E", reply("E.X", "EE")),
    )
    assert sorted(r[0] for r in docs.valid_tickers(lookups).collect()) == ["A", "B"]


def test_run_documents(spark):
    run = {
        "metadata": {"generated_at": "2024-01-02T03:04:05Z"},
        "results": [
            {"unique_id": "test.p.not_null_a", "status": "pass", "execution_time": 0.5},
            {"unique_id": "test.p.unique_a", "status": "fail", "failures": 3, "execution_time": 0.1},
            {"unique_id": "model.p.m", "status": "success", "execution_time": 1.0},
        ],
    }
    got = docs.run_results(frame(spark, "doc string", (run,))).orderBy("test_id").collect()
    assert [(r.test_name, r.failures) for r in got] == [("not_null_a", 0), ("unique_a", 3)]
    assert str(got[0].run_generated_at) == "2024-01-02 03:04:05"


def test_two_digit_years(spark):
    days = spark.createDataFrame([("251219",), ("681231",), ("690101",), ("240230",), ("",)], "s string")
    got = [r[0] for r in days.select(symbols.expiry(F.col("s"))).collect()]
    assert got == [date(2025, 12, 19), date(2068, 12, 31), date(1969, 1, 1), None, None]


@pytest.mark.parametrize("t", [1e16, 1e17, 1e20, -1e16])
def test_an_impossible_time_refuses_its_document_only(folder, t):
    rows = docs.stock_bars(folder({"A_1.json": envelope(), "B_1.json": envelope(results=[BAR | {"t": t}])}))
    assert sorted(str(r[docs.REASON]) for r in rows.collect()) == ["None", "time out of range"]


def test_counts_written_with_a_point_and_of_full_width(folder):
    wide = envelope(resultsCount=1.0, results=[BAR | {"v": 9.2233e18}])
    rows = docs.stock_bars(folder({"A_1.json": wide, "B_1.json": envelope(results=[BAR | {"v": 1e19}])}))
    assert sorted(str(r[docs.REASON]) for r in rows.collect()) == ["None", "number out of range"]
