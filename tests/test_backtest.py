"""Portfolio paths and metrics against pandas, and on degenerate paths."""

import numpy as np
import pandas as pd
import pytest

from barline.operators.series import Series
from barline.plans import backtest, strategies as st
from test_indicators import SERIES, expected_signal

KEYS = ("ticker", "strategy", "params")


def expected_path(x, signal):
    change = signal.diff().fillna(0)
    path = pd.DataFrame({"holdings": 100 * signal * x, "cash": 10000 - (100 * change * x).cumsum()})
    path["total"] = path["cash"] + path["holdings"]
    path["returns"] = path["total"].pct_change()
    path["drawdown"] = (path["total"] - path["total"].cummax()) / path["total"].cummax()
    return path


def expected_metrics(path, signal):
    r = path["returns"].dropna()

    def ratio(std):
        return r.mean() / std * np.sqrt(252) if std > 0 else 0.0

    gain, loss = r[r > 0].sum(), abs(r[r < 0].sum())
    return {
        "total_return": (path["total"].iloc[-1] / path["total"].iloc[0] - 1) * 100,
        "sharpe_ratio": ratio(r.std()),
        "num_trades": int(signal.diff().abs().sum() / 2),
        "max_drawdown": path["drawdown"].min() * 100,
        "sortino_ratio": ratio(r[r < 0].std()),
        "profit_factor": gain / loss if loss > 0 else float("inf"),
    }


@pytest.mark.parametrize("series", [Series(), Series(months=2)], ids=["plain", "split"])
def test_paths_and_metrics_match_pandas(prices, series):
    paths = backtest.paths(prices(SERIES), series)
    found = {k: g.sort_values("trade_date") for k, g in paths.toPandas().groupby(["ticker", "strategy"])}
    report = backtest.metrics(paths, KEYS).toPandas().set_index(["ticker", "strategy"])
    for strategy in st.DEFAULTS:
        for ticker, values in SERIES.items():
            x = pd.Series(values)
            signal = expected_signal(x, strategy)
            want, got = expected_path(x, signal), found[(ticker, strategy.name)]
            for column in want:
                assert np.allclose(got[column].astype(float), want[column], equal_nan=True, atol=1e-9), (ticker, column)
            for name, value in expected_metrics(want, signal).items():
                assert report.loc[(ticker, strategy.name), name] == pytest.approx(value, abs=1e-9), (ticker, name)


def test_cash_and_holdings_make_the_total(prices):
    paths = backtest.paths(prices(SERIES), Series())
    assert paths.filter("cash + holdings <> total").count() == 0


def by_hand(spark, prices, values, signal):
    bars = prices({"X": values}).toPandas()
    bars["signal"], bars["positions"] = signal, pd.Series(signal).diff()
    bars["strategy"], bars["params"] = "hand", ""
    rows = [
        (b.ticker, b.trade_date, b.close_price, int(b.signal), None if pd.isna(b.positions) else int(b.positions), "hand", "")
        for b in bars.itertuples()
    ]
    signalled = spark.createDataFrame(
        rows, "ticker string, trade_date date, close_price decimal(19,4), signal int, positions int, strategy string, params string"
    )
    paths = backtest.portfolio(signalled, Series(), ("strategy", "params"))
    return paths.orderBy("trade_date").collect(), backtest.metrics(paths, KEYS).first()


def test_position_on_the_first_bar_is_free(spark, prices):
    rows, _ = by_hand(spark, prices, [10, 11], [1, 1])
    assert [float(r.cash) for r in rows] == [10000, 10000]
    assert [float(r.total) for r in rows] == [11000, 11100]


def test_a_path_that_only_loses(spark, prices):
    _, m = by_hand(spark, prices, [10, 9, 8, 8], [0, 1, 1, 0])
    assert m.num_trades == 1 and m.profit_factor == 0.0
    assert m.total_return == pytest.approx(-1.0) and m.max_drawdown == pytest.approx(-1.0)
    assert m.sortino_ratio == 0  # one loss has no spread


def test_one_bar_and_no_trades(spark, prices):
    _, m = by_hand(spark, prices, [10], [0])
    assert (m.total_return, m.sharpe_ratio, m.num_trades, m.profit_factor) == (0, 0, 0, float("inf"))


def test_formatted_metrics(spark):
    row = (12.345678, 0.5, 3, -4.0, 1.25, float("inf"))
    names = "total_return double, sharpe_ratio double, num_trades bigint, max_drawdown double, sortino_ratio double, profit_factor double"
    text = backtest.formatted(spark.createDataFrame([row, (None, 0.0, 0, 0.0, 0.0, 2.0)], names)).collect()
    assert text[0].total_return == "12.35%" and text[0].max_drawdown == "-4.00%" and text[0].profit_factor == "inf"
    assert text[1].total_return == "N/A" and text[1].profit_factor == "2.00"


def test_many_sets_of_one_ticker_are_dealt_to_many_tasks(spark, prices):
    """200 parameter sets: no task has more rows than a group's paths times a block's bars."""
    grid = [st.Rsi(2 + i % 25, 30, 50 + i) for i in range(200)]
    bars, series = prices({"HOT": SERIES["WALK"]}), Series(months=6)
    report = backtest.report(bars, series, grid[:24])
    execution = report._jdf.queryExecution().optimizedPlan().toString()
    assert execution.count("Generate inline") >= 2 * 24 // st.GROUP
    groups = st.groups(grid)
    assert len(groups) == 25 and max(len(g) for _, g in groups) == st.GROUP
    for first, group in groups[:2]:
        signalled = st.signal_paths(bars, series, group)
        rows = signalled.groupBy("ticker", "_block").count().toPandas()["count"]
        assert rows.max() <= st.GROUP * series.frame.rows and len(rows) > 3
    got = report.toPandas()
    assert len(got) == 24 and set(got["params"]) == {st.label(s) for s in grid[:24]}
    again = backtest.report(bars, Series(), grid[17:18]).toPandas().iloc[0]
    same = got[got["params"] == again["params"]].iloc[0]
    assert all(same[c] == pytest.approx(again[c], abs=1e-9) for c in got.columns[3:])
