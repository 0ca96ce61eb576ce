"""Indicators and signals against pandas, and on the edges of their definitions."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barline.operators.indicators import Indicators
from barline.operators.rolling import Averages, weighty_rows
from barline.operators.series import Series, over_series
from barline.plans import strategies as st

PLAIN, SPLIT = Series(), Series(months=2)


def walk(n, seed, start=50.0):
    steps = np.random.default_rng(seed).normal(0, 0.8, n)
    return [float(x) for x in np.round(np.maximum(start + np.cumsum(steps), 0.5), 2)]


SERIES = {
    "WALK": walk(700, 1),
    "LOW": walk(300, 2, 1.0),
    "SHORT": walk(9, 3),
    "ONE": [12.5],
    "FLAT": [7.1] * 80,
    "UP": [float(i) for i in range(1, 61)],
    "DOWN": [float(i) for i in range(80, 20, -1)],
    "STEP": [10.03] * 40 + [11.07] * 40,
}


def collected(df, *columns):
    frames = df.select("ticker", "trade_date", *columns).toPandas().sort_values(["ticker", "trade_date"])
    return {t: g[list(columns)].reset_index(drop=True) for t, g in frames.groupby("ticker")}


def rsi(x, window):
    change = x.diff().fillna(0.0)
    gain, loss = change.clip(lower=0).rolling(window).mean(), (-change).clip(lower=0).rolling(window).mean()
    loss, gain = loss.where(loss > 1e-9, 0.0), gain.where(gain > 1e-9, 0.0)
    return 100 - 100 / (1 + gain / loss)


def macd(x, short, long, signal):
    line = x.ewm(span=short, adjust=False).mean() - x.ewm(span=long, adjust=False).mean()
    return line, line.ewm(span=signal, adjust=False).mean()


def same(got, want, places=1e-8):
    got, want = np.array(got, dtype=float), np.array(want, dtype=float)
    assert (np.isnan(got) == np.isnan(want)).all()
    keep = ~np.isnan(want)
    assert np.allclose(got[keep], want[keep], rtol=places, atol=places)


@pytest.mark.parametrize("series", [PLAIN, SPLIT], ids=["plain", "split"])
def test_indicators_match_pandas(prices, series):
    ind = Indicators()
    upper, lower = ind.bollinger(20, 2.0)
    line, signal = ind.macd(12, 26, 9)
    shown = {"rsi": ind.rsi(14), "upper": upper, "lower": lower, "line": line, "signal": signal, "mean": ind.mean(20)}
    added = over_series(prices(SERIES), series, ind.lookback, ind.add, ind.carried)
    found = collected(added.select("ticker", "trade_date", *[c.alias(n) for n, c in shown.items()]), *shown)
    for ticker, values in SERIES.items():
        x, got = pd.Series(values), found[ticker]
        same(got["rsi"], rsi(x, 14))
        same(got["mean"], x.rolling(20, min_periods=1).mean())
        spread = x.rolling(20).std()
        same(got["upper"], x.rolling(20).mean() + 2 * spread)
        same(got["lower"], x.rolling(20).mean() - 2 * spread)
        want_line, want_signal = macd(x, 12, 26, 9)
        same(got["line"], want_line)
        same(got["signal"], want_signal)


def averaged(prices, values, spans, series):
    bars = prices({"X": values}).withColumn("x", F.col("close_price").cast("double"))
    averages = Averages("x")
    names = [averages.average(span) for span in spans]
    got = collected(over_series(bars, series, 1, averages.add, averages), *names)["X"]
    return [got[name] for name in names]


@pytest.mark.parametrize("series", [PLAIN, SPLIT, Series(months=30)], ids=["plain", "split", "years"])
@pytest.mark.parametrize("spans", [(1,), (2,), (9, 12, 26), (3, 400), (1, 2, 1000)], ids=str)
def test_averages_match_pandas_at_any_span(prices, spans, series):
    x = pd.Series(walk(3000, 5))
    for span, got in zip(spans, averaged(prices, x.tolist(), spans, series), strict=True):
        same(got, x.ewm(span=span, adjust=False).mean(), 1e-12)


@pytest.mark.parametrize("span", [2, 12, 40])
@pytest.mark.parametrize("series", [PLAIN, SPLIT], ids=["plain", "split"])
@pytest.mark.parametrize("spike", [1e6, 1e14])
def test_averages_remember_a_spike(prices, spike, series, span):
    for at in (30, 365, 364 + 366):  # a month's, and a year's first and last days
        x = pd.Series([0.01] * 1500)
        x[at] = spike
        (got,) = averaged(prices, x.tolist(), (span,), series)
        same(got / x.ewm(span=span, adjust=False).mean(), [1.0] * len(x), 1e-12)


@pytest.mark.parametrize("lines", [(12, 26, 9), (2, 3, 2), (5, 20, 5), (1, 9, 1), (9, 2, 40)], ids=str)
def test_lines_and_signals_go_from_block_to_block(prices, lines):
    ind = Indicators()
    line, signal = ind.macd(*lines)
    for series in (PLAIN, SPLIT, Series(months=1)):
        added = over_series(prices({"X": walk(900, 8)}), series, 1, ind.add, ind.carried)
        got = collected(added.select("ticker", "trade_date", line.alias("line"), signal.alias("signal")), "line", "signal")["X"]
        want_line, want_signal = macd(pd.Series(walk(900, 8)), *lines)
        same(got["line"], want_line, 1e-11)
        same(got["signal"], want_signal, 1e-11)


def test_weights_of_a_year_fit_any_span():
    assert weighty_rows(2) >= 366 and weighty_rows(9) >= PLAIN.frame.rows
    with pytest.raises(ValueError):
        Averages("x").average(1.5)


def expected_signal(x, strategy):
    if isinstance(strategy, st.Momentum):
        short = x.rolling(strategy.short_window, min_periods=1).mean()
        long = x.rolling(strategy.long_window, min_periods=1).mean()
        on = (short > long + 1e-9) & (rsi(x, strategy.rsi_period) < strategy.rsi_overbought)
        on.iloc[: strategy.short_window] = False
        return on.astype(int)
    if isinstance(strategy, st.MeanReversion):
        mean, spread = x.rolling(strategy.window).mean(), x.rolling(strategy.window).std()
        spread = spread.where(spread > 1e-6)
        return (x < mean - strategy.num_std_dev * spread).astype(int)
    if isinstance(strategy, st.Macd):
        line, signal = macd(x, strategy.short_window, strategy.long_window, strategy.signal_window)
        return (line > signal + 1e-10).astype(int)
    strength = rsi(x, strategy.rsi_period)
    return ((strength > strategy.rsi_oversold) & ~(strength < strategy.rsi_overbought)).astype(int)


@pytest.mark.parametrize("series", [PLAIN, SPLIT], ids=["plain", "split"])
@pytest.mark.parametrize("strategy", [*st.DEFAULTS, st.Momentum(5, 12, 7, 60), st.Macd(5, 20, 5), st.Rsi(7, 40, 60)], ids=st.label)
def test_signals_match_pandas(prices, strategy, series):
    found = collected(st.signals(prices(SERIES), strategy, series), "signal", "positions")
    for ticker, values in SERIES.items():
        want = expected_signal(pd.Series(values), strategy)
        assert found[ticker]["signal"].tolist() == want.tolist(), ticker
        same(found[ticker]["positions"], want.diff())


def test_flat_prices_never_signal(prices):
    bars = prices({"FLAT": [0.1 * 3] * 700, "TENTHS": [0.7] * 700})
    assert st.all_signals(bars, PLAIN).filter("signal = 1").count() == 0


def test_rsi_edges(prices):
    ind = Indicators()
    strength = ind.rsi(14)
    added = over_series(prices(SERIES), PLAIN, ind.lookback, ind.add, ind.carried)
    got = collected(added.withColumn("rsi", strength), "rsi")
    assert got["UP"]["rsi"][13:].eq(100).all() and got["UP"]["rsi"][:13].isna().all()
    assert got["DOWN"]["rsi"][13:].eq(0).all()
    assert got["FLAT"]["rsi"].isna().all()
    assert not any(isinstance(v, float) and math.isnan(v) for v in [r.rsi for r in added.withColumn("rsi", strength).collect() if r.rsi is not None])


def test_dates_are_cut_before_windows(prices):
    bars = st.trading_bars(prices({"WALK": walk(100, 9)}), "2020-02-01", "2020-02-29")
    signalled = st.signals(bars, st.Momentum(), PLAIN).orderBy("trade_date").collect()
    assert len(signalled) == 29
    assert float(signalled[0].ma_short) == float(signalled[0].close_price)
    assert signalled[12].rsi is None and signalled[13].rsi is not None


def test_dispatch_by_name():
    assert st.by_name("macd", short_window=5) == st.Macd(5, 26, 9)
