"""Trading signals for every ticker and parameter set in one pass.

Each strategy asks for the indicators it reads and gives a condition on them.
The indicators of all strategies are computed side by side over the same series
windows, then each row becomes one row per strategy. Strategies are dealt in groups of
``GROUP``, each a shuffle and tasks of its own, so a task never holds more than one block
of a ticker for one group, however many parameter sets there are.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.operators.indicators import Indicators
from barline.operators.series import BLOCK, POS, Frame, Series, blocked, over_series

LABELS = ("strategy", "params")
PATH = "path"  # the place of a strategy in the list given, narrow enough to sort by
GROUP = 8


@dataclass(frozen=True)
class Momentum:
    short_window: int = 20
    long_window: int = 50
    rsi_period: int = 14
    rsi_overbought: float = 70
    name = "momentum"

    def signal(self, ind: Indicators) -> tuple[dict[str, Column], Column]:
        """Long while the short mean is above the long one and RSI is below its bound."""
        rsi = ind.rsi(self.rsi_period)
        n_short, n_long = (
            F.least(F.col(POS), F.lit(n)).cast("decimal(9,0)") for n in (self.short_window, self.long_window)
        )
        # Means compared as products of exact sums and counts: equal stays equal.
        above = ind.total(self.short_window) * n_long > ind.total(self.long_window) * n_short
        on = (F.col(POS) > self.short_window) & above & (rsi < self.rsi_overbought)
        shown = {"ma_short": ind.mean(self.short_window), "ma_long": ind.mean(self.long_window), "rsi": rsi}
        return shown, on


@dataclass(frozen=True)
class MeanReversion:
    window: int = 20
    num_std_dev: float = 2.0
    name = "mean_reversion"

    def signal(self, ind: Indicators) -> tuple[dict[str, Column], Column]:
        """Long only on the bars that close under the lower band."""
        upper, lower = ind.bollinger(self.window, self.num_std_dev)
        on = F.col("close_price").cast("double") < lower
        return {"upper_band": upper, "lower_band": lower}, on


@dataclass(frozen=True)
class Macd:
    short_window: int = 12
    long_window: int = 26
    signal_window: int = 9
    name = "macd"

    def signal(self, ind: Indicators) -> tuple[dict[str, Column], Column]:
        """Long while the MACD line is above its signal line."""
        line, signal_line = ind.macd(self.short_window, self.long_window, self.signal_window)
        return {"macd": line, "signal_line": signal_line}, ind.macd_above(line, signal_line)


@dataclass(frozen=True)
class Rsi:
    rsi_period: int = 14
    rsi_oversold: float = 30
    rsi_overbought: float = 70
    name = "rsi"

    def signal(self, ind: Indicators) -> tuple[dict[str, Column], Column]:
        """Long above the oversold bound unless below the overbought one.

        The second rule wins, so this holds only while RSI is overbought.
        """
        rsi = ind.rsi(self.rsi_period)
        return {"rsi": rsi}, (rsi > self.rsi_oversold) & (rsi >= self.rsi_overbought)


Strategy = Momentum | MeanReversion | Macd | Rsi
BY_NAME: dict[str, type] = {s.name: s for s in (Momentum, MeanReversion, Macd, Rsi)}
DEFAULTS: tuple[Strategy, ...] = (Momentum(), MeanReversion(), Macd(), Rsi())


def by_name(name: str, **params: float) -> Strategy:
    return BY_NAME[name](**params)


def label(strategy: Strategy) -> str:
    return ",".join(f"{k}={v:g}" for k, v in vars(strategy).items())


def trading_bars(mart: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """The mart columns strategies read, from bars that have a close.

    The date range (both ends included) is cut before any window, so warm-up
    starts over at its first day.
    """
    bars = mart.select("ticker", "trade_date", "close_price", "volume").filter(
        F.col("close_price").isNotNull()
    )
    if start is not None:
        bars = bars.filter(F.col("trade_date") >= F.lit(start).cast("date"))
    if end is not None:
        bars = bars.filter(F.col("trade_date") <= F.lit(end).cast("date"))
    return bars


def _held(on: Column) -> Column:
    return F.when(F.coalesce(on, F.lit(False)), 1).otherwise(0)


def signals(bars: DataFrame, strategy: Strategy, series: Series) -> DataFrame:
    """One strategy's indicator columns, ``signal`` and its change, ``positions``."""
    ind = Indicators()
    shown, on = strategy.signal(ind)

    def build(df: DataFrame, frame: Frame) -> DataFrame:
        held = ind.add(df, frame).select(
            *df.columns, *[c.alias(name) for name, c in shown.items()], _held(on).alias("signal")
        )
        return held.withColumn("positions", F.col("signal") - F.lag("signal").over(frame.window))

    return over_series(bars, series, ind.lookback + 1, build, ind.carried, [ind.price]).drop(POS)


def signal_paths(
    bars: DataFrame, series: Series, strategies: Sequence[Strategy] = DEFAULTS
) -> DataFrame:
    """Rows of (bar, path, signal, positions) for every strategy given, one group of them.

    Keeps ``_block`` for the portfolio that follows. Exploding after the windows keeps rows
    where they are: the bars' partitioning by ticker and block also serves windows by path.
    """
    ind = Indicators()
    held = {f"_on{i}": _held(s.signal(ind)[1]) for i, s in enumerate(strategies)}

    def build(df: DataFrame, frame: Frame) -> DataFrame:
        rows = ind.add(df, frame).select(*df.columns, *[c.alias(n) for n, c in held.items()])
        entries = ", ".join(
            f"named_struct('{PATH}', {i}, 'signal', {n}, 'positions', {n} - lag({n}) OVER ({frame.over}))"
            for i, n in enumerate(held)
        )
        changed = rows.select(*df.columns, F.expr(f"array({entries})").alias("_entries"))
        return changed.select(*df.columns, F.inline_outer("_entries"))

    return blocked(bars, series, ind.lookback + 1, build, ind.carried, [ind.price]).drop(POS)


def groups(strategies: Sequence[Strategy]) -> list[tuple[int, Sequence[Strategy]]]:
    """(path of the first, strategies) of each group."""
    return [(i, strategies[i : i + GROUP]) for i in range(0, len(strategies), GROUP)]


def labelled(rows: DataFrame, strategies: Sequence[Strategy]) -> DataFrame:
    """Replace the path by the strategy's name and parameters."""
    def pick(values: list[str]) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in values]), F.col(PATH) + 1)

    named = {"strategy": pick([s.name for s in strategies]), "params": pick([label(s) for s in strategies])}
    return rows.withColumns(named).drop(PATH)


def all_signals(
    bars: DataFrame, series: Series, strategies: Sequence[Strategy] = DEFAULTS
) -> DataFrame:
    """Rows of (bar, strategy, params, signal, positions) for every strategy given."""
    parts = [
        signal_paths(bars, series, group).drop(BLOCK).withColumn(PATH, F.col(PATH) + first)
        for first, group in groups(strategies)
    ]
    return labelled(reduce(DataFrame.unionByName, parts), strategies)


def trade_events(signalled: DataFrame) -> DataFrame:
    """Bars on which a position opens (buy) or closes (sell)."""
    side = F.when(F.col("positions") == 1, "buy").when(F.col("positions") == -1, "sell")
    return signalled.withColumn("side", side).filter(F.col("side").isNotNull())
