"""RSI, MACD and Bollinger bands over a series frame.

Indicators are asked for first and added together, so any number of them, for
any number of parameter sets, takes the same few passes over the sorted rows.

Prices come in as decimals. Sums of gains, losses and prices stay decimal, so
they are exact and "no losses at all" is a plain test for zero; only the ratios
are doubles. Warm-up rows are null, never NaN: Spark sorts NaN above every
number, which would make ``NaN > 70`` true.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.operators.rolling import Averages, with_rolling_sums
from barline.operators.series import POS, Frame

# Two averages of equal prices can differ in their last bits. A gap below this
# share of the price is such noise, not a crossing.
NOISE = 1e-12
PREFIX = "_i_"


class Indicators:
    """The indicator columns a job needs; asking twice for one gives the same column."""

    def __init__(self, price: str = "close_price") -> None:
        self.price = price
        self._sums: dict[str, tuple[str, int]] = {}
        self._rsi: set[int] = set()
        self._bands: dict[int, set[float]] = {}
        self._averages = Averages(price, PREFIX)

    # --- asking -----------------------------------------------------------------

    def total(self, rows: int) -> Column:
        """The exact sum of the last closes, fewer at the start."""
        self._sums[f"{PREFIX}sum{rows}"] = (self.price, rows)
        return F.col(f"{PREFIX}sum{rows}")

    def mean(self, rows: int) -> Column:
        return self.total(rows).cast("double") / F.least(F.col(POS), F.lit(rows))

    def rsi(self, window: int) -> Column:
        """Relative strength; the first row counts as no change.

        Null until ``window`` rows are there and where the price never moved;
        100 where it only rose.
        """
        self._rsi.add(window)
        for side in ("up", "down"):
            self._sums[f"{PREFIX}{side}{window}"] = (f"{PREFIX}{side}", window)
        gain, loss = (f"CAST({PREFIX}{side}{window} AS DOUBLE)" for side in ("up", "down"))
        return F.expr(
            f"CASE WHEN {POS} < {window} THEN NULL"
            f" WHEN {loss} > 0 THEN 100 - 100 / (1 + {gain} / {loss}) WHEN {gain} > 0 THEN 100.0D END"
        )

    def bollinger(self, window: int, width: float) -> tuple[Column, Column]:
        """Upper and lower band: mean and sample deviation of a full window.

        A flat window's bands are its price: a mean of equal doubles may miss it
        by a bit, and would then report prices outside bands of no width.
        """
        self._bands.setdefault(window, set()).add(width)
        mean, spread, low, high = (f"{PREFIX}{part}{window}" for part in ("mean", "std", "min", "max"))

        def band(sign: str) -> Column:
            return F.expr(
                f"CASE WHEN {POS} < {window} THEN NULL WHEN {low} = {high} THEN CAST({self.price} AS DOUBLE)"
                f" ELSE {mean} {sign} {float(width)!r}D * {spread} END"
            )

        return band("+"), band("-")

    def macd(self, short: int, long: int, signal: int) -> tuple[Column, Column]:
        """The short average less the long one, and that line's own average."""
        line, signal_line = self._averages.line(short, long, signal)
        return F.col(line), F.col(signal_line)

    def macd_above(self, line: Column, signal_line: Column) -> Column:
        return line - signal_line > NOISE * F.abs(F.col(self.price).cast("double"))

    # --- adding -----------------------------------------------------------------

    @property
    def lookback(self) -> int:
        """How many rows before the current one any of the columns but averages depends on."""
        return max([1, *(rows for _, rows in self._sums.values()), *self._bands])

    @property
    def carried(self) -> Averages | None:
        """What goes from block to block instead."""
        return self._averages if self._averages.spans else None

    def add(self, df: DataFrame, frame: Frame) -> DataFrame:
        """Add every column asked for. ``df`` has a price on every row."""
        price = self.price
        if self._rsi:
            move = f"coalesce(CASE WHEN {POS} > 1 THEN {price} - lag({price}) OVER ({frame.over}) END, 0)"
            df = df.withColumns(
                {f"{PREFIX}up": F.expr(f"greatest({move}, 0)"), f"{PREFIX}down": F.expr(f"greatest(-{move}, 0)")}
            )
        x = f"CAST({price} AS DOUBLE)"
        parts = {"mean": f"avg({x})", "std": f"stddev_samp({x})", "min": f"min({price})", "max": f"max({price})"}
        beside = {
            f"{PREFIX}{part}{rows}": F.expr(
                f"{value} OVER ({frame.over} ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"
            )
            for rows in self._bands for part, value in parts.items()
        }
        df = with_rolling_sums(df, frame, self._sums, beside)
        return self._averages.add(df, frame) if self.carried else df
