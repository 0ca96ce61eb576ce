"""Window columns over one series: means, differences, running values, EMA."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.operators.series import CARRY, PART, POS, ROW, Frame, Series, over_series


SO_FAR = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"


def rolling_mean(x: Column, frame: Frame, rows: int) -> Column:
    """Mean of the rows there are, from the first row on."""
    return F.avg(x).over(frame.last(rows))


def full_frame(x: Column, frame: Frame, rows: int, value: Column) -> Column:
    """``value`` once the frame holds ``rows`` non-null values, else null."""
    return F.when(F.count(x).over(frame.last(rows)) == rows, value)


def rolling_mean_full(x: Column, frame: Frame, rows: int) -> Column:
    return full_frame(x, frame, rows, rolling_mean(x, frame, rows))


def rolling_std_full(x: Column, frame: Frame, rows: int) -> Column:
    return full_frame(x, frame, rows, F.stddev_samp(x).over(frame.last(rows)))


def difference(x: Column, frame: Frame) -> Column:
    return x - F.lag(x).over(frame.window)


def percent_change(x: Column, frame: Frame) -> Column:
    return change_ratio(x, F.lag(x).over(frame.window))


def change_ratio(x: Column, previous: Column) -> Column:
    """``x / previous - 1``; from zero it is infinite, and null for zero to zero."""
    x, previous = x.cast("double"), previous.cast("double")
    from_zero = F.when(x > 0, F.lit(float("inf"))).when(x < 0, F.lit(float("-inf")))
    return F.when(previous != 0, x / previous - 1).when(previous == 0, from_zero)


def forward_fill(x: Column, frame: Frame) -> Column:
    return F.last(x, ignorenulls=True).over(frame.so_far)


def with_rolling_sums(
    df: DataFrame,
    frame: Frame,
    sums: dict[str, tuple[str, int]],
    beside: dict[str, Column] | None = None,
) -> DataFrame:
    """Add sums of a column over the last rows, each given as (column, rows).

    A sum is the running sum less the one so many rows before, so its cost does
    not grow with the frame; Spark adds a sliding frame up again for each row.
    Only for decimals and integers, whose differences are exact. Columns given
    ``beside`` are added in the same pass over the rows.
    """
    sources = {column for column, _ in sums.values()}
    running = {
        f"_run_{c}": F.expr(f"coalesce(sum({c}) OVER ({frame.over} {SO_FAR}), 0)") for c in sources
    }
    added = running | (beside or {})
    if added:
        df = df.withColumns(added)
    if not sums:
        return df
    last = {
        out: F.expr(f"_run_{c} - coalesce(lag(_run_{c}, {rows}) OVER ({frame.over}), 0)")
        for out, (c, rows) in sums.items()
    }
    return df.withColumns(last).drop(*running)


# --- Exponential moving average -----------------------------------------------

# How far weights may grow within a run of rows: prices, as decimal(19,4), are below 1e15, so a
# sum of them stays below the greatest double, 1.8e308.
MOST_WEIGHT = 1e290


class Averages:
    """Exponential averages of one column without nulls, and of differences of two of them.

    y(0) = x(0), then y = a x + (1 - a) y' with a = 2 / (span + 1).

    The recursion is affine, so any run of rows maps the average before it to the one after
    it by a scale, (1 - a) to the number of rows, and a shift, which is what the run makes of
    zero. Runs are put together by composing their maps, exactly and without forgetting:

    - Inside a run the shift is a running sum of x with weights growing by 1 / (1 - a),
      scaled back: one addition a row. All terms keep their sign, so it is as exact as the
      recursion. From span 9 on weights allow a block of 96 months to be one run.
    - For shorter spans the runs are the years of a block, composed in order.
    - Blocks are composed the same way (``after``), from one row of shifts a block.

    The state before a series is its first value, which gives y(0) = x(0) with the weights
    of any other row. A difference of averages is linear in their states, so the average of
    one has a map too, with a term for each of the two averages it comes from.
    """

    def __init__(self, x: str, prefix: str = "") -> None:
        self.x, self.prefix = x, prefix
        self.spans: set[float] = set()
        self.lines: set[tuple[float, float, float]] = set()

    # --- asking -----------------------------------------------------------------

    def average(self, span: float) -> str:
        """The column of the average over ``span``: 1, or 2 and more."""
        if span != 1 and span < 2:
            raise ValueError("span must be 1, or at least 2")
        self.spans.add(span)
        return f"{self.prefix}ema{_name(span)}"

    def line(self, short: float, long: float, signal: float) -> tuple[str, str]:
        """The columns of the short average less the long one, and of that line's average."""
        for span in (short, long):
            self.average(span)
        if signal != 1 and signal < 2:
            raise ValueError("span must be 1, or at least 2")
        self.lines.add((short, long, signal))
        line = f"{self.prefix}macd{_name(short)}_{_name(long)}"
        return line, f"{line}_{_name(signal)}"

    # --- states over blocks -----------------------------------------------------

    @property
    def names(self) -> list[str]:
        signals = [self.line(*line)[1] for line in sorted(self.lines)]
        return [self.average(span) for span in sorted(self.spans)] + signals

    def first(self, row: str) -> dict[str, str]:
        averages = {self.average(span) for span in self.spans}
        return {n: f"CAST({row}.{self.x} AS DOUBLE)" if n in averages else "0.0D" for n in self.names}

    def local(self, rows: str) -> str:
        """The recursion itself, from zero over one block's rows."""
        def step(x: str, span: float, name: str) -> str:
            return f"{1 - _keep(span)!r}D * ({x}) + {_keep(span)!r}D * s.{name}"

        averages = {self.average(span): step(f"CAST(r.{self.x} AS DOUBLE)", span, self.average(span)) for span in sorted(self.spans)}
        after = dict(averages)
        for short, long, signal in sorted(self.lines):
            name = self.line(short, long, signal)[1]
            after[name] = step(f"({averages[self.average(short)]}) - ({averages[self.average(long)]})", signal, name)
        zeros, after = (", ".join(f"'{n}', {v}" for n, v in x.items()) for x in (dict.fromkeys(after, "0.0D"), after))
        return f"aggregate({rows}, named_struct({zeros}), (s, r) -> named_struct({after}))"

    def after(self, state: str, rows: str, local: str) -> dict[str, str]:
        def decay(span: float) -> str:
            return f"pow({_keep(span)!r}D, {rows})"

        def echo(span: float, signal: float) -> str:
            """What a signal becomes while an average decays, per unit of it."""
            own, keep = _keep(span), _keep(signal)
            if own == keep:
                return f"{1 - keep!r}D * {rows} * {decay(span)}"
            return f"{(1 - keep) * own / (own - keep)!r}D * ({decay(span)} - {decay(signal)})"

        out = {}
        for span in sorted(self.spans):
            name = self.average(span)
            out[name] = f"{state}.{name} * {decay(span)} + {local}.{name}"
        for short, long, signal in sorted(self.lines):
            name = self.line(short, long, signal)[1]
            out[name] = (
                f"{state}.{name} * {decay(signal)} + {local}.{name}"
                f" + {echo(short, signal)} * {state}.{self.average(short)} - {echo(long, signal)} * {state}.{self.average(long)}"
            )
        return out

    # --- adding -----------------------------------------------------------------

    def add(self, df: DataFrame, frame: Frame) -> DataFrame:
        """Add every column asked for, to rows as ``over_series`` gives them with these
        averages carried."""
        averages = {self.average(span): (f"CAST({self.x} AS DOUBLE)", span) for span in sorted(self.spans)}
        start = {"_x0": F.expr(f"first(CAST({self.x} AS DOUBLE)) OVER ({frame.over})")}
        before = {
            f"_from_{name}": F.expr(f"coalesce({CARRY}.{name}, {'_x0' if name in averages else '0.0D'})") for name in self.names
        }
        df = _averaged(df.withColumns(start).withColumns(before), frame, averages)
        if self.lines:
            lines = {self.line(*at)[0]: F.expr(f"{self.average(at[0])} - {self.average(at[1])}") for at in sorted(self.lines)}
            signals = {self.line(*at)[1]: (self.line(*at)[0], at[2]) for at in sorted(self.lines)}
            df = _averaged(df.withColumns(lines), frame, signals)
        return df.drop(*start, *before, "_step", "_size", "_done")


def _name(span: float) -> str:
    return f"{span:g}".replace(".", "p")


def _keep(span: float) -> float:
    return (span - 1.0) / (span + 1.0)


def _averaged(df: DataFrame, frame: Frame, averages: dict[str, tuple[str, float]]) -> DataFrame:
    """Add averages, each given as (SQL of a double, span), from the states before the block,
    ``_from_`` and the average's name, which are the averages of copies of earlier rows.

    A span whose weights allow it takes a block as one run of rows, others take it by parts
    and compose these. One sort serves both."""
    inside, whole = frame.inside(PART).over, "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"
    by_parts = {out for out, (_, span) in averages.items() if span > 1 and weighty_rows(span) < frame.rows}
    if by_parts and "_step" not in df.columns:
        df = df.withColumns({
            "_step": F.expr(f"row_number() OVER ({inside}) - 1"), "_size": F.expr(f"count(*) OVER ({inside} {whole})"),
        })
        df = df.withColumn("_done", F.expr(
            f"count(CASE WHEN {ROW} > 0 AND _step = _size - 1 THEN 1 END) OVER ({frame.over} {SO_FAR})"
            f" - CASE WHEN _step = _size - 1 THEN 1 ELSE 0 END"
        ))
    sums, ends, states = {}, {}, {}
    for out, (x, span) in averages.items():
        if span == 1:
            states[out] = F.expr(f"CASE WHEN {ROW} > 0 THEN {x} ELSE _from_{out} END")
            continue
        keep, entered = f"{_keep(span)!r}D", f"_from_{out}"
        over, step = (inside, "_step") if out in by_parts else (frame.over, f"({ROW} - 1)")
        weight = f"CASE WHEN {ROW} > 0 THEN {1 - _keep(span)!r}D * pow({keep}, -{step}) * ({x}) ELSE 0.0D END"
        sums[f"_sum_{out}"] = F.expr(f"pow({keep}, {step}) * sum({weight}) OVER ({over} {SO_FAR})")
        if out in by_parts:
            end = f"CASE WHEN {ROW} > 0 AND _step = _size - 1 THEN named_struct('n', _size, 'shift', _sum_{out}) END"
            ends[f"_ends_{out}"] = F.expr(f"collect_list({end}) OVER ({frame.over} {whole})")
            entered = (
                f"CASE WHEN _done = 0 THEN _from_{out} ELSE aggregate(slice(_ends_{out}, 1, int(_done)), _from_{out},"
                f" (y, e) -> y * pow({keep}, e.n) + e.shift) END"
            )
        states[out] = F.expr(f"CASE WHEN {ROW} > 0 THEN _sum_{out} + pow({keep}, {step} + 1) * ({entered}) ELSE _from_{out} END")
    for columns in (sums, ends, states):
        if columns:
            df = df.withColumns(columns)
    return df.drop(*sums, *ends)


def weighty_rows(span: float) -> int:
    """Rows within which weights of ``span`` stay below ``MOST_WEIGHT``."""
    return int(math.log(MOST_WEIGHT) / -math.log(_keep(span)))


# --- Ready-made frames for one value column -------------------------------------


def add_columns(
    df: DataFrame,
    series: Series,
    lookback: int,
    columns: Callable[[Frame], dict[str, Column]],
) -> DataFrame:
    """Add window columns made by ``columns`` from the series' frame."""
    return over_series(df, series, lookback, lambda d, f: d.withColumns(columns(f))).drop(POS)
