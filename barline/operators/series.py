"""Ordered windows over series of any length, in blocks of calendar time.

A series is the rows of one key in date order, one row a date. Every series is cut into
blocks of so many months, whatever its length, so a block holds at most 31 rows a month and
a group of rows in a task is bounded. What crosses a block's edge comes in as extra rows:

1. Every block but the newest is brought down to one row: its number of rows, the last of
   them, and what it does to states that go from row to row (``Carried``).
2. These are put together by key, in order: the counts to the place in its series of every
   block's first row, the last rows to copies as far back as the next block's frames reach,
   the states to those before the next block.

Rows and copies then meet in one shuffle by key and block. No job runs while a plan is
built, and the plan is the same for one row and for a key with most of the rows. Without
older blocks the copies' part is empty, and adaptive execution leaves it out.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from typing import Protocol

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

BLOCK_MONTHS = 96

POS = "_pos"  # 1-based place of a row in its whole series
ROW = "_row"  # 1-based place of a row in its block; copies have 0 and less
BLOCK = "_block"
OWN = "_own"  # whether a row is the block's own, not a copy
PART = "_part"  # the year of its block that a row is in, from 0; copies are before them
PART_MONTHS = 12


@dataclass(frozen=True)
class Series:
    """How rows form series: their keys, the date they are ordered by, and the months of a block."""

    keys: tuple[str, ...] = ("ticker",)
    order: str = "trade_date"
    months: int = BLOCK_MONTHS

    def within(self, *extra: str) -> Series:
        """The same order inside a finer key, for example one per strategy."""
        return replace(self, keys=self.keys + extra)

    @property
    def frame(self) -> Frame:
        rows = min(31 * self.months, 366 * math.ceil(self.months / 12))
        return Frame((*self.keys, BLOCK), self.order, (PART,), rows)

    def month(self) -> Column:
        return F.year(self.order) * 12 + F.month(self.order) - 1

    def block(self) -> Column:
        """The block of a row; rows without a date are before all others."""
        return F.coalesce(F.floor(self.month() / F.lit(self.months)).cast("int"), F.lit(-1))

    def part(self) -> Column:
        return F.coalesce(F.floor(F.pmod(self.month(), F.lit(self.months)) / F.lit(PART_MONTHS)).cast("int"), F.lit(0))

    def newest(self, df: DataFrame) -> Column:
        """The last block that any series has, found while the query runs."""
        return df.agg(F.max(self.block())).scalar()


@dataclass(frozen=True)
class Frame:
    """What a window builder gets: the group columns and the row order.

    Columns that ``led`` the order never decrease with it, so they change nothing but that
    one sort serves windows within them too.
    """

    by: tuple[str, ...]
    order: str
    led: tuple[str, ...] = ()
    rows: float = math.inf  # the most own rows of a group, where dates bound them

    @property
    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.by).orderBy(*self.led, self.order)

    @property
    def over(self) -> str:
        """The window as SQL text: long lists of window columns are quicker to
        build, and easier to read, as expressions."""
        return f"PARTITION BY {', '.join(self.by)} ORDER BY {', '.join((*self.led, self.order))}"

    def last(self, rows: int) -> WindowSpec:
        """The current row and the ``rows - 1`` before it."""
        return self.window.rowsBetween(1 - rows, 0)

    @property
    def so_far(self) -> WindowSpec:
        return self.window.rowsBetween(Window.unboundedPreceding, 0)

    @property
    def before(self) -> WindowSpec:
        return self.window.rowsBetween(Window.unboundedPreceding, -1)

    def inside(self, *extra: str) -> Frame:
        """The same order within a finer group."""
        return replace(self, by=self.by + extra, led=tuple(c for c in self.led if c not in extra))


class Carried(Protocol):
    """States that go from a block to the next, as SQL: what a block does to any state is
    told by what it makes of the state zero, and its number of rows."""

    @property
    def names(self) -> Sequence[str]:
        """The states, doubles."""

    def first(self, row: str) -> dict[str, str]:
        """The states before a series, from the struct of its first row."""

    def local(self, rows: str) -> str:
        """A struct of the states after an array of rows, from zero before them."""

    def after(self, state: str, rows: str, local: str) -> dict[str, str]:
        """The states after a block of so many rows, from the struct of those before it and
        the struct of what it makes of zero."""


CARRY = "_carry"  # a struct of the states before a block, null in a series' first block


def _struct(values: dict[str, str]) -> str:
    return f"named_struct({', '.join(f"'{name}', {value}" for name, value in values.items())})"


def copies(
    df: DataFrame, series: Series, lookback: int, carried: Carried | None, columns: Sequence[str]
) -> DataFrame:
    """The rows that blocks get from before them: as many as ``lookback``, with their place
    in the series, the rows before the block and the carried states.

    Each block but the newest becomes one row: how many rows it has, the last of them, and
    the states that it makes of zero. A window over these, by key, adds up the counts,
    takes the states on and gathers the last rows, over as many blocks as that takes. The
    block after is the next that the series has, or else the newest.
    """
    keys, newest = series.keys, series.newest(df)
    by, row = ", ".join(keys), [series.order, *(c for c in columns if c not in (*keys, series.order))]
    last = f"slice(%s, greatest(size(%s) - {lookback - 1}, 1), {lookback})"
    older = df.withColumn(BLOCK, series.block()).filter(F.col(BLOCK) < newest)
    summed = older.groupBy(*keys, BLOCK).agg(F.sort_array(F.collect_list(F.struct(*row))).alias("_rows"))
    parts = [f"size(_rows) AS _n", f"{last.replace('%s', '_rows')} AS _tail"]
    over = f"OVER (PARTITION BY {by} ORDER BY {BLOCK}"
    so_far = f"{over} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    gathered = [
        f"lead({BLOCK}) {over}) AS _to", f"sum(_n) {so_far} AS _before",
        f"flatten(collect_list(_tail) {over} ROWS BETWEEN {lookback - 1} PRECEDING AND CURRENT ROW)) AS _near",
    ]
    came = {"at": "_before - size(_near) + 1 + _i", "before": "_before"}
    if carried:
        parts.append(
            f"named_struct('n', size(_rows), 'first', {_struct(carried.first('_rows[0]'))}, 'local', {carried.local('_rows')}) AS _part"
        )
        gathered.append(f"collect_list(_part) {so_far} AS _parts")
        came["state"] = (
            f"aggregate(_parts, _parts[0].first, (s, p) -> {_struct(carried.after('s', 'p.n', 'p.local'))})"
        )
    blocks = summed.selectExpr(*keys, BLOCK, *parts).selectExpr(*keys, *gathered)
    placed = blocks.selectExpr("*", f"{last.replace('%s', '_near')} AS _near_rows").drop("_near").withColumnRenamed("_near_rows", "_near")
    placed = placed.selectExpr("*", "posexplode(_near) AS (_i, _copy)")
    return placed.select(
        *keys, F.coalesce("_to", newest).alias(BLOCK), F.lit(-1).alias(PART), F.lit(False).alias(OWN),
        F.expr(_struct(came)).alias("_came"), "_copy.*",
    )


def blocked(
    df: DataFrame,
    series: Series,
    lookback: int,
    build: Callable[[DataFrame, Frame], DataFrame],
    carried: Carried | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Run ``build`` over each block; its frames reach at most ``lookback`` back.

    ``build`` may read ``_pos``, ``_row`` and, if something is ``carried``, ``_carry``; it
    adds columns with windows from the frame it is given. ``columns`` are those that it
    reads on rows before the current one, all if not given; others are null on copies. The
    result keeps ``_pos`` and ``_block`` for later steps.
    """
    own = df.select("*", series.block().alias(BLOCK), series.part().alias(PART), F.lit(True).alias(OWN))
    before = copies(df, series, max(lookback, 1), carried, df.columns if columns is None else columns)
    rows, frame = own.unionByName(before, allowMissingColumns=True), series.frame
    rows = rows.selectExpr(
        *df.columns, BLOCK, PART, OWN, f"first(_came) OVER ({frame.over}) AS _came", f"row_number() OVER ({frame.over}) AS _rank"
    )
    place = "coalesce(_came.at, 1) + _rank - 1"
    placed = rows.selectExpr(
        *df.columns, BLOCK, PART, OWN, f"{place} AS {POS}", f"{place} - coalesce(_came.before, 0) AS {ROW}",
        *([f"_came.state AS {CARRY}"] if carried else []),
    )
    return build(placed, frame).filter(OWN).drop(OWN, PART, ROW, CARRY)


def over_series(
    df: DataFrame,
    series: Series,
    lookback: int,
    build: Callable[[DataFrame, Frame], DataFrame],
    carried: Carried | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """``blocked``, without the blocks."""
    return blocked(df, series, lookback, build, carried, columns).drop(BLOCK)


def running(df: DataFrame, series: Series, x: str, kind: str, out: str) -> DataFrame:
    """Add the running ``sum``, ``max`` or last non-null value (``ffill``) of ``x``.

    What the blocks before come to, a sum per key and block, is one more row in front of a
    block, so the cost stays one pass over the rows whatever a series' length.
    """
    def fold(column: Column) -> Column:
        if kind == "ffill":
            return F.last(column, ignorenulls=True)
        return {"sum": F.sum, "max": F.max}[kind](column)

    whole = {
        "sum": F.sum(x), "max": F.max(x),
        "ffill": F.max_by(x, F.when(F.col(x).isNotNull(), F.col(series.order))),
    }[kind]
    chain = Frame(series.keys, BLOCK)
    blocks = df.withColumn(BLOCK, series.block()).groupBy(*series.keys, BLOCK).agg(whole.alias("_whole"))
    before = blocks.select(
        *series.keys, BLOCK, fold(F.col("_whole")).over(chain.before).alias("_x")
    ).filter(F.col("_x").isNotNull()).withColumn(OWN, F.lit(False))
    rows = df.select("*", series.block().alias(BLOCK), F.col(x).alias("_x"), F.lit(True).alias(OWN))
    rows = rows.unionByName(before, allowMissingColumns=True)
    by_place = Window.partitionBy(*series.keys, BLOCK).orderBy(OWN, series.order)
    return rows.withColumn(out, fold(F.col("_x")).over(by_place.rowsBetween(Window.unboundedPreceding, 0))).filter(
        OWN
    ).drop(OWN, BLOCK, "_x")
