"""Rebuilding the model tables, in full or from the rows a batch changed."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barline.operators.merge import replace_by_key
from barline.operators.series import Series
from barline.plans import models
from barline.sources.versions import PERIOD, commit, period, pinned, read


def changed_from(batch: DataFrame) -> DataFrame:
    """The earliest changed date of each ticker in a batch."""
    return batch.groupBy("ticker").agg(F.min("trade_date").alias("changed_from"))


def recompute_enriched(enriched: DataFrame, staged: DataFrame, batch: DataFrame) -> DataFrame:
    """The enriched table after ``batch`` reached staging; equals a full rebuild.

    A changed bar alters its own row and the windows after it. So each affected
    ticker is computed again from its earliest changed date, over those rows and
    the 119 before them. The rows before are the last in date order, cut by a
    rank limit that Spark already applies ahead of the shuffle.
    """
    changed = changed_from(batch)
    affected = staged.join(changed, "ticker")
    is_new = F.col("trade_date") >= F.col("changed_from")
    latest = Window.partitionBy("ticker").orderBy(F.desc("trade_date"))
    context = (
        affected.filter(~is_new)
        .withColumn("_rank", F.row_number().over(latest))
        .filter(F.col("_rank") <= models.ENRICHED_LOOKBACK)
        .drop("_rank")
    )
    again = context.unionByName(affected.filter(is_new)).drop("changed_from")
    computed = models.enrich_stock_bars(again, Series()).join(changed, "ticker").filter(is_new)
    kept = enriched.join(changed, "ticker", "left").filter(
        F.col("changed_from").isNull() | (F.col("trade_date") < F.col("changed_from"))
    )
    return kept.select(enriched.columns).unionByName(computed.select(enriched.columns))


# --- stored models -----------------------------------------------------------------------


@dataclass(frozen=True)
class Models:
    """Where the model tables lie, and how their periods are cut: stocks by month, options
    by a finer grain, as there are more of them."""

    root: str
    stock_grain: str = "month"
    option_grain: str = "day"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def grain(self, name: str) -> str:
        return self.option_grain if "option" in name else self.stock_grain


TABLES = (
    "stg_stock_bars", "stg_option_bars", "stock_row_counts", "enriched_stock_bars", "enriched_option_bars",
    "stocks_options_joined", "fct_stock_performance",
)


def refresh(spark: SparkSession, stock_history: DataFrame, option_history: DataFrame, to: Models) -> dict[str, str]:
    """Write every model table from the histories and return their paths.

    Each step reads the tables before it, so no step computes another's work
    again and a lost executor costs at most the step it was running.
    """
    def rebuild(name: str, rows: DataFrame, laid: bool = False) -> DataFrame:
        commit(rows, to.path(name), to.grain(name), whole=True, laid=laid)
        return read(spark, to.path(name))

    staged = rebuild("stg_stock_bars", models.stage_stock_bars(stock_history))
    options = rebuild("stg_option_bars", models.stage_option_bars(option_history))
    rebuild("stock_row_counts", row_counts(staged, to))
    stocks = rebuild("enriched_stock_bars", models.enrich_stock_bars(staged, Series()))
    options = rebuild("enriched_option_bars", models.enrich_option_bars(options), laid=True)
    with beside(options, stocks) as (rows, laid):
        rebuild("stocks_options_joined", rows, laid)
    rebuild("fct_stock_performance", models.stock_performance(stocks), laid=True)
    return {name: to.path(name) for name in TABLES}


# Days of underlyings up to which their bars, some 200 bytes each, go to every task.
MOST_DAYS = 100_000


@contextmanager
def beside(options: DataFrame, stocks: DataFrame) -> Iterator[tuple[DataFrame, bool]]:
    """Stored options joined to stored stocks, and whether they are as they were laid out.

    Options have few underlyings beside all stocks. Where these have at most ``MOST_DAYS``
    days, which are counted, only their bars are taken, to where the options are; otherwise
    both sides are shuffled, which costs more than the joined table takes.
    """
    days = options.select(F.col("underlying_ticker").alias("ticker"), "trade_date").distinct().persist()
    try:
        few = days.count() <= MOST_DAYS
        if few:
            stocks = F.broadcast(stocks.join(F.broadcast(days), ["ticker", "trade_date"], "left_semi"))
        yield models.join_options_to_stocks(options, stocks), few
    finally:
        days.unpersist()


@dataclass
class Touched:
    """The periods of each table that an update has read and written."""

    read: dict[str, set[date]]
    written: dict[str, set[date]]


def update(
    spark: SparkSession, to: Models, stocks: DataFrame | None = None, options: DataFrame | None = None
) -> Touched:
    """Bring the model tables up to changed staged bars; equals ``refresh`` of everything.

    Stocks: a changed bar alters its row and the 119 after it in its series, and these read
    the 119 before them. Which periods hold them is told by the stored row counts per ticker
    and period; no other period of a table is read or written. The joined table is redone
    for the periods of changed options, and for those in which options have an underlying
    whose bars were redone.

    Every step commits by itself and can be run again; an update that was stopped is simply
    run again with the same bars.
    """
    seen = Touched({}, {})

    def take(name: str, periods: set[date]) -> DataFrame:
        seen.read[name] = seen.read.get(name, set()) | periods
        return read(spark, to.path(name), periods=periods)

    def put(name: str, rows: DataFrame, periods: set[date], laid: bool = False) -> None:
        if periods:
            seen.written[name] = seen.written.get(name, set()) | periods
            commit(rows, to.path(name), to.grain(name), laid=laid)

    def merged(name: str, batch: DataFrame, keys: tuple[str, ...]) -> set[date]:
        periods = {row[0] for row in batch.select(period(to.grain(name))).distinct().collect()}
        put(name, replace_by_key(take(name, periods), batch, keys), periods)
        return periods

    redone: set[date] = set()
    if stocks is not None:
        months = merged("stg_stock_bars", stocks, ("ticker", "trade_date"))
        put("stock_row_counts", row_counts(take("stg_stock_bars", months), to), months)
        month = period(to.stock_grain).alias(PERIOD)
        changed = stocks.select("ticker", month).distinct()
        spans = reach(read(spark, to.path("stock_row_counts")), changed, models.ENRICHED_LOOKBACK)
        needed = {row[0]: row[1] for row in spans.groupBy(PERIOD).agg(F.max("redo")).collect()}
        redone = {p for p, redo in needed.items() if redo}
        again = spans.filter("redo").select("ticker", PERIOD)
        staged = take("stg_stock_bars", set(needed)).withColumn(PERIOD, month)
        staged = staged.join(spans.select("ticker", PERIOD), ["ticker", PERIOD], "left_semi").drop(PERIOD)
        computed = models.enrich_stock_bars(staged, Series()).withColumn(PERIOD, month).join(again, ["ticker", PERIOD], "left_semi")
        kept = take("enriched_stock_bars", redone).withColumn(PERIOD, month).join(again, ["ticker", PERIOD], "left_anti")
        put("enriched_stock_bars", kept.unionByName(computed).drop(PERIOD), redone)
        put("fct_stock_performance", models.stock_performance(take("enriched_stock_bars", redone)), redone, laid=True)

    days: set[date] = set()
    if options is not None:
        days = merged("stg_option_bars", options, ("option_symbol", "trade_date"))
        put("enriched_option_bars", models.enrich_option_bars(take("stg_option_bars", days)), days, laid=True)
    if redone:
        listed = {date.fromisoformat(p) for p in pinned(spark, to.path("enriched_option_bars")).periods}
        near = {d for d in listed if start_of(d, to.stock_grain) in {start_of(r, to.stock_grain) for r in redone}}
        held = take("enriched_option_bars", near).select(
            F.col("underlying_ticker").alias("ticker"), period(to.stock_grain).alias(PERIOD),
            period(to.option_grain).alias("day"),
        ).distinct().join(again, ["ticker", PERIOD], "left_semi")
        days = days | {row[0] for row in held.select("day").distinct().collect()}
    if days:
        chosen = take("enriched_option_bars", days)
        stocks = take("enriched_stock_bars", {start_of(d, to.stock_grain) for d in days})
        with beside(chosen, stocks) as (rows, laid):
            put("stocks_options_joined", rows, days, laid)
    return seen


def start_of(day: date, grain: str) -> date:
    return day if grain == "day" else day.replace(day=1) if grain == "month" else day.replace(month=1, day=1)


def row_counts(staged: DataFrame, to: Models) -> DataFrame:
    """(ticker, trade_date, n): how many bars each ticker has in a period, dated its first day."""
    return staged.groupBy("ticker", period(to.stock_grain).alias("trade_date")).agg(F.count("*").alias("n"))


def reach(counts: DataFrame, changed: DataFrame, lookback: int) -> DataFrame:
    """(ticker, period, redo): the periods in which rows must be redone (``redo``) since
    ``changed`` ones (ticker, period) are at most ``lookback`` rows before them, and those
    with the rows that these reach back to.

    Between two periods lie as many rows as the sums of counts differ by. A ticker's periods
    are one array, no longer than the calendar.
    """
    own = counts.select("ticker", F.col("trade_date").alias(PERIOD), "n").join(
        changed.select("ticker").distinct(), "ticker", "left_semi"
    ).join(changed.withColumn("hit", F.lit(True)), ["ticker", PERIOD], "left")
    so_far = Window.partitionBy("ticker").orderBy(PERIOD).rowsBetween(Window.unboundedPreceding, 0)
    placed = own.withColumn("until", F.sum("n").over(so_far)).groupBy("ticker").agg(
        F.sort_array(F.collect_list(F.struct(PERIOD, "n", "until", F.coalesce("hit", F.lit(False)).alias("hit")))).alias("all")
    )
    near = f"({{0}}.{PERIOD} = {{1}}.{PERIOD} OR {{0}}.{PERIOD} < {{1}}.{PERIOD} AND {{1}}.until - {{1}}.n - {{0}}.until < {lookback})"
    redo = f"filter(all, w -> exists(all, t -> t.hit AND {near.format('t', 'w')}))"
    placed = placed.withColumn("again", F.expr(redo))
    placed = placed.withColumn("read", F.expr(f"filter(all, r -> exists(again, w -> {near.format('r', 'w')}))"))
    flagged = f"transform(read, r -> named_struct('{PERIOD}', r.{PERIOD}, 'redo', exists(again, w -> w.{PERIOD} = r.{PERIOD})))"
    return placed.select("ticker", F.inline(F.expr(flagged)))
