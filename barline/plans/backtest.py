"""Portfolio paths and risk metrics for every ticker, strategy and parameter set."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.operators.rolling import change_ratio
from barline.operators.series import BLOCK, Frame, Series
from barline.plans.strategies import DEFAULTS, PATH, Strategy, groups, labelled, signal_paths

# Fixed values of the trading rules.
CAPITAL = 10_000
SHARES = 100
TRADING_DAYS = 252


def portfolio(
    signalled: DataFrame,
    series: Series,
    labels: Sequence[str] = (PATH,),
    newest: Column | None = None,
) -> DataFrame:
    """Holdings, cash, total, returns, running peak and drawdown of each path.

    ``signalled`` has one row per bar and ``labels``, which tell the paths of a series
    apart. Shares are bought and sold at the close of the bar on which the signal changes; a
    position held on the first bar costs nothing. Money is decimal throughout, so sums do
    not depend on the order rows are added in.

    A path is added up inside each block of its series. What a block starts from comes from
    one row a path and block before it (``_starts``). The ``newest`` block may
    be given where there is a shorter way to it; the filter on older ones reaches the scan.
    """
    rows = _local(signalled, series, labels)
    starts = _starts(rows, series.newest(signalled) if newest is None else newest, series, labels)
    rows = rows.join(starts, [*series.keys, BLOCK], "left")
    start = F.col("_starts")[F.struct(*labels)]
    rows = rows.withColumns({"_start": F.coalesce(start["cash"], F.lit(CAPITAL)), "_total0": start["total"], "_peak0": start["peak"]})
    rows = rows.withColumns(
        {
            "cash": F.col("_start") - F.col("_sum"),
            "total": F.col("_start") + F.col("_net"),
            "_previous": F.coalesce(F.col("_start") + F.col("_net_before"), F.col("_total0")),
            "_peak": F.greatest(F.col("_start") + F.col("_best"), F.col("_peak0")),
        }
    )
    total, peak = F.col("total").cast("double"), F.col("_peak").cast("double")
    return rows.withColumns(
        {
            "returns": change_ratio(F.col("total"), F.col("_previous")),
            "drawdown": (total - peak) / peak,
        }
    ).drop(
        BLOCK, "_spent", "_sum", "_net", "_net_before", "_best", "_starts", "_start", "_total0", "_peak0", "_previous", "_peak"
    )


def _local(signalled: DataFrame, series: Series, labels: Sequence[str]) -> DataFrame:
    """Each path inside its block, as if it began there with nothing: money spent, holdings
    less that, the same of the row before, and its greatest value so far."""
    close = F.col("close_price")
    rows = signalled if BLOCK in signalled.columns else signalled.withColumn(BLOCK, series.block())
    rows = rows.withColumns(
        {
            "holdings": F.col("signal") * SHARES * close,
            "_spent": F.coalesce(F.col("positions") * SHARES * close, F.lit(0)),
        }
    )
    frame = Frame((*series.keys, BLOCK, *labels), series.order)
    rows = rows.withColumn("_sum", F.sum("_spent").over(frame.so_far))
    rows = rows.withColumn("_net", F.col("holdings") - F.col("_sum"))
    return rows.withColumns(
        {"_net_before": F.lag("_net").over(frame.window), "_best": F.max("_net").over(frame.so_far)}
    )


def _starts(rows: DataFrame, newest: Column, series: Series, labels: Sequence[str]) -> DataFrame:
    """What the paths of each block start from, by their labels: cash, and the total and the
    peak of the row before.

    One aggregate gives what a block adds to the money spent, its last holdings and its
    best value; a window over blocks, far fewer than rows, adds these up, and each block
    hands them to the next one that its series has, or else the newest.
    """
    ends = rows.filter(F.col(BLOCK) < newest).groupBy(*series.keys, BLOCK, *labels).agg(
        F.sum("_spent").alias("_all"),
        F.max("_net").alias("_top"),
        F.max_by("holdings", series.order).alias("_held"),
    )
    chain = Frame((*series.keys, *labels), BLOCK)
    ends = ends.withColumn("_cash", CAPITAL - F.coalesce(F.sum("_all").over(chain.before), F.lit(0)))
    after = F.struct(
        (F.col("_cash") - F.col("_all")).alias("cash"),
        (F.col("_cash") - F.col("_all") + F.col("_held")).alias("total"),
        F.max(F.col("_cash") + F.col("_top")).over(chain.so_far).alias("peak"),
    )
    following = F.coalesce(F.lead(BLOCK).over(chain.window), newest)
    ends = ends.select(*series.keys, following.alias(BLOCK), F.struct(F.struct(*labels), after).alias("_path"))
    return ends.groupBy(*series.keys, BLOCK).agg(F.map_from_entries(F.collect_list("_path")).alias("_starts"))


def _ratio(mean: Column, spread: Column) -> Column:
    """Annualised mean over spread; 0 unless the spread is a number above zero."""
    usable = (spread > 0) & ~F.isnan(spread)
    return F.when(usable, mean / spread * F.sqrt(F.lit(float(TRADING_DAYS)))).otherwise(0.0)


def metrics(paths: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Return, Sharpe, Sortino, drawdown, profit factor and trades of each path.

    One aggregate with partial sums: a path is never gathered in one place.
    """
    r = F.col("returns")
    total = F.col("total").cast("double")
    aggregated = paths.groupBy(*keys).agg(
        F.min_by(total, "trade_date").alias("_first"),
        F.max_by(total, "trade_date").alias("_last"),
        F.avg(r).alias("_mean"),
        F.stddev_samp(r).alias("_std"),
        F.stddev_samp(F.when(r < 0, r)).alias("_down"),
        F.coalesce(F.sum(F.when(r > 0, r)), F.lit(0.0)).alias("_gain"),
        F.abs(F.coalesce(F.sum(F.when(r < 0, r)), F.lit(0.0))).alias("_loss"),
        F.min("drawdown").alias("_depth"),
        F.sum(F.abs("positions")).alias("_moves"),
    )
    return aggregated.select(
        *keys,
        ((F.try_divide("_last", "_first") - 1) * 100).alias("total_return"),
        _ratio(F.col("_mean"), F.col("_std")).alias("sharpe_ratio"),
        F.floor(F.coalesce("_moves", F.lit(0)) / 2).cast("bigint").alias("num_trades"),
        (F.col("_depth") * 100).alias("max_drawdown"),
        _ratio(F.col("_mean"), F.col("_down")).alias("sortino_ratio"),
        F.when(F.col("_loss") > 0, F.col("_gain") / F.col("_loss"))
        .otherwise(F.lit(float("inf"))).alias("profit_factor"),
    )


def _paths(bars: DataFrame, series: Series, strategies: Sequence[Strategy]) -> DataFrame:
    """The paths of all strategies, a group of them at a time: a task has one block of a
    series, at most 31 bars a month, times the group's paths."""
    parts, newest = [], series.newest(bars)
    for first, group in groups(strategies):
        rows = portfolio(signal_paths(bars, series, group), series, (PATH,), newest)
        parts.append(rows.withColumn(PATH, F.col(PATH) + first))
    return reduce(DataFrame.unionByName, parts)


def paths(
    bars: DataFrame, series: Series, strategies: Sequence[Strategy] = DEFAULTS
) -> DataFrame:
    """The portfolio path of every ticker, strategy and parameter set."""
    return labelled(_paths(bars, series, strategies), strategies)


def report(
    bars: DataFrame, series: Series, strategies: Sequence[Strategy] = DEFAULTS
) -> DataFrame:
    """All metrics for every ticker, strategy and parameter set.

    Names are put on the report's rows, not carried through its windows.
    """
    rows = metrics(_paths(bars, series, strategies), (*series.keys, PATH))
    return labelled(rows, strategies)


def formatted(report: DataFrame) -> DataFrame:
    """Metrics as display text: two places, percent signs, N/A for no return."""
    percent = {"total_return": "%.2f%%", "max_drawdown": "%.2f%%"}
    plain = {"sharpe_ratio": "%.2f", "sortino_ratio": "%.2f", "profit_factor": "%.2f"}
    shown = {}
    for name, pattern in {**percent, **plain}.items():
        text = F.format_string(pattern, F.col(name))
        text = F.when(F.col(name) == float("inf"), "inf").otherwise(text)
        shown[name] = F.when(F.col(name).isNull(), "N/A").otherwise(text)
    return report.withColumns(shown)
