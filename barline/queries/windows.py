"""Window functions and indicators over the mart's closing prices."""

from pyspark.sql import functions as F

from barline import fixtures as fx
from barline.operators import rolling
from barline.operators.indicators import Indicators
from barline.operators.series import Series, over_series, running
from barline.plans import models
from barline.queries.models import closes
from barline.queries.registry import BARS, CLOSES, ENRICHED, STAGED, query, shown, with_sql

BY_DATE = "PARTITION BY ticker ORDER BY trade_date"
LABEL = "ticker, CAST(trade_date AS VARCHAR) AS trade_date"


def last_rows(n: int) -> str:
    return f"({BY_DATE} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def rounded(expression: str, name: str) -> str:
    return f"round(CAST({expression} AS DOUBLE), 6) + 0.0 AS {name}"


def ema_sql(x: str, span: float) -> str:
    """The recursion itself, over the list of all values so far."""
    a = 2.0 / (span + 1.0)
    return (
        f"list_reduce(list({x}) OVER ({BY_DATE} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),"
        f" lambda acc, v: CAST({a!r} AS DOUBLE) * v + CAST({1.0 - a!r} AS DOUBLE) * acc)"
    )


def rsi_sql(name: str, window: int, source: str = "closes") -> str:
    return f"""{name}_moves AS (
  SELECT *, CASE WHEN pos = 1 THEN 0 ELSE close_price - lag(close_price) OVER ({BY_DATE}) END AS move FROM {source}),
{name} AS (
  SELECT * EXCLUDE (g, l), CASE WHEN pos >= {window} THEN
      CASE WHEN l > 0 THEN 100 - 100 / (1 + CAST(g AS DOUBLE) / CAST(l AS DOUBLE)) WHEN g > 0 THEN 100.0 END END AS rsi
  FROM (SELECT *, sum(greatest(move, 0)) OVER {last_rows(window)} AS g,
      sum(greatest(-move, 0)) OVER {last_rows(window)} AS l FROM {name}_moves))"""


def macd_sql(name: str, short: int, long: int, signal: int) -> str:
    return f"""{name}_line AS (SELECT *, {ema_sql('x', short)} - {ema_sql('x', long)} AS macd FROM closes),
{name} AS (SELECT *, {ema_sql('macd', signal)} AS signal_line FROM {name}_line)"""


def bands_sql(name: str, window: int, width: float) -> str:
    last = last_rows(window)
    return f"""{name} AS (
  SELECT *, CASE WHEN pos >= {window} THEN CASE WHEN flat THEN x ELSE mean + {width} * spread END END AS upper_band,
    CASE WHEN pos >= {window} THEN CASE WHEN flat THEN x ELSE mean - {width} * spread END END AS lower_band
  FROM (SELECT *, avg(x) OVER {last} AS mean, stddev_samp(x) OVER {last} AS spread,
      min(x) OVER {last} = max(x) OVER {last} AS flat FROM closes))"""


def with_price(spark, sf_dir):
    bars, series = closes(spark, sf_dir)
    return bars.drop("volume").withColumn("x", F.col("close_price").cast("double")), series


def indicated(spark, sf_dir, ind, columns):
    bars, series = closes(spark, sf_dir)
    added = over_series(bars, series, ind.lookback, ind.add, ind.carried)
    return added.select("ticker", "trade_date", *[c.alias(name) for name, c in columns.items()])


@query("sma", with_sql(BARS, STAGED, ENRICHED, f"SELECT {shown('ticker trade_date:d moving_avg_20d:n moving_avg_50d:n moving_avg_120d:n')} FROM enriched"))
def sma(spark, sf_dir):
    staged = fx.staged_stock(spark, sf_dir)
    enriched = models.enrich_stock_bars(staged, Series())
    return enriched.select("ticker", "trade_date", *models.AVERAGES)


@query("price_change", with_sql(BARS, STAGED, ENRICHED, f"SELECT {shown('ticker trade_date:d price_change_1d:n')} FROM enriched"))
def price_change(spark, sf_dir):
    staged = fx.staged_stock(spark, sf_dir)
    enriched = models.enrich_stock_bars(staged, Series())
    return enriched.select("ticker", "trade_date", "price_change_1d")


@query("rolling_mean", with_sql(BARS, CLOSES, f"SELECT {LABEL}, {rounded(f'avg(x) OVER {last_rows(30)}', 'mean_30')} FROM closes"))
def rolling_mean(spark, sf_dir):
    bars, series = with_price(spark, sf_dir)
    added = rolling.add_columns(bars, series, 29, lambda f: {"mean_30": rolling.rolling_mean(F.col("x"), f, 30)})
    return added.select("ticker", "trade_date", "mean_30")


@query("rolling_mean_full", with_sql(BARS, CLOSES, f"""
    SELECT {LABEL}, CASE WHEN pos >= 30 THEN {rounded(f'avg(x) OVER {last_rows(30)}', 'y')[:-len(' AS y')]} END AS mean_30 FROM closes"""))
def rolling_mean_full(spark, sf_dir):
    bars, series = with_price(spark, sf_dir)
    added = rolling.add_columns(bars, series, 29, lambda f: {"mean_30": rolling.rolling_mean_full(F.col("x"), f, 30)})
    return added.select("ticker", "trade_date", "mean_30")


@query("rolling_std", with_sql(BARS, CLOSES, f"""
    SELECT {LABEL}, CASE WHEN pos >= 20 THEN {rounded(f'stddev_samp(x) OVER {last_rows(20)}', 'y')[:-len(' AS y')]} END AS std_20 FROM closes"""))
def rolling_std(spark, sf_dir):
    bars, series = with_price(spark, sf_dir)
    added = rolling.add_columns(bars, series, 19, lambda f: {"std_20": rolling.rolling_std_full(F.col("x"), f, 20)})
    return added.select("ticker", "trade_date", "std_20")


@query("bollinger", with_sql(BARS, CLOSES, bands_sql("bands", 20, 2.0), f"SELECT {LABEL}, {shown('upper_band:r lower_band:r')} FROM bands"))
def bollinger(spark, sf_dir):
    upper, lower = (ind := Indicators()).bollinger(20, 2.0)
    return indicated(spark, sf_dir, ind, {"upper_band": upper, "lower_band": lower})


@query("ema", with_sql(BARS, CLOSES, f"SELECT {LABEL}, {rounded(ema_sql('x', 12), 'ema_12')}, {rounded(ema_sql('x', 26), 'ema_26')} FROM closes"))
def ema(spark, sf_dir):
    bars, series = with_price(spark, sf_dir)

    averages = rolling.Averages("x")
    shown_as = {averages.average(span): f"ema_{span}" for span in (12, 26)}
    added = over_series(bars, series, 1, averages.add, averages)
    return added.select("ticker", "trade_date", *(F.col(c).alias(name) for c, name in shown_as.items()))


@query("diff", with_sql(BARS, CLOSES, f"SELECT {LABEL}, CAST(close_price - lag(close_price) OVER ({BY_DATE}) AS DOUBLE) AS change FROM closes"))
def diff(spark, sf_dir):
    bars, series = with_price(spark, sf_dir)
    added = rolling.add_columns(bars, series, 1, lambda f: {"change": rolling.difference(F.col("close_price"), f)})
    return added.select("ticker", "trade_date", "change")


@query("returns", with_sql(BARS, CLOSES, f"SELECT {LABEL}, {rounded(f'x / lag(x) OVER ({BY_DATE}) - 1', 'returns')} FROM closes"))
def returns(spark, sf_dir):
    bars, series = with_price(spark, sf_dir)
    added = rolling.add_columns(bars, series, 1, lambda f: {"returns": rolling.percent_change(F.col("x"), f)})
    return added.select("ticker", "trade_date", "returns")


@query("drawdown", with_sql(BARS, CLOSES, f"SELECT {LABEL}, {rounded(f'(x - max(x) OVER ({BY_DATE})) / max(x) OVER ({BY_DATE})', 'drawdown')} FROM closes"))
def drawdown(spark, sf_dir):
    """How far each close lies under the highest close so far; not a number while that is zero,
    and minus infinity below zero then."""
    bars, series = with_price(spark, sf_dir)
    peaked = running(bars, series, "x", "max", "peak")
    x, peak = F.col("x"), F.col("peak")
    from_zero = F.when(x < 0, F.lit(float("-inf"))).otherwise(F.lit(float("nan")))
    fall = F.when(peak == 0, from_zero).otherwise((x - peak) / peak)
    return peaked.select("ticker", "trade_date", fall.alias("drawdown"))


@query("running_sum", with_sql(BARS, CLOSES, f"SELECT {LABEL}, CAST(sum(volume) OVER ({BY_DATE}) AS BIGINT) AS volume_so_far FROM closes"))
def running_sum(spark, sf_dir):
    bars, series = closes(spark, sf_dir)
    return running(bars, series, "volume", "sum", "volume_so_far").select("ticker", "trade_date", "volume_so_far")


@query("ffill", with_sql(BARS, CLOSES, f"""
    SELECT {LABEL}, last_value(busy IGNORE NULLS) OVER ({BY_DATE}) AS last_busy_close
    FROM (SELECT *, CASE WHEN volume > 300 THEN x END AS busy FROM closes)"""))
def ffill(spark, sf_dir):
    """The close of the last busy day, carried over quiet ones."""
    bars, series = closes(spark, sf_dir)
    busy = F.when(F.col("volume") > 300, F.col("close_price").cast("double"))
    filled = running(bars.withColumn("busy", busy), series, "busy", "ffill", "last_busy_close")
    return filled.select("ticker", "trade_date", "last_busy_close")


@query("rsi", with_sql(BARS, CLOSES, rsi_sql("strength", 14), f"SELECT {LABEL}, {shown('rsi:r')} FROM strength"))
def rsi(spark, sf_dir):
    rsi_14 = (ind := Indicators()).rsi(14)
    return indicated(spark, sf_dir, ind, {"rsi": rsi_14})


@query("macd", with_sql(BARS, CLOSES, macd_sql("lines", 12, 26, 9), f"SELECT {LABEL}, {shown('macd:r signal_line:r')} FROM lines"))
def macd(spark, sf_dir):
    line, signal_line = (ind := Indicators()).macd(12, 26, 9)
    return indicated(spark, sf_dir, ind, {"macd": line, "signal_line": signal_line})
