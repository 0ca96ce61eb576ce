"""Staging, enriched, joined and mart models."""

from pyspark.sql import functions as F

from barline import fixtures as fx
from barline.operators.rolling import add_columns, rolling_mean
from barline.operators.series import Series
from barline.plans import models, strategies
from barline.queries.registry import (
    BARS, CLOSES, ENRICHED, OPTIONS, STAGED, STAGED_OPTIONS, query, shown, with_sql,
)
from barline.sources.tables import mart_rows

STAGED_SHOWN = (
    "stock_bar_id ticker trade_date:d loaded_at:t open_price:n high_price:n low_price:n close_price:n"
    " volume_weighted_average_price:n volume transactions"
)
ENRICHED_SHOWN = (
    STAGED_SHOWN + " moving_avg_20d:n moving_avg_50d:n moving_avg_120d:n price_change_1d:n daily_price_range:n"
)
MART_SHOWN = (
    "stock_bar_id ticker trade_date:d open_price:n high_price:n low_price:n close_price:n"
    " volume_weighted_average_price:n moving_avg_20d:n moving_avg_50d:n price_change_1d:n daily_price_range:n"
    " volume transactions"
)
OPTION_SHOWN = (
    "option_bar_id option_symbol underlying_ticker trade_date:d expiration_date:d strike_price:n option_type"
    " open_price:n high_price:n low_price:n close_price:n volume volume_weighted_average_price:n transactions loaded_at:t"
)
JOINED = """joined AS (
  SELECT o.option_bar_id, o.option_symbol, o.underlying_ticker, o.trade_date, o.expiration_date, o.strike_price, o.option_type,
    o.open_price AS option_open, o.high_price AS option_high, o.low_price AS option_low, o.close_price AS option_close,
    o.volume_weighted_average_price AS option_vwap, o.volume AS option_volume, o.transactions AS option_transactions,
    date_diff('day', o.trade_date, o.expiration_date) AS days_to_expiration, s.close_price AS underlying_close_price,
    s.moving_avg_20d AS underlying_moving_avg_20d, s.moving_avg_50d AS underlying_moving_avg_50d,
    s.moving_avg_120d AS underlying_moving_avg_120d,
    CASE WHEN o.strike_price = s.close_price THEN 'at-the-money'
      WHEN (o.option_type = 'call' AND o.strike_price < s.close_price) OR (o.option_type = 'put' AND o.strike_price > s.close_price)
      THEN 'in-the-money' ELSE 'out-of-the-money' END AS moneyness
  FROM staged_options o LEFT JOIN enriched s ON o.underlying_ticker = s.ticker AND o.trade_date = s.trade_date)"""


def enriched_stock(spark, sf_dir):
    return models.enrich_stock_bars(fx.staged_stock(spark, sf_dir), Series())


def mart(spark, sf_dir):
    return models.stock_performance(enriched_stock(spark, sf_dir))


def closes(spark, sf_dir):
    """The bars strategies run on, and how to window them."""
    staged = fx.staged_stock(spark, sf_dir)
    series = Series()
    table = models.stock_performance(models.enrich_stock_bars(staged, series))
    return strategies.trading_bars(table), series


@query("stg_stock_bars", with_sql(BARS, STAGED, f"SELECT {shown(STAGED_SHOWN)} FROM staged"))
def stg_stock_bars(spark, sf_dir):
    return fx.staged_stock(spark, sf_dir)


@query("stg_option_bars", with_sql(OPTIONS, STAGED_OPTIONS, f"SELECT {shown(OPTION_SHOWN)} FROM staged_options"))
def stg_option_bars(spark, sf_dir):
    return fx.staged_options(spark, sf_dir)


@query("enriched_bars", with_sql(BARS, STAGED, ENRICHED, f"SELECT {shown(ENRICHED_SHOWN)} FROM enriched"))
def enriched_bars(spark, sf_dir):
    return enriched_stock(spark, sf_dir)


@query("enriched_bars_split", with_sql(BARS, STAGED, ENRICHED, f"SELECT {shown(ENRICHED_SHOWN)} FROM enriched"))
def enriched_bars_split(spark, sf_dir):
    """The same table in blocks of two years, which carry over what reaches across."""
    return models.enrich_stock_bars(fx.staged_stock(spark, sf_dir), Series(months=24))


@query("enriched_options", with_sql(OPTIONS, STAGED_OPTIONS, f"""
    SELECT {shown(OPTION_SHOWN)}, date_diff('day', trade_date, expiration_date) AS days_to_expiration FROM staged_options"""))
def enriched_options(spark, sf_dir):
    return models.enrich_option_bars(fx.staged_options(spark, sf_dir))


@query("options_stocks_join", with_sql(BARS, STAGED, ENRICHED, OPTIONS, STAGED_OPTIONS, JOINED, "SELECT " + shown(
    "option_bar_id option_symbol underlying_ticker trade_date:d expiration_date:d strike_price:n option_type option_open:n"
    " option_high:n option_low:n option_close:n option_vwap:n option_volume option_transactions days_to_expiration"
    " underlying_close_price:n underlying_moving_avg_20d:n underlying_moving_avg_50d:n underlying_moving_avg_120d:n moneyness"
) + " FROM joined"))
def options_stocks_join(spark, sf_dir):
    options = models.enrich_option_bars(fx.staged_options(spark, sf_dir))
    return models.join_options_to_stocks(options, enriched_stock(spark, sf_dir))


@query("moneyness", with_sql(BARS, STAGED, ENRICHED, OPTIONS, STAGED_OPTIONS, JOINED, """
    SELECT option_type, moneyness, count(*) AS n, CAST(sum(option_volume) AS BIGINT) AS volume FROM joined GROUP BY 1, 2"""))
def moneyness(spark, sf_dir):
    joined = options_stocks_join(spark, sf_dir)
    return joined.groupBy("option_type", "moneyness").agg(
        F.count("*").alias("n"), F.sum("option_volume").alias("volume")
    )


@query("fct_stock_performance", with_sql(BARS, STAGED, ENRICHED, f"SELECT {shown(MART_SHOWN)} FROM enriched"))
def fct_stock_performance(spark, sf_dir):
    return mart(spark, sf_dir)


@query("mart_scan", with_sql(BARS, STAGED, ENRICHED, f"SELECT {shown(MART_SHOWN)} FROM enriched ORDER BY enriched.trade_date, ticker"))
def mart_scan(spark, sf_dir):
    return mart_rows(mart(spark, sf_dir))


@query("ticker_filter", with_sql(BARS, STAGED, ENRICHED, f"SELECT {shown(MART_SHOWN)} FROM enriched WHERE ticker = 'BUILDING'"))
def ticker_filter(spark, sf_dir):
    return mart(spark, sf_dir).filter(F.col("ticker") == "BUILDING")


@query("date_slice", with_sql(BARS, CLOSES, f"""
    SELECT ticker, {shown('trade_date:d close_price:n')}, round(CAST(avg(close_price) OVER (PARTITION BY ticker ORDER BY closes.trade_date
      ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS DOUBLE), 6) + 0.0 AS ma_20
    FROM closes WHERE closes.trade_date BETWEEN DATE '1997-01-01' AND DATE '1998-12-31'"""))
def date_slice(spark, sf_dir):
    """A mean over two years: warm-up starts over on the first day of the slice."""
    staged = fx.staged_stock(spark, sf_dir)
    series = Series()
    table = models.stock_performance(models.enrich_stock_bars(staged, series))
    bars = strategies.trading_bars(table, "1997-01-01", "1998-12-31").drop("volume")
    price = F.col("close_price").cast("double")
    return add_columns(bars, series, 19, lambda f: {"ma_20": rolling_mean(price, f, 20)})
