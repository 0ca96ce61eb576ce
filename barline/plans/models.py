"""Staging, enriched, joined and mart tables as functions of DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barline.functions.dates import days_to_expiration
from barline.functions.keys import bar_id
from barline.functions.prices import moneyness, round_price
from barline.operators.history import current
from barline.operators.rolling import with_rolling_sums
from barline.operators.series import POS, Frame, Series, over_series

# Rows before the current one that an enriched bar depends on.
ENRICHED_LOOKBACK = 119
AVERAGES = {"moving_avg_20d": 20, "moving_avg_50d": 50, "moving_avg_120d": 120}
AVERAGE_TYPE = "decimal(23,8)"  # what an average of prices has
ROUNDED = (
    "open_price", "high_price", "low_price", "close_price",
    "volume_weighted_average_price", *AVERAGES,
)
PRICES = {
    "open": "open_price", "high": "high_price", "low": "low_price", "close": "close_price",
    "vwap": "volume_weighted_average_price",
}


def _renamed(*names: str):
    return [F.col(n).alias(PRICES.get(n, n)) for n in names]


def stage_stock_bars(history: DataFrame) -> DataFrame:
    """Current versions of the stock bars under their model names."""
    return current(history).select(
        bar_id(F.col("ticker"), F.col("trade_date")).alias("stock_bar_id"),
        "ticker", "trade_date", F.col("inserted_at").alias("loaded_at"),
        *_renamed("open", "high", "low", "close", "vwap"),
        "volume", "transactions",
    )


def stage_option_bars(history: DataFrame) -> DataFrame:
    """Current versions of the option bars under their model names."""
    return current(history).select(
        bar_id(F.col("option_symbol"), F.col("trade_date")).alias("option_bar_id"),
        "option_symbol", "underlying_ticker", "trade_date", "expiration_date",
        "strike_price", "option_type",
        *_renamed("open", "high", "low", "close"),
        "volume", *_renamed("vwap"), "transactions", F.col("inserted_at").alias("loaded_at"),
    )


def with_averages(df: DataFrame, frame: Frame) -> DataFrame:
    """Moving averages, change and range, all from unrounded prices."""
    close = F.col("close_price")
    sums = {f"_sum_{name}": ("close_price", rows) for name, rows in AVERAGES.items()}
    counts = {f"_n_{name}": ("_has_close", rows) for name, rows in AVERAGES.items()}
    df = df.withColumns(
        {
            "price_change_1d": close - F.lag(close).over(frame.window),
            "daily_price_range": F.col("high_price") - F.col("low_price"),
            "_has_close": F.when(close.isNotNull(), 1).otherwise(0),
        }
    )
    df = with_rolling_sums(df, frame, sums | counts)
    means = {
        name: F.try_divide(F.col(f"_sum_{name}"), F.col(f"_n_{name}")).cast(AVERAGE_TYPE)
        for name in AVERAGES
    }
    return df.withColumns(means).drop("_has_close", *sums, *counts)


def enrich_stock_bars(staged: DataFrame, series: Series) -> DataFrame:
    """Moving averages over 20, 50 and 120 rows, change and range per ticker."""
    measured = over_series(staged, series, ENRICHED_LOOKBACK, with_averages, columns=["close_price"]).drop(POS)
    return measured.withColumns({c: round_price(F.col(c)) for c in ROUNDED}).select(
        "loaded_at", "stock_bar_id", "ticker", "trade_date", *ROUNDED,
        "price_change_1d", "daily_price_range", "volume", "transactions",
    )


def enrich_option_bars(staged: DataFrame) -> DataFrame:
    return staged.withColumn(
        "days_to_expiration", days_to_expiration(F.col("expiration_date"), F.col("trade_date"))
    )


def join_options_to_stocks(options: DataFrame, stocks: DataFrame) -> DataFrame:
    """Each option bar with its underlying's close and averages of the day.

    The stock side is unique on the join key, so the join never fans out. Its
    size decides between a broadcast and a sort-merge join at run time, and a
    hot underlying's partition is split by the adaptive skew join.
    """
    o, s = options.alias("o"), stocks.alias("s")
    same_day = (F.col("o.underlying_ticker") == F.col("s.ticker")) & (
        F.col("o.trade_date") == F.col("s.trade_date")
    )
    renamed = {
        "open_price": "option_open", "high_price": "option_high", "low_price": "option_low",
        "close_price": "option_close", "volume_weighted_average_price": "option_vwap",
        "volume": "option_volume", "transactions": "option_transactions",
    }
    return o.join(s, same_day, "left").select(
        *[F.col(f"o.{c}") for c in (
            "option_bar_id", "option_symbol", "underlying_ticker", "trade_date",
            "expiration_date", "strike_price", "option_type",
        )],
        *[F.col(f"o.{c}").alias(name) for c, name in renamed.items()],
        F.col("o.days_to_expiration"),
        F.col("s.close_price").alias("underlying_close_price"),
        *[F.col(f"s.{c}").alias(f"underlying_{c}") for c in AVERAGES],
        moneyness(
            F.col("o.strike_price"), F.col("o.option_type"), F.col("s.close_price")
        ).alias("moneyness"),
    )


def stock_performance(enriched: DataFrame) -> DataFrame:
    """The mart: 14 columns of the enriched bars."""
    return enriched.select(
        "stock_bar_id", "ticker", "trade_date", "open_price", "high_price", "low_price",
        "close_price", "volume_weighted_average_price", "moving_avg_20d", "moving_avg_50d",
        "price_change_1d", "daily_price_range", "volume", "transactions",
    )
