"""Explicit schemas: nothing in this package infers one from data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PRICE = T.DecimalType(19, 4)

# --- JSON documents, as DDL for from_json -----------------------------------

BAR = "v double, vw double, o double, c double, h double, l double, t double, n double"
BAR_DOCUMENT = f"ticker string, resultsCount double, results array<struct<{BAR}>>"
GROUPED_DOCUMENT = (
    f"resultsCount double, request_id string, results array<struct<T string, {BAR}>>"
)
CONTRACT_PAGE = "results array<struct<ticker string>>, next_url string"
# Fields that arrive as one object or as a list are first read as JSON text.
HISTORY_DOCUMENT = "history struct<day string>"
HISTORY_DAY = (
    "date string, open double, high double, low double, close double,"
    " volume double, vwap double"
)
EXPIRATIONS_DOCUMENT = "expirations struct<date string>"
CHAIN_DOCUMENT = "options struct<option string>"
LOOKUP_DOCUMENT = "securities struct<security string>"
SYMBOL_ENTRY = "symbol string"
RUN_ARTIFACT = (
    "metadata struct<generated_at string>,"
    " results array<struct<unique_id string, status string, failures int,"
    " execution_time double>>"
)


# --- Tables -------------------------------------------------------------------

def _table(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


_MEASURES = tuple((n, PRICE, True) for n in ("open", "high", "low", "close"))
_CONTRACT = (
    ("underlying_ticker", T.StringType(), True),
    ("expiration_date", T.DateType(), True),
    ("strike_price", PRICE, True),
    ("option_type", T.StringType(), True),
)
_INSERTED = (("inserted_at", T.TimestampType(), False),)
_VOLUME = (("volume", T.LongType(), True), ("vwap", PRICE, True))
_TRADES = (("transactions", T.LongType(), True),)

STOCK_KEY = ("ticker", "trade_date")
OPTION_KEY = ("option_symbol", "trade_date")


def _key(names: tuple[str, str]) -> tuple:
    return ((names[0], T.StringType(), False), (names[1], T.DateType(), False))


STOCK_BARS = _table(*_key(STOCK_KEY), *_MEASURES, *_VOLUME, *_TRADES, *_INSERTED)
OPTION_BARS = _table(
    *_key(OPTION_KEY), *_CONTRACT, *_MEASURES, *_VOLUME, *_TRADES, *_INSERTED
)
BROKER_STOCK_BARS = _table(*_key(STOCK_KEY), *_MEASURES, *_VOLUME, *_INSERTED)
BROKER_OPTION_BARS = _table(
    *_key(OPTION_KEY), *_CONTRACT, *_MEASURES, *_VOLUME, *_INSERTED
)
TEST_RESULTS = _table(
    ("test_id", T.StringType(), False),
    ("test_name", T.StringType(), True),
    ("status", T.StringType(), True),
    ("failures", T.IntegerType(), True),
    ("execution_time", T.DoubleType(), True),
    ("run_generated_at", T.TimestampType(), True),
    ("loaded_at", T.TimestampType(), True),
)
SEED_COMPANIES = "ticker string, company_name string, sector string"
SEED_TICKERS = "ticker string"


def stored(column: Column, kind: T.DataType) -> Column:
    """Cast the way a typed column takes a JSON number.

    Whole-number columns round (a bare cast would cut off the fraction), and
    decimals round half away from zero at their own scale.
    """
    if isinstance(kind, T.LongType):
        return F.round(column).cast(kind)
    return column.cast(kind)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns from ``df``, each cast to its stored type."""
    present = [f for f in schema.fields if f.name in df.columns]
    return df.select(*[stored(F.col(f.name), f.dataType).alias(f.name) for f in present])
