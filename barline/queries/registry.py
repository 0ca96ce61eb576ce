"""Registration of queries, and the shared shape of their results and SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barline.session import bounded

QueryFunction = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: QueryFunction
    sql: str | None


REGISTRY: dict[str, Query] = {}


MAY_BE_MISSING = ("positions",)


def presented(df: DataFrame) -> DataFrame:
    """Plain output types: text for dates and times, doubles for numbers with a scale,
    and for whole ones that may be missing; long integers otherwise."""
    columns = []
    for field in df.schema.fields:
        c, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, T.DecimalType):
            c = c.cast("double")
        elif isinstance(kind, T.DoubleType):
            c = F.round(c, 6) + F.lit(0.0)
        elif isinstance(kind, T.IntegerType):
            c = c.cast("double" if field.name in MAY_BE_MISSING else "bigint")
        elif isinstance(kind, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(kind, T.TimestampType):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        columns.append(c.alias(field.name))
    return df.select(*columns)


def query(name: str, sql: str | None = None) -> Callable[[QueryFunction], QueryFunction]:
    """Register a query of (spark, sf_dir) with the SQL that checks it."""

    def register(function: QueryFunction) -> QueryFunction:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return presented(function(bounded(spark), sf_dir))

        REGISTRY[name] = Query(run, sql)
        return function

    return register


# --- SQL text ---------------------------------------------------------------------


def shown(columns: str) -> str:
    """A select list from ``name:kind`` words: d date, t time, n decimal, r double, i integer."""
    forms = {
        "": "{0}",
        "d": "CAST({0} AS VARCHAR) AS {0}",
        "t": "strftime({0}, '%Y-%m-%d %H:%M:%S') AS {0}",
        "n": "CAST({0} AS DOUBLE) AS {0}",
        "i": "CAST({0} AS BIGINT) AS {0}",
        "r": "round(CAST({0} AS DOUBLE), 6) + 0.0 AS {0}",
    }
    parts = []
    for word in columns.split():
        name, _, kind = word.partition(":")
        parts.append(forms[kind].format(name))
    return ", ".join(parts)


def bars_sql(name: str, order_filter: str = "true", event_filter: str = "true") -> str:
    return f"""{name} AS (
  SELECT ticker, trade_date,
    CAST(open / scale AS DECIMAL(19,4)) AS open, CAST(high / scale AS DECIMAL(19,4)) AS high,
    CAST(low / scale AS DECIMAL(19,4)) AS low, CAST(close / scale AS DECIMAL(19,4)) AS close,
    volume, CAST((spent // volume) / scale AS DECIMAL(19,4)) AS vwap, transactions
  FROM (
    SELECT c_mktsegment AS ticker, CAST(o_orderdate AS DATE) AS trade_date, 10000 AS scale,
      floor(min_by(o_totalprice, o_orderkey)) AS open, floor(max(o_totalprice)) AS high,
      floor(min(o_totalprice)) AS low, floor(max_by(o_totalprice, o_orderkey)) AS close,
      CAST(sum(CAST(floor(o_totalprice / 1000) AS BIGINT) + 1) AS BIGINT) AS volume,
      CAST(sum(CAST(floor(o_totalprice) AS BIGINT) * (CAST(floor(o_totalprice / 1000) AS BIGINT) + 1)) AS BIGINT) AS spent,
      count(*) AS transactions
    FROM orders JOIN customer ON o_custkey = c_custkey WHERE {order_filter} GROUP BY 1, 2
    UNION ALL
    SELECT 'U' || user_id, CAST(ts AS DATE), 100,
      min_by(cents, event_id), max(cents), min(cents), max_by(cents, event_id),
      CAST(sum(size) AS BIGINT), CAST(sum(CAST(cents AS BIGINT) * size) AS BIGINT), count(*)
    FROM (SELECT *, round(value * 100) AS cents,
            1 + coalesce(CAST(json_extract_string(props, '$.k') AS BIGINT), 0) AS size FROM events)
    WHERE {event_filter} GROUP BY 1, 2))"""


BARS = bars_sql("bars")
FIXES = bars_sql("fixes", "o_orderpriority = '1-URGENT'", "event_type = 'purchase'")
OPTIONS = """options AS (
  SELECT 'O:' || underlying_ticker || strftime(expiration_date, '%y%m%d')
      || CASE option_type WHEN 'call' THEN 'C' ELSE 'P' END || lpad(CAST(strike * 1000 AS VARCHAR), 8, '0') AS option_symbol,
    trade_date, underlying_ticker, expiration_date, CAST(strike AS DECIMAL(19,4)) AS strike_price, option_type,
    CAST(floor(o) / 10000 AS DECIMAL(19,4)) AS open, CAST(floor(h) / 10000 AS DECIMAL(19,4)) AS high,
    CAST(floor(l) / 10000 AS DECIMAL(19,4)) AS low, CAST(floor(c) / 10000 AS DECIMAL(19,4)) AS close,
    volume, CAST((spent // volume) / 10000 AS DECIMAL(19,4)) AS vwap, transactions
  FROM (
    SELECT c_mktsegment AS underlying_ticker, CAST(l_shipdate AS DATE) AS trade_date,
      CAST(o_orderdate AS DATE) AS expiration_date, CAST(floor(o_totalprice / 10000) AS INTEGER) AS strike,
      CASE WHEN l_linestatus = 'O' THEN 'call' ELSE 'put' END AS option_type,
      first(l_extendedprice ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS o,
      max(l_extendedprice) AS h, min(l_extendedprice) AS l,
      last(l_extendedprice ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS c,
      CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS volume,
      CAST(sum(CAST(floor(l_extendedprice) AS BIGINT) * CAST(l_quantity AS BIGINT)) AS BIGINT) AS spent,
      count(*) AS transactions
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    GROUP BY 1, 2, 3, 4, 5))"""
STAGED = """staged AS (
  SELECT ticker || '_' || CAST(trade_date AS VARCHAR) AS stock_bar_id, ticker, trade_date,
    TIMESTAMP '2024-06-01 00:00:00' AS loaded_at, open AS open_price, high AS high_price, low AS low_price,
    close AS close_price, vwap AS volume_weighted_average_price, volume, transactions FROM bars)"""
STAGED_OPTIONS = """staged_options AS (
  SELECT option_symbol || '_' || CAST(trade_date AS VARCHAR) AS option_bar_id, option_symbol, underlying_ticker,
    trade_date, expiration_date, strike_price, option_type, open AS open_price, high AS high_price,
    low AS low_price, close AS close_price, volume, vwap AS volume_weighted_average_price, transactions,
    TIMESTAMP '2024-06-01 00:00:00' AS loaded_at FROM options)"""
ROUNDED = (
    "open_price", "high_price", "low_price", "close_price", "volume_weighted_average_price",
    "moving_avg_20d", "moving_avg_50d", "moving_avg_120d",
)


def enriched_sql(name: str = "enriched", source: str = "staged") -> str:
    rounded = ", ".join(
        f"CASE WHEN {c} >= 1 THEN round({c}, 2) ELSE round({c}, 4) END AS {c}" for c in ROUNDED
    )
    averages = ", ".join(
        f"CAST(avg(close_price) OVER (PARTITION BY ticker ORDER BY trade_date ROWS BETWEEN {n - 1} PRECEDING"
        f" AND CURRENT ROW) AS DECIMAL(23,8)) AS moving_avg_{n}d"
        for n in (20, 50, 120)
    )
    return f"""{name} AS (
  SELECT loaded_at, stock_bar_id, ticker, trade_date, {rounded}, price_change_1d, daily_price_range, volume, transactions
  FROM (SELECT *, {averages},
      close_price - lag(close_price) OVER (PARTITION BY ticker ORDER BY trade_date) AS price_change_1d,
      high_price - low_price AS daily_price_range FROM {source}))"""


ENRICHED = enriched_sql()
# The mart columns that strategies read.
CLOSES = """closes AS (
  SELECT ticker, trade_date, volume,
    CASE WHEN close >= 1 THEN round(close, 2) ELSE round(close, 4) END AS close_price,
    CAST(CASE WHEN close >= 1 THEN round(close, 2) ELSE round(close, 4) END AS DOUBLE) AS x,
    row_number() OVER (PARTITION BY ticker ORDER BY trade_date) AS pos
  FROM bars WHERE close IS NOT NULL)"""


def with_sql(*parts: str) -> str:
    """A statement from common table expressions and a final select."""
    *ctes, select = parts
    return f"WITH {', '.join(ctes)} {select}" if ctes else select
