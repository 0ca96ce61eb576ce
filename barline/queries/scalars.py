"""Column functions over whole tables."""

from pyspark.sql import functions as F

from barline import fixtures as fx
from barline import schemas
from barline.functions import dates, keys, prices, shapes, symbols
from barline.queries.registry import BARS, OPTIONS, STAGED, query, shown, with_sql
from barline.sources.tables import date_bounds


def symbol_variants(spark, sf_dir):
    """Symbols as sent, bare with a suffix, with a dotted root and month 99, and plain words."""
    options = fx.option_bars(spark, sf_dir)
    sent = options.select(F.col("option_symbol").alias("symbol"))
    suffixed = options.select(F.concat(F.substring("option_symbol", 3, 100), F.lit("W")).alias("symbol"))
    impossible = options.select(
        F.concat("underlying_ticker", F.lit(".B259901P"), F.lpad((F.col("strike_price") * 1000).cast("int").cast("string"), 8, "0")).alias("symbol")
    )
    words = fx.table(spark, sf_dir, "part").select(F.col("p_name").alias("symbol"))
    return sent.unionAll(suffixed).unionAll(impossible).unionAll(words).distinct()


VARIANTS = """variants AS (
  SELECT option_symbol AS symbol FROM options UNION SELECT substr(option_symbol, 3) || 'W' FROM options
  UNION SELECT underlying_ticker || '.B259901P' || lpad(CAST(CAST(strike_price * 1000 AS INTEGER) AS VARCHAR), 8, '0') FROM options
  UNION SELECT p_name FROM part)"""


def _contract_sql(pattern: str) -> str:
    return with_sql(OPTIONS, VARIANTS, f"""
      SELECT symbol, CASE WHEN ok THEN regexp_extract(symbol, '{pattern}', 1) END AS underlying_ticker,
        CASE WHEN ok THEN strftime(try_strptime(regexp_extract(symbol, '{pattern}', 2), '%y%m%d'), '%Y-%m-%d') END AS expiration_date,
        CASE WHEN ok THEN CASE regexp_extract(symbol, '{pattern}', 3) WHEN 'C' THEN 'call' ELSE 'put' END END AS option_type,
        CASE WHEN ok THEN CAST(regexp_extract(symbol, '{pattern}', 4) AS INTEGER) / 1000.0 END AS strike_price
      FROM (SELECT symbol, regexp_matches(symbol, '{pattern}') AS ok FROM variants)""")


@query("parse_occ", _contract_sql(r"^(?:O:)?([A-Z.]+)(\d{6})([CP])(\d{8})"))
def parse_occ(spark, sf_dir):
    return symbols.with_contract(symbol_variants(spark, sf_dir), "symbol")


@query("parse_occ_plain", _contract_sql(r"^([A-Z]+)(\d{6})([CP])(\d{8})"))
def parse_occ_plain(spark, sf_dir):
    return symbols.with_contract(symbol_variants(spark, sf_dir), "symbol", symbols.BROKER_SYMBOL)


@query("expiry_date", with_sql(OPTIONS, """
    SELECT DISTINCT digits, strftime(try_strptime(digits, '%y%m%d'), '%Y-%m-%d') AS expiration_date FROM (
      SELECT strftime(expiration_date, '%y%m%d') AS digits FROM options
      UNION ALL SELECT strftime(expiration_date, '%y%d%m') FROM options)"""))
def expiry_date(spark, sf_dir):
    options = fx.option_bars(spark, sf_dir)
    right = options.select(F.date_format("expiration_date", "yyMMdd").alias("digits"))
    swapped = options.select(F.date_format("expiration_date", "yyddMM").alias("digits"))
    digits = right.unionAll(swapped).distinct()
    return digits.withColumn("expiration_date", symbols.expiry(F.col("digits")))


@query("epoch_date", "SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS trade_date FROM events")
def epoch_date(spark, sf_dir):
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return fx.table(spark, sf_dir, "events").select("event_id", dates.utc_date(ms).alias("trade_date"))


@query("bar_id", with_sql(BARS, STAGED, f"SELECT stock_bar_id, ticker, {shown('trade_date:d')} FROM staged"))
def bar_id(spark, sf_dir):
    identity = keys.bar_id(F.col("ticker"), F.col("trade_date")).alias("stock_bar_id")
    return fx.stock_bars(spark, sf_dir).select(identity, "ticker", "trade_date")


@query("days_to_expiration", with_sql(OPTIONS, f"""
    SELECT option_symbol, {shown('trade_date:d')}, date_diff('day', trade_date, expiration_date) AS days_to_expiration FROM options"""))
def days_to_expiration(spark, sf_dir):
    left = dates.days_to_expiration(F.col("expiration_date"), F.col("trade_date"))
    return fx.option_bars(spark, sf_dir).select("option_symbol", "trade_date", left.alias("days_to_expiration"))


@query("price_round", with_sql(BARS, "SELECT ticker, CAST(trade_date AS VARCHAR) AS trade_date, " + ", ".join(
    f"CAST(CASE WHEN {c} >= 1 THEN round({c}, 2) ELSE round({c}, 4) END AS DOUBLE) AS {c}" for c in ("open", "high", "low", "close", "vwap")
) + " FROM bars"))
def price_round(spark, sf_dir):
    columns = ("open", "high", "low", "close", "vwap")
    rounded = [prices.round_price(F.col(c)).alias(c) for c in columns]
    return fx.stock_bars(spark, sf_dir).select("ticker", "trade_date", *rounded)


@query("daily_range", with_sql(BARS, f"""
    SELECT ticker, {shown('trade_date:d')}, CAST(high - low AS DOUBLE) AS daily_price_range FROM bars"""))
def daily_range(spark, sf_dir):
    spread = (F.col("high") - F.col("low")).alias("daily_price_range")
    return fx.stock_bars(spark, sf_dir).select("ticker", "trade_date", spread)


@query("typed_cast", f"""
    SELECT event_id, CAST(value AS DECIMAL(19,4))::DOUBLE AS close, CAST(round(value) AS BIGINT) AS volume,
      strftime(ts, '%Y-%m-%d %H:%M:%S') AS inserted_at, CAST(CAST(ts AS DATE) AS VARCHAR) AS trade_date FROM events""")
def typed_cast(spark, sf_dir):
    kinds = {f.name: f.dataType for f in schemas.STOCK_BARS.fields}
    raw = {"close": F.col("value"), "volume": F.col("value"), "inserted_at": F.col("ts"), "trade_date": F.col("ts")}
    stored = [schemas.stored(c, kinds[n]).alias(n) for n, c in raw.items()]
    return fx.table(spark, sf_dir, "events").select("event_id", *stored)


@query("last_segment", """
    SELECT event_id, event_type || '_u' || user_id AS test_name FROM events""")
def last_segment(spark, sf_dir):
    dotted = F.concat(F.lit("test.bars."), "event_type", F.lit("_u"), F.col("user_id").cast("string"))
    return fx.table(spark, sf_dir, "events").select("event_id", keys.last_segment(dotted).alias("test_name"))


@query("path_rewrite", with_sql(BARS, STAGED, """
    SELECT 'raw_data/raw_data/' || stock_bar_id || '.json' AS key,
      'processed/raw_data/' || stock_bar_id || '.json' AS moved_key FROM staged"""))
def path_rewrite(spark, sf_dir):
    key = F.concat(F.lit("raw_data/raw_data/"), "stock_bar_id", F.lit(".json"))
    staged = fx.staged_stock(spark, sf_dir).select(key.alias("key"))
    return staged.withColumn("moved_key", keys.moved(F.col("key"), "raw_data/", "processed/"))


@query("trading_calendar", with_sql(BARS, """
    SELECT CAST(CAST(d AS DATE) AS VARCHAR) AS trade_date FROM (
      SELECT unnest(generate_series(CAST(min(trade_date) AS TIMESTAMP), CAST(max(trade_date) AS TIMESTAMP), INTERVAL 1 DAY)) AS d FROM bars)
    WHERE isodow(d) < 6"""))
def trading_calendar(spark, sf_dir):
    bounds = date_bounds(fx.stock_bars(spark, sf_dir))
    return bounds.select(F.explode(dates.weekdays(F.col("min_date"), F.col("max_date"))).alias("trade_date"))


@query("target_date", with_sql(BARS, """
    SELECT DISTINCT CAST(trade_date AS VARCHAR) AS run_date, CAST(trade_date - 1 AS VARCHAR) AS target_date,
      CAST(trade_date - CASE isodow(trade_date) WHEN 1 THEN 3 WHEN 7 THEN 2 ELSE 1 END AS VARCHAR) AS previous_weekday FROM bars"""))
def target_date(spark, sf_dir):
    runs = fx.stock_bars(spark, sf_dir).select(F.col("trade_date").alias("run_date")).distinct()
    return runs.select(
        "run_date", dates.target_date(F.col("run_date")).alias("target_date"),
        dates.target_date(F.col("run_date"), previous_weekday=True).alias("previous_weekday"),
    )


@query("flatten_lists", with_sql(BARS, STAGED, """
    SELECT ticker, year(trade_date) AS year, stock_bar_id AS key FROM staged WHERE transactions > 1"""))
def flatten_lists(spark, sf_dir):
    """Lists of keys per month inside lists per year, at most 366 keys each."""
    staged = fx.staged_stock(spark, sf_dir).select(
        "ticker", F.year("trade_date").alias("year"), F.month("trade_date").alias("month"),
        F.when(F.col("transactions") > 1, F.col("stock_bar_id")).otherwise("").alias("key"),
    )
    months = staged.groupBy("ticker", "year", "month").agg(F.collect_list("key").alias("keys"))
    years = months.groupBy("ticker", "year").agg(F.collect_list("keys").alias("lists"))
    return years.select("ticker", "year", F.explode(shapes.flat(F.col("lists"))).alias("key"))
