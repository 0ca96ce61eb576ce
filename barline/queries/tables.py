"""Table maintenance: upserts, incremental merges, history, lists and filters."""

from pyspark.sql import functions as F

from barline import fixtures as fx
from barline import schemas
from barline.operators import history, merge
from barline.operators.batches import batch_ids as add_batch_ids
from barline.plans import models, refresh
from barline.queries.models import ENRICHED_SHOWN, JOINED, enriched_stock
from barline.queries.registry import (
    BARS, ENRICHED, FIXES, OPTIONS, STAGED, STAGED_OPTIONS, enriched_sql, query, shown, with_sql,
)
from barline.session import fresh_path
from barline.sources import documents, tables, versions

RAW_SHOWN = "ticker trade_date:d open:n high:n low:n close:n volume vwap:n transactions inserted_at:t"
FIRST, SECOND = "TIMESTAMP '2024-06-01 00:00:00' AS inserted_at", "TIMESTAMP '2024-06-08 00:00:00' AS inserted_at"
UPSERTED = f"""merged AS (
  SELECT *, {FIRST} FROM bars ANTI JOIN fixes USING (ticker, trade_date) UNION ALL BY NAME SELECT *, {SECOND} FROM fixes)"""


def corrected_bars(spark, sf_dir):
    return merge.upsert(
        fx.stock_bars(spark, sf_dir), fx.corrections(spark, sf_dir), schemas.STOCK_KEY, fx.CORRECTED
    )


@query("upsert_bars", with_sql(BARS, FIXES, UPSERTED, f"SELECT {shown(RAW_SHOWN)} FROM merged"))
def upsert_bars(spark, sf_dir):
    return corrected_bars(spark, sf_dir)


@query("upsert_if_changed", with_sql(BARS, FIXES, f"""changed AS (SELECT * FROM fixes EXCEPT SELECT * FROM bars)""", f"""merged AS (
  SELECT *, {FIRST} FROM bars ANTI JOIN changed USING (ticker, trade_date) UNION ALL BY NAME SELECT *, {SECOND} FROM changed)""",
    f"SELECT {shown(RAW_SHOWN)} FROM merged"))
def upsert_if_changed(spark, sf_dir):
    return merge.upsert(
        fx.stock_bars(spark, sf_dir), fx.corrections(spark, sf_dir), schemas.STOCK_KEY,
        fx.CORRECTED, only_if_changed=True,
    )


def test_results(spark, sf_dir):
    """Check results by day: one test per event type and user."""
    events = fx.table(spark, sf_dir, "events")
    name = F.concat("event_type", F.lit("_u"), F.col("user_id").cast("string"))
    runs = events.groupBy(
        name.alias("test_name"), "event_type", F.to_date("ts").cast("timestamp").alias("run_generated_at")
    ).agg(F.count("*").alias("n"), F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("cents"))
    state = (
        F.when(F.col("event_type") == "error", "error").when(F.col("n") > 1, "fail").otherwise("pass")
    )
    return schemas.conform(
        runs.select(
            F.concat(F.lit("test.bars."), "test_name").alias("test_id"), "test_name", state.alias("status"),
            F.when(state == "pass", 0).otherwise(F.col("n")).alias("failures"),
            (F.col("cents") / 100).alias("execution_time"), "run_generated_at",
            F.lit(fx.FIRST_LOAD).alias("loaded_at"),
        ),
        schemas.TEST_RESULTS,
    )


RESULTS = """results AS (
  SELECT 'test.bars.' || test_name AS test_id, test_name,
    CASE WHEN event_type = 'error' THEN 'error' WHEN n > 1 THEN 'fail' ELSE 'pass' END AS status,
    CASE WHEN event_type <> 'error' AND n <= 1 THEN 0 ELSE n END AS failures,
    cents / 100 AS execution_time, run_generated_at, TIMESTAMP '2024-06-01 00:00:00' AS loaded_at
  FROM (SELECT event_type || '_u' || user_id AS test_name, event_type, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS run_generated_at,
      count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents FROM events GROUP BY 1, 2, 3))"""


@query("upsert_dq", with_sql(RESULTS, f"""
    SELECT {shown('test_id test_name status failures execution_time:r run_generated_at:t')}
    FROM results QUALIFY row_number() OVER (PARTITION BY test_id ORDER BY run_generated_at DESC) = 1"""))
def upsert_dq(spark, sf_dir):
    """The latest run merged into the latest results before it."""
    results = test_results(spark, sf_dir).drop("loaded_at")
    newest = results.agg(F.max("run_generated_at")).scalar()
    batch = results.filter(F.col("run_generated_at") == newest)
    before = merge.latest_by_key(
        results.filter(F.col("run_generated_at") < newest), ("test_id",), ("run_generated_at",)
    )
    return merge.upsert_columns(before, batch, ("test_id",), ("test_name",))


@query("incremental_merge", with_sql(BARS, FIXES, UPSERTED, f"""
    SELECT ticker || '_' || CAST(trade_date AS VARCHAR) AS stock_bar_id, {shown('close:n inserted_at:t')} FROM merged"""))
def incremental_merge(spark, sf_dir):
    def identified(bars):
        return bars.select(
            F.concat("ticker", F.lit("_"), F.date_format("trade_date", "yyyy-MM-dd")).alias("stock_bar_id"),
            "close", "inserted_at",
        )

    target, batch = fx.stock_bars(spark, sf_dir), fx.corrections(spark, sf_dir)
    return merge.replace_by_key(identified(target), identified(batch), ("stock_bar_id",))


@query("incremental_filter", with_sql(BARS, FIXES, UPSERTED, f"SELECT {shown(RAW_SHOWN)} FROM merged WHERE inserted_at > TIMESTAMP '2024-06-01'"))
def incremental_filter(spark, sf_dir):
    return merge.newer_than(corrected_bars(spark, sf_dir), fx.stock_bars(spark, sf_dir), "inserted_at")


HISTORY = f"""history AS (
  SELECT b.*, {FIRST}, TIMESTAMP '2024-06-01' AS valid_from,
    CASE WHEN f.ticker IS NOT NULL THEN TIMESTAMP '2024-06-08' END AS valid_to
  FROM bars b LEFT JOIN fixes f ON b.ticker = f.ticker AND b.trade_date = f.trade_date
  UNION ALL BY NAME
  SELECT *, {SECOND}, TIMESTAMP '2024-06-08' AS valid_from, NULL AS valid_to FROM fixes)"""
VERSION = """md5(ticker || '|' || CAST(trade_date AS VARCHAR) || '|' || strftime(valid_from, '%Y-%m-%d %H:%M:%S.%f')) AS scd_id,
  strftime(valid_from, '%Y-%m-%d %H:%M:%S') AS updated_at"""


enriched_table = fx.stored(enriched_stock)


def corrected_history(spark, sf_dir):
    before = history.first_snapshot(fx.stock_bars(spark, sf_dir), schemas.STOCK_KEY)
    return history.snapshot(before, corrected_bars(spark, sf_dir), schemas.STOCK_KEY)


@query("scd2_snapshot", with_sql(BARS, FIXES, HISTORY, f"SELECT {shown(RAW_SHOWN + ' valid_from:t valid_to:t')}, {VERSION} FROM history"))
def scd2_snapshot(spark, sf_dir):
    return corrected_history(spark, sf_dir)


@query("current_rows", with_sql(BARS, FIXES, HISTORY, f"SELECT {shown(RAW_SHOWN)} FROM history WHERE valid_to IS NULL"))
def current_rows(spark, sf_dir):
    return history.current(corrected_history(spark, sf_dir)).select(schemas.STOCK_BARS.names)


LATE_STAGED = """late_staged AS (
  SELECT ticker || '_' || CAST(trade_date AS VARCHAR) AS stock_bar_id, ticker, trade_date, inserted_at AS loaded_at,
    open AS open_price, high AS high_price, low AS low_price, close AS close_price,
    vwap AS volume_weighted_average_price, volume, transactions FROM merged)"""


@query("late_bar_recompute", with_sql(BARS, FIXES, UPSERTED, LATE_STAGED, enriched_sql("late", "late_staged"),
                                      f"SELECT {shown(ENRICHED_SHOWN)} FROM late"))
def late_bar_recompute(spark, sf_dir):
    """Corrections reach a new version of the history, and only the windows they
    touch are redone on what was enriched before."""
    path = fresh_path(spark, "history")
    tables.rebuild(corrected_history(spark, sf_dir), path)
    restaged = models.stage_stock_bars(spark.read.parquet(path))
    return refresh.recompute_enriched(
        enriched_table(spark, sf_dir), restaged, fx.corrections(spark, sf_dir)
    )


MODEL_TOTALS = """
    SELECT 'enriched_stock_bars' AS table_name, count(*) AS n, CAST(sum(volume) AS BIGINT) AS volume,
      round(CAST(sum(moving_avg_120d) AS DOUBLE), 4) AS averages FROM enriched
    UNION ALL SELECT 'fct_stock_performance', count(*), CAST(sum(volume) AS BIGINT), round(CAST(sum(moving_avg_50d) AS DOUBLE), 4) FROM enriched
    UNION ALL SELECT 'stocks_options_joined', count(*), CAST(sum(option_volume) AS BIGINT),
      round(CAST(sum(underlying_moving_avg_120d) AS DOUBLE), 4) FROM joined"""


def model_totals(spark, to):
    def counted(name, volume, average):
        total = F.round(F.sum(average).cast("double"), 4)
        totals = versions.read(spark, to.path(name)).agg(F.count("*").alias("n"), F.sum(volume).alias("volume"), total.alias("averages"))
        return totals.select(F.lit(name).alias("table_name"), "n", "volume", "averages")

    return merge.union_batches(
        counted("enriched_stock_bars", "volume", "moving_avg_120d"), counted("fct_stock_performance", "volume", "moving_avg_50d"),
        counted("stocks_options_joined", "option_volume", "underlying_moving_avg_120d"),
    )


@query("full_refresh", with_sql(BARS, STAGED, ENRICHED, OPTIONS, STAGED_OPTIONS, JOINED, MODEL_TOTALS))
def full_refresh(spark, sf_dir):
    """Write every model table anew, then add up three of them."""
    stocks = history.first_snapshot(fx.stock_bars(spark, sf_dir), schemas.STOCK_KEY)
    options = history.first_snapshot(fx.option_bars(spark, sf_dir), schemas.OPTION_KEY)
    to = refresh.Models(fresh_path(spark, "models"), stock_grain="year", option_grain="year")
    refresh.refresh(spark, stocks, options, to)
    return model_totals(spark, to)


@query("incremental_refresh", with_sql(
    BARS, FIXES, UPSERTED, LATE_STAGED, enriched_sql("enriched", "late_staged"), OPTIONS, STAGED_OPTIONS, JOINED, MODEL_TOTALS))
def incremental_refresh(spark, sf_dir):
    """The model tables after corrected stock bars and late option bars, by their periods."""
    to = refresh.Models(fresh_path(spark, "models"), stock_grain="year", option_grain="year")
    options = fx.option_bars(spark, sf_dir)
    late = F.year("trade_date") % 3 == 0
    first = history.first_snapshot(fx.stock_bars(spark, sf_dir), schemas.STOCK_KEY)
    refresh.refresh(spark, first, history.first_snapshot(options.filter(~late), schemas.OPTION_KEY), to)
    fixed = history.first_snapshot(fx.corrections(spark, sf_dir), schemas.STOCK_KEY)
    refresh.update(spark, to, models.stage_stock_bars(fixed), models.stage_option_bars(history.first_snapshot(options.filter(late), schemas.OPTION_KEY)))
    return model_totals(spark, to)


@query("dedup_latest", """
    SELECT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS trade_date, event_id, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY event_id DESC) = 1""")
def dedup_latest(spark, sf_dir):
    events = fx.table(spark, sf_dir, "events").withColumn("trade_date", F.to_date("ts"))
    rows = events.select("user_id", "trade_date", "event_id", "event_type", "value")
    return merge.latest_by_key(rows, ("user_id", "trade_date"), ("event_id",))


@query("union_batches", with_sql(BARS, FIXES, f"SELECT {shown(RAW_SHOWN)} FROM (SELECT *, {FIRST} FROM bars UNION ALL SELECT *, {SECOND} FROM fixes)"))
def union_batches(spark, sf_dir):
    return merge.union_batches(fx.stock_bars(spark, sf_dir), fx.corrections(spark, sf_dir))


@query("batch_ids", with_sql(BARS, """
    SELECT ticker, CAST(trade_date AS VARCHAR) AS trade_date,
      (row_number() OVER (ORDER BY ticker, trade_date) - 1) // 1000 AS batch_id FROM bars"""))
def batch_ids(spark, sf_dir):
    keys = fx.stock_bars(spark, sf_dir).select("ticker", "trade_date")
    return add_batch_ids(keys, ("ticker", "trade_date"), 1000)


# --- Filters and dimensions -----------------------------------------------------------


@query("ticker_dim", with_sql(BARS, "SELECT DISTINCT ticker FROM bars"))
def ticker_dim(spark, sf_dir):
    """The ticker table, written and read back as a dimension."""
    path = fresh_path(spark, "tickers")
    tables.rebuild(tables.tickers(fx.stock_bars(spark, sf_dir)), path)
    return spark.read.schema(schemas.SEED_TICKERS).parquet(path).select("ticker")


@query("distinct_tickers", with_sql(BARS, "SELECT DISTINCT ticker FROM bars"))
def distinct_tickers(spark, sf_dir):
    return tables.tickers(fx.stock_bars(spark, sf_dir))


@query("date_bounds", with_sql(BARS, "SELECT CAST(min(trade_date) AS VARCHAR) AS min_date, CAST(max(trade_date) AS VARCHAR) AS max_date FROM bars"))
def date_bounds(spark, sf_dir):
    return tables.date_bounds(fx.stock_bars(spark, sf_dir))


@query("allowlist_semi", with_sql(BARS, f"""
    SELECT {shown('ticker trade_date:d close:n')} FROM bars WHERE ticker IN (SELECT c_mktsegment FROM customer WHERE c_acctbal > 0)"""))
def allowlist_semi(spark, sf_dir):
    solvent = fx.table(spark, sf_dir, "customer").filter("c_acctbal > 0")
    allowed = solvent.select(F.col("c_mktsegment").alias("ticker")).distinct()
    bars = fx.stock_bars(spark, sf_dir).select("ticker", "trade_date", "close")
    return documents.listed(bars, allowed)


@query("unexpired_filter", with_sql(OPTIONS, f"SELECT {shown('option_symbol trade_date:d expiration_date:d')} FROM options WHERE expiration_date >= trade_date"))
def unexpired_filter(spark, sf_dir):
    columns = ("option_symbol", "trade_date", "expiration_date")
    return tables.unexpired(fx.option_bars(spark, sf_dir).select(*columns))


@query("backfill_grid", """
    SELECT 'U' || user_id AS ticker, CAST(CAST(d AS DATE) AS VARCHAR) AS trade_date FROM (
      SELECT user_id, unnest(generate_series(CAST(CAST(first_ts AS DATE) AS TIMESTAMP), CAST(CAST(last_ts AS DATE) AS TIMESTAMP), INTERVAL 1 DAY)) AS d
      FROM (SELECT DISTINCT user_id FROM events), (SELECT min(ts) AS first_ts, max(ts) AS last_ts FROM events))
    WHERE isodow(d) < 6""")
def backfill_grid(spark, sf_dir):
    """Every ticker and weekday between the first and the last event."""
    events = fx.table(spark, sf_dir, "events")
    bounds = events.agg(F.to_date(F.min("ts")).alias("s"), F.to_date(F.max("ts")).alias("e")).first()
    users = events.select(F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("ticker"))
    return tables.backfill_grid(users.distinct(), F.lit(bounds.s), F.lit(bounds.e))
