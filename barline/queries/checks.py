"""Data-quality checks over the staged bars, and the result tables."""

from datetime import timedelta

from pyspark.sql import functions as F
from pyspark.sql import types as T

from barline import fixtures as fx
from barline import schemas
from barline.operators import quality as q
from barline.operators.history import first_snapshot
from barline.plans import models
from barline.queries.registry import (
    BARS, ENRICHED, FIXES, OPTIONS, STAGED, STAGED_OPTIONS, query, shown, with_sql,
)
from barline.queries.models import JOINED
from barline.session import fresh_path
from barline.queries.tables import RESULTS, UPSERTED, corrected_bars, enriched_table, test_results


def uncertain_bars(spark, sf_dir):
    """Staged bars and their corrections together, with faults: keys repeat, prices
    go below zero or missing, names in lower case."""
    fixes = models.stage_stock_bars(first_snapshot(fx.corrections(spark, sf_dir), schemas.STOCK_KEY))
    both = fx.staged_stock(spark, sf_dir).unionByName(fixes)
    return both.select(
        F.when(F.col("transactions") > 2, F.lower("stock_bar_id")).otherwise(F.col("stock_bar_id")).alias("stock_bar_id"),
        "ticker", "trade_date", "volume",
        F.when(F.col("volume") > 60, F.col("open_price")).alias("open_price"),
        (F.col("close_price") - 5).alias("close_price"),
        "low_price", (F.col("low_price") + F.col("close_price") - F.col("open_price")).alias("high_price"),
    )


UNCERTAIN = f"""both_staged AS (SELECT * FROM bars UNION ALL SELECT * FROM fixes),
uncertain AS (
  SELECT CASE WHEN transactions > 2 THEN lower(ticker || '_' || CAST(trade_date AS VARCHAR)) ELSE ticker || '_' || CAST(trade_date AS VARCHAR) END AS stock_bar_id,
    ticker, trade_date, volume, CASE WHEN volume > 60 THEN open END AS open_price, close - 5 AS close_price,
    low AS low_price, low + close - open AS high_price FROM both_staged)"""
COLUMNS = ("stock_bar_id", "ticker", "trade_date", "open_price", "high_price", "low_price", "close_price", "volume")
SHOWN = shown("stock_bar_id ticker trade_date:d open_price:n high_price:n low_price:n close_price:n volume")


def violations(check, where):
    def run(spark, sf_dir):
        return check.violations(uncertain_bars(spark, sf_dir)).select(*COLUMNS)

    return run, with_sql(BARS, FIXES, UNCERTAIN, f"SELECT {SHOWN} FROM uncertain WHERE {where}")


def _register(name, check, where):
    run, sql = violations(check, where)
    query(name, sql)(run)


_register("dq_not_null", q.not_null("open_price"), "open_price IS NULL")
_register("dq_regex", q.matches("stock_bar_id", q.BAR_ID_FORMAT), r"NOT regexp_matches(stock_bar_id, '^[A-Z0-9\.]+_[0-9]{4}-[0-9]{2}-[0-9]{2}$')")
_register("dq_between", q.at_least("close_price"), "close_price < 0")
_register("dq_row_condition", q.at_least("close_price", where="ticker not like '%BUILD%'"), "close_price < 0 AND ticker NOT LIKE '%BUILD%'")
_register("dq_pair", q.pair_ordered("high_price", "low_price"), "high_price < low_price")


@query("dq_unique", with_sql(BARS, FIXES, UNCERTAIN, """
    SELECT stock_bar_id, count(*) AS n_records FROM uncertain WHERE stock_bar_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1"""))
def dq_unique(spark, sf_dir):
    return q.unique("stock_bar_id").violations(uncertain_bars(spark, sf_dir))


@query("dq_type", with_sql(BARS, """
    SELECT test_name, CAST(failures AS BIGINT) AS failures, (SELECT count(*) FROM bars) AS n_rows
    FROM (VALUES ('of_type_trade_date', 0), ('of_type_ticker', 1)) AS t(test_name, failures)"""))
def dq_type(spark, sf_dir):
    """A column of the right type, and one that is not a date."""
    staged = fx.staged_stock(spark, sf_dir)
    checks = [q.of_type("trade_date", T.DateType()), q.of_type("ticker", T.DateType())]
    found = [(c.name, int(c.fails(staged))) for c in checks]
    rows = [F.struct(F.lit(n).alias("test_name"), F.lit(f).alias("failures")) for n, f in found]
    return staged.agg(F.count("*").alias("n_rows")).select(F.inline(F.array(*rows)), "n_rows")


@query("dq_freshness", with_sql(BARS, FIXES, UPSERTED, """
    SELECT 'raw' AS table_name, '2024-06-01 00:00:00' AS max_loaded_at, 'warn' AS status FROM bars HAVING count(*) > 0
    UNION ALL SELECT 'corrected', strftime(max(inserted_at), '%Y-%m-%d %H:%M:%S'), 'pass' FROM merged"""))
def dq_freshness(spark, sf_dir):
    tables = {"raw": fx.stock_bars(spark, sf_dir), "corrected": corrected_bars(spark, sf_dir)}
    return q.freshness(tables, fx.CORRECTED + timedelta(hours=12))


def _failures_sql(table: str, source: str, check: q.Check) -> str:
    """One result row: the check written out again as SQL."""
    kind = check.name
    if isinstance(check, q.UniqueCheck):
        count = f"SELECT count(*) FROM (SELECT {check.column} FROM {source} WHERE {check.column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"
    elif isinstance(check, q.TypeCheck):
        count = "SELECT 0"
    elif kind.startswith("match_regex_"):
        column = kind.removeprefix("match_regex_")
        count = rf"SELECT count(*) FROM {source} WHERE NOT regexp_matches({column}, '^[A-Z0-9\.]+_[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$')"
    elif kind.startswith("not_null_"):
        count = f"SELECT count(*) FROM {source} WHERE {kind.removeprefix('not_null_')} IS NULL"
    elif kind.startswith("pair_"):
        count = f"SELECT count(*) FROM {source} WHERE high_price < low_price"
    else:
        where = " AND ticker NOT LIKE '%CASH%'" if kind == "between_open_price" else ""
        count = f"SELECT count(*) FROM {source} WHERE {kind.removeprefix('between_')} < 0{where}"
    return f"SELECT 'test.barline.{table}.{kind}' AS test_id, '{kind}' AS test_name, ({count}) AS failures"


SQL_TABLES = {
    "stg_stock_bars": "staged", "stg_option_bars": "staged_options", "enriched_stock_bars": "enriched",
    "enriched_option_bars": "staged_options", "stocks_options_joined": "joined", "fct_stock_performance": "enriched",
    "stock_history": "bars", "option_history": "options", "companies": "companies", "tickers": "tickers",
    "uncertain_bars": "uncertain",
}


def declared_checks():
    """The models' checks, and some that fail, on a faulty table."""
    faulty = [q.unique("stock_bar_id"), q.not_null("open_price"), q.at_least("close_price")]
    return q.model_checks() | {"uncertain_bars": faulty}


RESULT_ROWS = " UNION ALL ".join(
    _failures_sql(table, SQL_TABLES[table], check) for table, checks in declared_checks().items() for check in checks
)
DIMENSIONS = "companies AS (SELECT c_name AS ticker FROM customer), tickers AS (SELECT DISTINCT ticker FROM bars)"


@query("dq_results", with_sql(BARS, FIXES, UNCERTAIN, STAGED, ENRICHED, OPTIONS, STAGED_OPTIONS, JOINED, DIMENSIONS, f"""
    SELECT test_id, test_name, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status, failures, 0.0::DOUBLE AS execution_time,
      '2024-06-08 00:00:00' AS run_generated_at FROM ({RESULT_ROWS})"""))
def dq_results(spark, sf_dir):
    """The records of every declared check on every table."""
    enriched = enriched_table(spark, sf_dir)
    options = models.enrich_option_bars(fx.staged_options(spark, sf_dir))
    bars = fx.stock_bars(spark, sf_dir)
    tables = {
        "stg_stock_bars": fx.staged_stock(spark, sf_dir),
        "stg_option_bars": fx.staged_options(spark, sf_dir),
        "enriched_stock_bars": enriched,
        "enriched_option_bars": options,
        "stocks_options_joined": models.join_options_to_stocks(options, enriched),
        "fct_stock_performance": models.stock_performance(enriched),
        "stock_history": first_snapshot(bars, schemas.STOCK_KEY),
        "option_history": first_snapshot(fx.option_bars(spark, sf_dir), schemas.OPTION_KEY),
        "companies": fx.table(spark, sf_dir, "customer").select(F.col("c_name").alias("ticker")),
        "tickers": bars.select("ticker").distinct(),
        "uncertain_bars": uncertain_bars(spark, sf_dir),
    }
    checks = declared_checks()
    return q.results({name: (df, checks[name]) for name, df in tables.items()}, fx.CORRECTED).drop("loaded_at")


RECORDED = ("stg_stock_bars", "uncertain_bars", "companies")
RECORDED_ROWS = " UNION ALL ".join(
    _failures_sql(table, SQL_TABLES[table], check) for table in RECORDED for check in declared_checks()[table]
)


@query("dq_recorded", with_sql(BARS, FIXES, UNCERTAIN, STAGED, DIMENSIONS, f"""
    SELECT test_id, test_name, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status, failures,
      '2024-06-08 00:00:00' AS run_generated_at FROM ({RECORDED_ROWS})
    UNION ALL SELECT 'test.barline.lost.' || test_name, test_name, 'error', 0, '2024-06-08 00:00:00'
    FROM (VALUES ('unique_ticker'), ('not_null_ticker')) AS t(test_name)"""))
def dq_recorded(spark, sf_dir):
    """Two runs of checks kept in a table, one kept twice, and the latest read from it; a
    table that is not there gives errors."""
    path, checks = fresh_path(spark, "check-results"), declared_checks()
    opened = {
        "stg_stock_bars": fx.staged_stock(spark, sf_dir), "uncertain_bars": uncertain_bars(spark, sf_dir),
        "companies": fx.table(spark, sf_dir, "customer").select(F.col("c_name").alias("ticker")),
    }
    tables = {name: (df, checks[name]) for name, df in opened.items()}
    tables["lost"] = (lambda: fx.table(spark, sf_dir, "no_such_table"), q.key_checks("ticker"))
    q.keep(q.run(spark, {"companies": tables["companies"]}, fx.FIRST_LOAD), path)
    latest = q.run(spark, tables, fx.CORRECTED)
    for _ in range(2):
        q.keep(latest, path)
    return q.latest_run(q.kept(spark, path)).drop("loaded_at", "execution_time")


LATEST = "WHERE run_generated_at = (SELECT max(run_generated_at) FROM results)"


@query("dq_latest", with_sql(RESULTS, f"SELECT {shown('test_id test_name status failures execution_time:r run_generated_at:t loaded_at:t')} FROM results {LATEST}"))
def dq_latest(spark, sf_dir):
    return q.latest_run(test_results(spark, sf_dir)).orderBy(F.desc("run_generated_at"), "test_id")


@query("dq_status_counts", with_sql(RESULTS, f"SELECT status, count(*) AS count FROM results {LATEST} GROUP BY 1"))
def dq_status_counts(spark, sf_dir):
    return q.status_counts(test_results(spark, sf_dir))


@query("dq_by_day", with_sql(RESULTS, "SELECT CAST(CAST(run_generated_at AS DATE) AS VARCHAR) AS run_date, status, count(*) AS count FROM results GROUP BY 1, 2"))
def dq_by_day(spark, sf_dir):
    return q.counts_by_day(test_results(spark, sf_dir))


@query("dq_top20", with_sql(RESULTS, f"SELECT test_name, status, failures FROM results {LATEST} ORDER BY test_name, test_id LIMIT 20"))
def dq_top20(spark, sf_dir):
    return q.latest_details(test_results(spark, sf_dir))
