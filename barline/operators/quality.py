"""Declarative data-quality checks.

A check yields its violations as rows and its failures as one number. All checks on a
table take one scan: rows are counted by key, together with what the row checks find in
them, before and after one shuffle, and the counts are added up. Without a ``unique`` there
is no key. Row checks can also be observed while another job writes the table.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barline import schemas
from barline.operators.merge import replace_by_key
from barline.sources.versions import commit, period, read

logger = logging.getLogger(__name__)

# Fixed value: the format of a stock bar's surrogate key.
BAR_ID_FORMAT = r"^[A-Z0-9\.]+_[0-9]{4}-[0-9]{2}-[0-9]{2}$"


@dataclass(frozen=True)
class Check:
    """A named check on one table; ``where`` limits the rows it applies to."""

    name: str
    where: str | None = None

    def applies(self, df: DataFrame) -> DataFrame:
        return df.filter(F.expr(self.where)) if self.where else df


@dataclass(frozen=True)
class RowCheck(Check):
    """Fails on each row where the condition ``broken`` holds; null passes."""

    broken: str = "false"

    def violations(self, df: DataFrame) -> DataFrame:
        return self.applies(df).filter(self.broken)

    def failures(self) -> Column:
        scope = F.expr(self.where) if self.where else F.lit(True)
        return F.count_if(scope & F.expr(self.broken))


@dataclass(frozen=True)
class UniqueCheck(Check):
    """Fails once for each non-null value that more than one row has."""

    column: str = ""

    def violations(self, df: DataFrame) -> DataFrame:
        counts = self.applies(df).filter(F.col(self.column).isNotNull()).groupBy(self.column)
        return counts.agg(F.count("*").alias("n_records")).filter("n_records > 1")


@dataclass(frozen=True)
class TypeCheck(Check):
    """Fails if the column is stored as another type; reads no data."""

    column: str = ""
    kind: T.DataType | None = None

    def fails(self, df: DataFrame) -> bool:
        return df.schema[self.column].dataType != self.kind


def unique(column: str) -> UniqueCheck:
    return UniqueCheck(f"unique_{column}", None, column)


def not_null(column: str) -> RowCheck:
    return RowCheck(f"not_null_{column}", None, f"{column} IS NULL")


def matches(column: str, pattern: str) -> RowCheck:
    return RowCheck(f"match_regex_{column}", None, f"NOT rlike({column}, r'{pattern}')")


def of_type(column: str, kind: T.DataType) -> TypeCheck:
    return TypeCheck(f"of_type_{column}", None, column, kind)


def at_least(column: str, least: float = 0, where: str | None = None) -> RowCheck:
    return RowCheck(f"between_{column}", where, f"{column} < {least}")


def pair_ordered(larger: str, smaller: str) -> RowCheck:
    return RowCheck(f"pair_{larger}_{smaller}", None, f"{larger} < {smaller}")


def staged_stock_checks() -> list[Check]:
    return [
        unique("stock_bar_id"),
        not_null("stock_bar_id"),
        matches("stock_bar_id", BAR_ID_FORMAT),
        of_type("trade_date", T.DateType()),
        at_least("open_price", where="ticker not like '%CASH%'"),
        at_least("high_price"),
        at_least("low_price"),
        at_least("close_price"),
        at_least("volume"),
        pair_ordered("high_price", "low_price"),
    ]


def key_checks(column: str) -> list[Check]:
    return [unique(column), not_null(column)]


def model_checks() -> dict[str, list[Check]]:
    """The declared checks of every table."""
    return {
        "stg_stock_bars": staged_stock_checks(),
        "stg_option_bars": key_checks("option_bar_id"),
        "enriched_stock_bars": key_checks("stock_bar_id"),
        "enriched_option_bars": key_checks("option_bar_id"),
        "stocks_options_joined": key_checks("option_bar_id"),
        "fct_stock_performance": key_checks("stock_bar_id"),
        "stock_history": [not_null("ticker"), not_null("trade_date")],
        "option_history": [not_null("option_symbol"), not_null("trade_date")],
        "companies": key_checks("ticker"),
        "tickers": key_checks("ticker"),
    }


def freshness(tables: dict[str, DataFrame], as_of: datetime, warn_after_days: int = 1) -> DataFrame:
    """One row per table: its last load and whether that is too long before ``as_of``."""
    rows = [
        df.agg(F.max("inserted_at").alias("max_loaded_at")).withColumn("table_name", F.lit(name))
        for name, df in tables.items()
    ]
    late = F.col("max_loaded_at") + F.make_dt_interval(F.lit(warn_after_days)) < F.lit(as_of)
    merged = rows[0]
    for other in rows[1:]:
        merged = merged.unionByName(other)
    return merged.select(
        "table_name", "max_loaded_at",
        F.when(F.coalesce(late, F.lit(True)), "warn").otherwise("pass").alias("status"),
    )


def counted(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row with the failures of each check, by its name: one scan, and at most one shuffle.

    Rows are grouped by the first column that is to be unique; with more of them, each row
    stands for every one of its keys, and counts for the row checks once.
    """
    by_row = [c for c in checks if isinstance(c, RowCheck)]
    keyed = [c for c in checks if isinstance(c, UniqueCheck)]
    if not keyed:
        return df.agg(F.count("*").alias("_rows"), *[c.failures().alias(c.name) for c in by_row])
    scoped = [F.when(F.expr(c.where) if c.where else F.lit(True), F.col(c.column)) for c in keyed]
    flags = [F.coalesce(F.expr(f"({c.where or 'true'}) AND ({c.broken})"), F.lit(False)).alias(f"_bad{i}") for i, c in enumerate(by_row)]
    if len(keyed) == 1:
        rows = df.select(*flags, F.lit(0).alias("_which"), scoped[0].alias("_key"))
    else:
        keys = F.array(*[F.struct(F.lit(i).alias("_which"), k.cast("string").alias("_key")) for i, k in enumerate(scoped)])
        rows = df.select(*flags, F.inline(keys))
    first = F.col("_which") == 0
    groups = rows.groupBy("_which", "_key").agg(
        F.count("_key").alias("_n"), *[F.count_if(first & F.col(f"_bad{i}")).alias(f"_bad{i}") for i in range(len(by_row))]
    )
    repeated = [F.count_if((F.col("_which") == i) & (F.col("_n") > 1)).alias(c.name) for i, c in enumerate(keyed)]
    return groups.agg(*repeated, *[F.coalesce(F.sum(f"_bad{i}"), F.lit(0)).alias(c.name) for i, c in enumerate(by_row)])


def failures(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """(test_name, failures) for each check."""
    def found(check: Check) -> Column:
        return F.lit(int(check.fails(df))).cast("bigint") if isinstance(check, TypeCheck) else F.col(check.name)

    entries = [F.struct(F.lit(c.name).alias("test_name"), found(c).alias("failures")) for c in checks]
    return counted(df, checks).select(F.inline(F.array(*entries)))


def status(count: Column) -> Column:
    return F.when(count == 0, "pass").when(count > 0, "fail").otherwise("error")


def results(
    tables: dict[str, tuple[DataFrame, Sequence[Check]]],
    run_at: datetime,
    execution_time: Column | None = None,
) -> DataFrame:
    """The result records of all checks on all tables, one row per check."""
    took = F.lit(None).cast("double") if execution_time is None else execution_time
    merged = None
    for table, (df, checks) in tables.items():
        part = failures(df, checks).select(
            F.concat(F.lit(f"test.barline.{table}."), "test_name").alias("test_id"), "test_name",
            status(F.col("failures")).alias("status"), "failures",
            F.coalesce(took, F.lit(0.0)).alias("execution_time"),
            F.lit(run_at).alias("run_generated_at"), F.lit(run_at).alias("loaded_at"),
        )
        merged = part if merged is None else merged.unionByName(part)
    return schemas.conform(merged, schemas.TEST_RESULTS)


# --- Running checks and keeping their results -------------------------------------

Table = DataFrame | Callable[[], DataFrame]


def run(
    spark: SparkSession, tables: dict[str, tuple[Table, Sequence[Check]]], run_at: datetime
) -> DataFrame:
    """Run the checks of each table now: result records with the time that its query took.

    A table is a DataFrame, or what opens it. One that cannot be opened or read gives an
    ``error`` for each of its checks, and the others are run all the same.
    """
    rows = []
    for name, (table, checks) in tables.items():
        def count(table: Table = table, checks: Sequence[Check] = checks) -> dict[str, int]:
            df = table() if callable(table) else table
            return {r.test_name: r.failures for r in failures(df, checks).collect()}

        rows += _timed(name, checks, run_at, count)
    return spark.createDataFrame(rows, schemas.TEST_RESULTS)


def write_checked(
    name: str, df: DataFrame, checks: Sequence[Check], write: Callable[[DataFrame], None], run_at: datetime
) -> DataFrame:
    """Write a table and check its rows on the way: the row checks are observed by the job
    that writes, so they read nothing again. ``unique`` needs its own query."""
    if any(isinstance(c, UniqueCheck) for c in checks):
        raise ValueError("unique checks read the table that was written: use run")
    by_row = [c for c in checks if isinstance(c, RowCheck)]

    def count() -> dict[str, int]:
        seen = Observation(f"checks of {name}")
        write(df.observe(seen, F.count("*").alias("_rows"), *[c.failures().alias(c.name) for c in by_row]))
        return seen.get | {c.name: int(c.fails(df)) for c in checks if isinstance(c, TypeCheck)}

    return df.sparkSession.createDataFrame(_timed(name, checks, run_at, count), schemas.TEST_RESULTS)


def _timed(table: str, checks: Sequence[Check], run_at: datetime, count: Callable[[], dict[str, int]]) -> list[tuple]:
    """Result records of one query, in the order of ``TEST_RESULTS``."""
    started = time.perf_counter()
    try:
        found = count()
    except (PySparkException, Py4JJavaError) as error:
        logger.warning("checks of %s: %s", table, error)
        found = {}
    took = time.perf_counter() - started
    out = []
    for check in checks:
        n = found.get(check.name)
        state = "error" if n is None else "fail" if n else "pass"
        record = {
            "test_id": f"test.barline.{table}.{check.name}", "test_name": check.name, "status": state,
            "failures": n or 0, "execution_time": took, "run_generated_at": run_at, "loaded_at": run_at,
        }
        out.append(tuple(record[field.name] for field in schemas.TEST_RESULTS.fields))
    return out


def keep(records: DataFrame, path: str) -> None:
    """Add result records to the kept table, by day; a run that is kept again replaces itself."""
    days = [row[0] for row in records.select(period("day", "run_generated_at")).distinct().collect()]
    if days:
        before = read(records.sparkSession, path, schemas.TEST_RESULTS, days)
        commit(replace_by_key(before, records, ("test_id", "run_generated_at")), path, "day", on="run_generated_at")


def kept(spark: SparkSession, path: str) -> DataFrame:
    return read(spark, path, schemas.TEST_RESULTS)


# --- Reading results back -------------------------------------------------------


def latest_run(results: DataFrame) -> DataFrame:
    newest = results.agg(F.max("run_generated_at")).scalar()
    return results.filter(F.col("run_generated_at") == newest)


def status_counts(results: DataFrame) -> DataFrame:
    counts = latest_run(results).groupBy("status").agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), "status")


def counts_by_day(results: DataFrame) -> DataFrame:
    day = F.to_date("run_generated_at").alias("run_date")
    return results.groupBy(day, "status").agg(F.count("*").alias("count"))


def latest_details(results: DataFrame, rows: int = 20) -> DataFrame:
    """The first rows of the latest run by name, for display."""
    shown = latest_run(results).orderBy("test_name", "test_id").limit(rows)
    return shown.select("test_name", "status", "failures")
