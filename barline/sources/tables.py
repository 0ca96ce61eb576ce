"""Parquet tables, manifests and CSV seeds."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barline import schemas
from barline.functions.dates import weekdays
from barline.operators.history import first_snapshot, snapshot
from barline.operators.merge import upsert
from barline.session import writing
from barline.sources.versions import commit, exists, period, read

# --- Parquet tables -----------------------------------------------------------------


def rebuild(df: DataFrame, path: str) -> None:
    """Write a plain table from scratch."""
    with writing(df.sparkSession):
        df.select("*").write.mode("overwrite").parquet(path, compression="zstd")


def upsert_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    batch: DataFrame,
    keys: Sequence[str],
    now: datetime,
    grain: str = "month",
) -> list[date]:
    """Upsert ``batch`` into the table at ``path``, rewriting touched periods only.

    The key holds the date, so rows of other periods cannot match. The touched
    periods come to the driver to prune the scan: there are no more of them than
    the calendar has. Running a batch twice with one ``now`` gives the same
    table, so a failed run is simply run again. Returns the touched periods.
    """
    batch = batch.persist()
    try:
        touched = [row[0] for row in batch.select(period(grain)).distinct().collect()]
        if touched:
            commit(upsert(read(spark, path, schema, touched), batch, keys, now), path, grain)
        return touched
    finally:
        batch.unpersist()


def history_schema(schema: T.StructType) -> T.StructType:
    """A bar table's columns and those of its versions."""
    times = [T.StructField(c, T.TimestampType()) for c in ("valid_from", "valid_to")]
    rest = [T.StructField("scd_id", T.StringType()), T.StructField("updated_at", T.TimestampType())]
    return T.StructType([*schema.fields, *times, *rest])


def snapshot_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    raw_path: str,
    keys: Sequence[str],
    periods: Sequence[date] | None = None,
    grain: str = "month",
) -> None:
    """Bring the history at ``path`` up to the raw table, for all or some periods.

    A key's versions share its date, so a period's history needs only that
    period's bars: a daily load leaves the rest of the history alone. Seeing the
    same bars twice changes nothing.
    """
    if periods is not None and not periods:
        return
    raw = read(spark, raw_path, schema, periods)
    if exists(spark, path):
        versions = snapshot(read(spark, path, history_schema(schema), periods), raw, keys)
    else:
        versions = first_snapshot(raw, keys)
    commit(versions, path, grain)


def mart_rows(mart: DataFrame) -> DataFrame:
    """The mart by date; the ticker makes the order total and the sort splittable."""
    return mart.orderBy("trade_date", "ticker")


# --- Manifests ------------------------------------------------------------------------


def write_manifest(paths: DataFrame, path: str) -> None:
    """The distinct paths as lines, replacing the manifest before."""
    paths.select("path").distinct().write.mode("overwrite").text(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Paths listed in a manifest, without blank lines; a missing one is an error."""
    lines = spark.read.text(path).select(F.trim("value").alias("path"))
    return lines.filter(F.length("path") > 0)


def in_manifest(docs: DataFrame, manifest: DataFrame) -> DataFrame:
    """Documents whose path is listed. The list stays a DataFrame: it may be long."""
    return docs.join(manifest, "path", "left_semi")


# --- Seeds ------------------------------------------------------------------------------


def read_seed(spark: SparkSession, path: str, fields: str = schemas.SEED_COMPANIES) -> DataFrame:
    return spark.read.csv(path, schema=fields, header=True, escape='"')


# --- Dimension queries --------------------------------------------------------------------


def tickers(bars: DataFrame) -> DataFrame:
    return bars.select("ticker").distinct()


def date_bounds(bars: DataFrame) -> DataFrame:
    return bars.agg(F.min("trade_date").alias("min_date"), F.max("trade_date").alias("max_date"))


def unexpired(contracts: DataFrame) -> DataFrame:
    return contracts.filter(F.col("expiration_date") >= F.col("trade_date"))


def backfill_grid(tickers: DataFrame, start: Column, end: Column) -> DataFrame:
    """One row per ticker and weekday of the range; each ticker row fans out itself."""
    return tickers.select("ticker", F.explode(weekdays(start, end)).alias("trade_date"))
