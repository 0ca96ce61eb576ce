"""File-stream loads, run to the end of what has arrived."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from barline import fixtures as fx
from barline import schemas
from barline.queries.registry import BARS, FIXES, query, shown, with_sql
from barline.queries.scans import GOOD, REASONS, spoiled, wire_bar
from barline.session import fresh_path
from barline.sources import documents as docs
from barline.sources.versions import read
from barline.streaming import loads

RAW_SHOWN = "ticker trade_date:d open:n high:n low:n close:n volume vwap:n transactions"


def write_wave(bars, folder, wave):
    """One folder of document lines, a file per task."""
    wired = wire_bar(bars)
    doc = spoiled(docs.envelope(F.col("ticker"), F.col("bar")), F.dayofmonth("trade_date"))
    wired.select(doc.alias("value")).write.text(f"{folder}/{wave}")


def clock(batch_id):
    return datetime(2024, 6, 1) + timedelta(days=batch_id)


def drain(spark, root, clean=False):
    archive = f"{root}/processed" if clean else None
    loads.start_load(
        spark, f"{root}/raw_data/*", loads.FEEDS["stock_bars"], f"{root}/stock_bars",
        f"{root}/checkpoint", clock, one_per_file=False, archive=archive, quarantine=f"{root}/quarantine",
    ).awaitTermination()


def two_waves(spark, sf_dir, root, clean=False):
    """First loads, then corrections, each drained by a run of the same stream."""
    for wave, bars in enumerate((fx.stock_bars(spark, sf_dir), fx.corrections(spark, sf_dir))):
        write_wave(bars, f"{root}/raw_data", f"wave{wave}")
        drain(spark, root, clean)


@query("stream_load", with_sql(BARS, FIXES, f"""merged AS (
  SELECT * FROM bars ANTI JOIN (SELECT * FROM fixes WHERE {GOOD}) USING (ticker, trade_date) WHERE {GOOD}
  UNION ALL BY NAME SELECT * FROM fixes WHERE {GOOD})""", f"SELECT {shown(RAW_SHOWN)} FROM merged"))
def stream_load(spark, sf_dir):
    root = fresh_path(spark, "stream")
    two_waves(spark, sf_dir, root)
    return read(spark, f"{root}/stock_bars", schemas.STOCK_BARS).drop("inserted_at")


@query("stream_quarantine", with_sql(BARS, FIXES, f"""
    SELECT reject_reason, count(*) AS documents FROM (
      SELECT {REASONS} AS reject_reason FROM bars UNION ALL SELECT {REASONS} FROM fixes)
    WHERE reject_reason IS NOT NULL GROUP BY 1"""))
def stream_quarantine(spark, sf_dir):
    """The documents that two runs of the stream refused, by reason."""
    root = fresh_path(spark, "quarantine")
    two_waves(spark, sf_dir, root)
    return spark.read.parquet(f"{root}/quarantine").groupBy("reject_reason").agg(F.count("*").alias("documents"))


@query("archive_stream", with_sql(BARS, FIXES, """
    SELECT 'processed' AS folder, CAST(0 AS BIGINT) AS wave, count(*) AS documents FROM bars
    UNION ALL SELECT 'raw_data', CAST(1 AS BIGINT), count(*) FROM fixes"""))
def archive_stream(spark, sf_dir):
    """After the second run the first wave's files have moved, the second's not yet."""
    root = fresh_path(spark, "archive")
    two_waves(spark, sf_dir, root, clean=True)

    def counted(folder):
        found = docs.read_documents(spark, f"{root}/{folder}", one_per_file=False)
        wave = F.regexp_extract("path", r"/wave(\d)/", 1).cast("int").alias("wave")
        counts = found.groupBy(wave).agg(F.count("*").alias("documents"))
        return counts.select(F.lit(folder).alias("folder"), "wave", "documents")

    return counted("processed").unionByName(counted("raw_data"))
