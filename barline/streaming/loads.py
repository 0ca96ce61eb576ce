"""File-arrival loads: new documents to the raw bar tables, then the archive.

The stream's checkpoint records which files were loaded. A run takes what has
arrived and stops; a batch that fails is run again and writes the same rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from barline import schemas
from barline.operators.merge import latest_by_key
from barline.sources import documents
from barline.sources.tables import snapshot_table, upsert_table
from barline.sources.versions import delete


ADAPTIVE = "spark.sql.adaptive.enabled"


@dataclass(frozen=True)
class Feed:
    """A kind of document, the table it loads, its key and its partition grain.

    A month of stock bars or a day of option bars makes a partition worth a file.
    """

    parse: Callable[[DataFrame], DataFrame]
    schema: T.StructType
    keys: tuple[str, ...]
    grain: str


FEEDS = {
    "stock_bars": Feed(documents.stock_bars, schemas.STOCK_BARS, schemas.STOCK_KEY, "month"),
    "option_bars": Feed(documents.option_bars, schemas.OPTION_BARS, schemas.OPTION_KEY, "day"),
    "broker_stock_bars": Feed(
        documents.history_bars, schemas.BROKER_STOCK_BARS, schemas.STOCK_KEY, "month"
    ),
    "broker_option_bars": Feed(
        documents.option_history_bars, schemas.BROKER_OPTION_BARS, schemas.OPTION_KEY, "day"
    ),
}


def typed_batch(parsed: DataFrame, feed: Feed) -> DataFrame:
    """Accepted rows in stored types, one per key: the last file by path wins, and in it the
    last place."""
    rows = documents.accepted(parsed)
    names = [f.name for f in feed.schema.fields if f.name != "inserted_at"]
    typed = rows.select(
        "path", "at", *[schemas.stored(F.col(f.name), f.dataType).alias(f.name)
                  for f in feed.schema.fields if f.name in names],
    )
    return latest_by_key(typed, feed.keys, ("path", "at")).select(names)


def load_batch(
    spark: SparkSession, docs: DataFrame, feed: Feed, table: str, now: datetime,
    quarantine: str | None = None, history: str | None = None, batch_id: int = 0,
) -> None:
    """Upsert one batch of documents and, if asked to, update the table's history.

    Documents are scanned and parsed once: what they give is written under the batch's
    number, so that a rerun replaces it, and read from there by the upsert and by the
    quarantine, which gets the refused ones.
    """
    work = f"{table}.parsed/batch={batch_id}"
    rows = feed.parse(documents.numbered(docs))
    rows.write.mode("overwrite").parquet(work)
    parsed = spark.read.schema(rows.schema).parquet(work)
    touched = upsert_table(spark, table, feed.schema, typed_batch(parsed, feed), feed.keys, now, feed.grain)
    if history is not None:
        snapshot_table(spark, history, feed.schema, table, feed.keys, touched, feed.grain)
    if quarantine is not None:
        documents.rejected(parsed).write.mode("overwrite").parquet(f"{quarantine}/batch={batch_id}")
    delete(spark, work)


def document_stream(
    spark: SparkSession, folder: str, one_per_file: bool = True,
    archive: str | None = None, files_per_batch: int | None = None,
) -> DataFrame:
    """(path, doc, at) rows of files as they arrive.

    ``archive`` moves a loaded file there once a later batch has committed, so
    the last batch's files move in the run after.
    """
    reader = spark.readStream.format("text").option("wholetext", one_per_file)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return documents.placed_documents(reader.load(folder))


def start_load(
    spark: SparkSession, folder: str, feed: Feed, table: str, checkpoint: str,
    clock: Callable[[int], datetime], one_per_file: bool = True, archive: str | None = None,
    files_per_batch: int | None = None, quarantine: str | None = None, history: str | None = None,
) -> StreamingQuery:
    """Load every file that is there, then stop. ``clock`` stamps a batch by its id."""

    def write(docs: DataFrame, batch_id: int) -> None:
        # Streams turn adaptive execution off. A batch is an ordinary job, which
        # needs it to size partitions and to split hot ones.
        session = docs.sparkSession
        before = session.conf.get(ADAPTIVE)
        session.conf.set(ADAPTIVE, "true")
        try:
            load_batch(session, docs, feed, table, clock(batch_id), quarantine, history, batch_id)
        finally:
            session.conf.set(ADAPTIVE, before)

    docs = document_stream(spark, folder, one_per_file, archive, files_per_batch)
    return (
        docs.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
