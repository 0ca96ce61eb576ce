"""Session settings and the shared folder that jobs may write to."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def tune(spark: SparkSession) -> SparkSession:
    """Pin the settings that results depend on; the rest is the cluster's."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def bounded(spark: SparkSession) -> SparkSession:
    """``tune``, with less dealt to a task than Spark's 64 MB: bars come out of a shuffle at
    some ten times the size, and joins and windows hold them in several sorts at once."""
    tune(spark).conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16m")
    return spark


# While a table is written: what was shuffled for it goes when it is there, rather than when
# the driver next collects garbage, and a task with rows of so many periods has a file open
# for each instead of sorting them.
WHILE_WRITING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}


@contextmanager
def writing(spark: SparkSession) -> Iterator[None]:
    """Settings for one write, of rows that are put together inside; the session's own after it."""
    before = {name: spark.conf.get(name, None) for name in WHILE_WRITING}
    for name, value in WHILE_WRITING.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def local_session(
    cpus: int | str = 8, app: str = "barline", checkpoints: str | None = None
) -> SparkSession:
    """A session for tests and the bench; on a cluster use the session it gives.

    Bars are narrow and windows over them do much work per byte, so a megabyte,
    the least a merged shuffle partition holds by default, is too much for one
    task at the sizes a local session sees. ``checkpoints`` is its shared folder.
    """
    builder = SparkSession.builder
    if checkpoints is not None:
        builder = builder.config("spark.checkpoint.dir", checkpoints)
    spark = (
        builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        # Looking up the call site of every column expression costs more than planning.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, or where that is
    unset a folder below the session's warehouse."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/barline-work").rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder; nothing is written or cleared here."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def ensure_checkpoints(spark: SparkSession) -> None:
    """Give ``DataFrame.checkpoint`` a folder where the session has none yet."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
