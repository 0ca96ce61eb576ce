"""Fixed-size batches of an ordered list."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barline.session import ensure_checkpoints


def place_rows(df: DataFrame, keys: tuple[str, ...], order: tuple[str, ...], out: str) -> DataFrame:
    """Add each row's 1-based place among the rows of its keys, at any group size.

    The whole table is range-sorted, which cuts a hot key into many partitions;
    a partition's part of a key starts after the rows earlier partitions hold.
    The window over partitions has one row per key and partition. The sorted
    rows are checkpointed because counting and numbering must see the same cut.
    """
    ensure_checkpoints(df.sparkSession)
    by = [*keys, *order]
    ordered = (
        df.repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_id", 33))
        .checkpoint()
    )
    parts = ordered.groupBy(*keys, "_part").agg(
        F.count("*").alias("_n"), F.min("_id").alias("_first")
    )
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    shift = F.coalesce(F.sum("_n").over(earlier), F.lit(0)) + 1 - F.col("_first")
    starts = parts.select(*keys, "_part", shift.alias("_shift"))
    return (
        ordered.join(starts, [*keys, "_part"])
        .withColumn(out, F.col("_id") + F.col("_shift"))
        .drop("_id", "_part", "_shift")
    )


def batch_ids(df: DataFrame, order: tuple[str, ...], size: int, out: str = "batch_id") -> DataFrame:
    """Add the 0-based batch of each row when the sorted rows are cut every ``size``."""
    placed = place_rows(df, (), order, "_place")
    return placed.withColumn(out, F.floor((F.col("_place") - 1) / F.lit(size)).cast("bigint")).drop("_place")
