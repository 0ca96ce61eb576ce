"""Keyed merges as DataFrame functions: the new table from the old one and a batch."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the last in ``order``; a tie goes to the larger values.

    An aggregate rather than a ranking window: it combines before the shuffle,
    so a key sent a million times costs one row per input partition.
    """
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*order, *[c for c in rest if c not in order])
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("_row"))
    return newest.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(df.columns)


def replace_by_key(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is not in the batch, and the whole batch.

    No broadcast hint: the size of the batch decides, at run time.
    """
    kept = target.join(batch.select(*keys).distinct(), list(keys), "left_anti")
    return kept.select(target.columns).unionByName(batch.select(target.columns))


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    now: datetime,
    stamp: str = "inserted_at",
    only_if_changed: bool = False,
) -> DataFrame:
    """Insert the batch, or replace all measures of the rows it has keys for.

    ``stamp`` becomes ``now``, one value for the whole batch so that a retry
    writes the same rows. It moves even where no measure did, unless
    ``only_if_changed`` drops such rows from the batch. Keys are unique in the
    batch; ``latest_by_key`` makes them so.
    """
    batch = batch.drop(stamp)
    if only_if_changed:
        measures = [c for c in batch.columns if c not in keys]
        old = target.select(*keys, *[F.col(c).alias(f"_old_{c}") for c in measures], F.lit(True).alias("_known"))
        same = F.col("_known").isNotNull()
        for c in measures:
            same = same & F.col(c).eqNullSafe(F.col(f"_old_{c}"))
        batch = batch.join(old, list(keys), "left").filter(~same).select(batch.columns)
    return replace_by_key(target, batch.withColumn(stamp, F.lit(now)), keys)


def upsert_columns(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], kept: Sequence[str]
) -> DataFrame:
    """An upsert that leaves the ``kept`` columns of known rows as they were."""
    known = target.select(*keys, *[F.col(c).alias(f"_old_{c}") for c in kept], F.lit(True).alias("_known"))
    merged = batch.join(known, list(keys), "left")
    for c in kept:
        merged = merged.withColumn(
            c, F.when(F.col("_known"), F.col(f"_old_{c}")).otherwise(F.col(c))
        )
    return replace_by_key(target, merged.select(batch.columns), keys)


def newer_than(source: DataFrame, target: DataFrame, column: str) -> DataFrame:
    """Source rows later than anything in the target; all of them if it is empty."""
    newest = target.agg(F.max(column)).scalar()
    return source.filter(newest.isNull() | (F.col(column) > newest))


def union_batches(first: DataFrame, *others: DataFrame) -> DataFrame:
    for other in others:
        first = first.unionByName(other)
    return first
