"""Change history: one row per version of a key, with validity times."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VERSION_COLUMNS = ("valid_from", "valid_to", "scd_id", "updated_at")


def _versions(rows: DataFrame, keys: Sequence[str], stamp: str) -> DataFrame:
    at = F.col(stamp)
    text = F.date_format(at, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return rows.withColumns(
        {
            "valid_from": at,
            "valid_to": F.lit(None).cast("timestamp"),
            "scd_id": F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], text)),
            "updated_at": at,
        }
    )


def first_snapshot(source: DataFrame, keys: Sequence[str], stamp: str = "inserted_at") -> DataFrame:
    return _versions(source, keys, stamp)


def snapshot(
    history: DataFrame, source: DataFrame, keys: Sequence[str], stamp: str = "inserted_at"
) -> DataFrame:
    """The history after seeing ``source``.

    A new key opens a version. A key whose ``stamp`` is later than its open
    version's closes that one at the new time and opens another. Anything else,
    a vanished key included, stays. One full outer join of open versions and
    source decides all of it; closed versions pass by untouched.
    """
    columns = history.columns
    closed = history.filter(F.col("valid_to").isNotNull())
    old = history.filter(F.col("valid_to").isNull()).select(F.struct(*columns).alias("old"))
    new = _versions(source, keys, stamp).select(F.struct(*columns).alias("new"))

    same_key = [F.col(f"old.{k}") == F.col(f"new.{k}") for k in keys]
    opens = F.col("new").isNotNull() & (
        F.col("old").isNull() | (F.col(f"new.{stamp}") > F.col("old.valid_from"))
    )
    ends = F.when(opens, F.col(f"new.{stamp}"))
    pair = F.array(
        F.when(F.col("old").isNotNull(), F.col("old").withField("valid_to", ends)),
        F.when(opens, F.col("new")),
    )
    touched = old.join(new, same_key, "full_outer").select(
        F.inline(F.filter(pair, lambda v: v.isNotNull()))
    )
    return closed.unionByName(touched)


def current(history: DataFrame) -> DataFrame:
    return history.filter(F.col("valid_to").isNull())
