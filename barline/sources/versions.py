"""Tables of immutable period folders, switched from one version to the next in one step.

A commit writes its rows once, into a folder of its own with one folder a period. Nothing
that a reader may see is ever overwritten: a version is a small file that lists, for each
period, the commit which holds it, and appears by one rename when everything it lists is in
place. Whatever stops a commit, the versions before are whole, and running it again gives
the version it would have given. Readers pin the version they found first.

A table has one writer at a time. Lists come to the driver: there are no more periods than
the calendar has.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barline.session import writing

PERIOD, COMMIT = "period", "commit"
VERSION_FILE = re.compile(r"(\d{12})\.json")


@dataclass(frozen=True)
class Version:
    """The number of a version, the table's columns and the commit of each period, a day as
    text (as folders are named)."""

    number: int
    schema: T.StructType
    periods: dict[str, str]


def period(grain: str, on: str = "trade_date") -> Column:
    """The partition of a row: the ``day``, ``month`` or ``year`` of its date, as a date."""
    day = F.col(on).cast("date")
    return day if grain == "day" else F.trunc(day, grain)


def hadoop_path(spark: SparkSession, path: str) -> tuple:
    """The file system that ``path`` is on, and the path as it knows it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def path_exists(spark: SparkSession, path: str) -> bool:
    files, place = hadoop_path(spark, path)
    return files.exists(place)


def names_in(spark: SparkSession, path: str) -> list[str]:
    files, place = hadoop_path(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(place)) if files.exists(place) else []


# --- versions ------------------------------------------------------------------------


def version_numbers(spark: SparkSession, path: str) -> list[int]:
    found = (VERSION_FILE.fullmatch(name) for name in names_in(spark, f"{path}/versions"))
    return sorted(int(m[1]) for m in found if m)


def version_path(path: str, number: int) -> str:
    return f"{path}/versions/{number:012}.json"


def pinned(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """A version of the table, the newest if none is named; None if it has none yet."""
    if number is None:
        numbers = version_numbers(spark, path)
        if not numbers:
            return None
        number = numbers[-1]
    files, place = hadoop_path(spark, version_path(path, number))
    stream = files.open(place)
    try:
        found = json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return Version(number, T.StructType.fromJson(found["schema"]), found["periods"])


def exists(spark: SparkSession, path: str) -> bool:
    return bool(version_numbers(spark, path))


def commit(
    df: DataFrame, path: str, grain: str, whole: bool = False, on: str = "trade_date", laid: bool = False
) -> Version:
    """Replace the periods ``df`` has rows for, or with ``whole`` the table, by its rows.

    Rebalancing brings a period's rows together for few files, and splits a period too big
    for one task. It costs a shuffle of the whole rows, more than they take as files, so it
    is left out where tasks have few periods without it: by year, and of rows that are
    ``laid`` out by such periods where they are read and were not shuffled since. ``df`` may
    read the table itself: its files stay.
    """
    spark, name = df.sparkSession, uuid.uuid4().hex
    write(df, data_path(path, name), grain, on, laid)
    before = pinned(spark, path)
    kept = {} if whole or before is None else before.periods
    written = [n.removeprefix(f"{PERIOD}=") for n in names_in(spark, data_path(path, name)) if n.startswith(f"{PERIOD}=")]
    after = Version(before.number + 1 if before else 1, df.schema, kept | dict.fromkeys(written, name))
    publish(spark, path, after)
    return after


def data_path(path: str, commit_name: str) -> str:
    return f"{path}/data/{COMMIT}={commit_name}"


def write(df: DataFrame, folder: str, grain: str, on: str, laid: bool = False) -> None:
    with writing(df.sparkSession):
        rows = df.withColumn(PERIOD, period(grain, on))
        if not laid and grain != "year":
            rows = rows.hint("rebalance", PERIOD)
        rows.write.partitionBy(PERIOD).parquet(folder, compression="zstd")


def publish(spark: SparkSession, path: str, version: Version) -> None:
    """Write the version's list beside its place, then rename it there."""
    content = json.dumps({"schema": version.schema.jsonValue(), "periods": version.periods}, sort_keys=True)
    files, draft = hadoop_path(spark, f"{path}/versions/.draft-{uuid.uuid4().hex}")
    stream = files.create(draft)
    stream.write(bytearray(content.encode()))
    stream.close()
    place = hadoop_path(spark, version_path(path, version.number))[1]
    if files.exists(place) or not files.rename(draft, place):
        raise RuntimeError(f"version {version.number} of {path} is there already: a table has one writer")


def read(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    periods: Iterable[date] | None = None,
    since: date | None = None,
    version: int | None = None,
) -> DataFrame:
    """The table, or the given periods, or those from one on: no other folder is listed."""
    found = pinned(spark, path, version)
    if found is None:
        if schema is None:
            raise FileNotFoundError(f"no table at {path}")
        return nothing(spark, schema)
    schema = schema or found.schema
    chosen = found.periods
    if periods is not None:
        wanted = {str(p) for p in periods}
        chosen = {p: c for p, c in chosen.items() if p in wanted}
    if since is not None:
        chosen = {p: c for p, c in chosen.items() if p >= str(since)}
    if not chosen:
        return nothing(spark, schema)
    folders = [f"{data_path(path, c)}/{PERIOD}={p}" for p, c in sorted(chosen.items())]
    parts = [T.StructField(COMMIT, T.StringType()), T.StructField(PERIOD, T.DateType())]
    stored = spark.read.schema(T.StructType([*schema.fields, *parts])).option("basePath", f"{path}/data")
    return stored.parquet(*folders).select(schema.names)


def nothing(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, which a plan can tell: joins with them are left out, with their shuffles."""
    return spark.createDataFrame([], schema).limit(0)


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Delete all but the newest versions, then what none of them lists.

    A version's list goes before its folders, so a stop leaves only folders that nothing
    lists, which the next call deletes. Readers of versions that old must have ended.
    """
    numbers = version_numbers(spark, path)
    for number in numbers[:-keep]:
        delete(spark, version_path(path, number))
    listed = {(c, p) for n in numbers[-keep:] for p, c in pinned(spark, path, n).periods.items()}
    for folder in names_in(spark, f"{path}/data"):
        name = folder.removeprefix(f"{COMMIT}=")
        used = {p for c, p in listed if c == name}
        if not used:
            delete(spark, f"{path}/data/{folder}")
            continue
        for part in names_in(spark, f"{path}/data/{folder}"):
            if part.startswith(f"{PERIOD}=") and part.removeprefix(f"{PERIOD}=") not in used:
                delete(spark, f"{path}/data/{folder}/{part}")
    for draft in names_in(spark, f"{path}/versions"):
        if draft.startswith(".draft-"):
            delete(spark, f"{path}/versions/{draft}")


def delete(spark: SparkSession, path: str) -> None:
    files, place = hadoop_path(spark, path)
    files.delete(place, True)
