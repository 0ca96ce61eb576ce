"""Small helpers shared by the operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barline.session import fresh_path

ROW = f"_row_{uuid.uuid4().hex[:12]}"  # names a row of one read: made anew, so that no table has such a column


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written below the shared folder and read again, so that nothing above it
    runs twice and a lost executor costs only the tasks it held."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame) -> DataFrame:
    """Rows with a number of their own, for one read: another read of the same files may be
    split otherwise, by the cores there are then, and number them anew."""
    return df.withColumn(ROW, F.monotonically_increasing_id())


def numbered_once(df: DataFrame, label: str) -> DataFrame:
    """Rows with a number of their own, the same for every read: numbered while they are
    stored. A table that has its numbers stays as it is."""
    return df if ROW in df.columns else stored(numbered(df), label)


def text(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def digest(value: Column) -> Column:
    """Sixteen bytes of SHA-256: a key that stands for a whole text."""
    return F.substring(F.unhex(F.sha2(value, 256)), 1, 16)


def remainder(modulus: int, name: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``modulus``; a missing id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(name).cast("string"), F.lit(""))), F.lit(modulus))


def about(df: DataFrame, rows: int, *key: str) -> DataFrame:
    """A sample of about ``rows`` rows, chosen by a hash of ``key``; all if there are fewer."""
    total = df.count()
    share = 1.0 if total <= rows else rows / total
    return df.filter(drawn(*key) < F.lit(int(share * DRAWS)))


DRAWS = 1 << 52  # fine enough for a few rows out of any table


def drawn(*key: str) -> Column:
    """A number from 0 to below ``DRAWS`` by a hash of ``key``."""
    return F.shiftrightunsigned(F.xxhash64(F.lit("sample"), *key), 12)


def ordered(df: DataFrame, label: str, *order: Column) -> DataFrame:
    """``df`` stored in ``order``, with ``place``: the number of its row in it, from 0.

    The sort deals ranges of the order to tasks, and each writes one file; a row's place is
    its place in its file, plus the rows of the files before. Only the files are numbered
    together, and there are as many as shuffle partitions.
    """
    path = fresh_path(df.sparkSession, label)
    df.sort(*order).write.option("maxRecordsPerFile", 0).parquet(path)
    rows = df.sparkSession.read.schema(df.schema).parquet(path).select(
        "*", file_number().alias("_file"), F.col("_metadata.row_index").alias("_row")
    )
    counts = rows.groupBy("_file").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1))
    files = counts.select("_file", F.coalesce(before, F.lit(0)).alias("before"))
    return rows.join(F.broadcast(files), "_file").withColumn("place", F.col("before") + F.col("_row")).drop(
        "_file", "_row", "before"
    )


def file_number() -> Column:
    """The number that Spark gave the file of a row, in the order of the tasks that wrote."""
    return F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("bigint")
