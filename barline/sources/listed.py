"""Documents of listed files alone, each with its place in its file.

Spark's readers take folders, or a list of paths on the driver. A manifest may be longer
than that, and its folders hold files that are not to be read, so here the tasks open the
paths that they are dealt: first for their sizes, then, cut into ranges of bytes, for their
lines. A range has the lines that begin in it, so every line belongs to one, and a line's
first byte is its place, whatever the ranges are. Files are opened by pyarrow's file
systems, by URI or as local paths.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.functions.keys import decoded

RANGE_BYTES = 64 << 20
READ_BYTES = 1 << 20
ROWS, TEXT_BYTES = 1000, 4 << 20  # the most lines and text of a batch handed to Spark


def plain_path(path: Column, base: str) -> Column:
    """A path or URI as an absolute path without percent-encoding; other schemes keep theirs."""
    uri = path.rlike("^[A-Za-z][A-Za-z0-9+.-]*:/")
    local = F.regexp_replace(decoded(path), "^file:/+", "/")
    return F.when(uri, local).when(path.startswith("/"), path).otherwise(F.concat(F.lit(f"{base.rstrip('/')}/"), path))


def opened(place: str) -> tuple[fs.FileSystem, str]:
    return (fs.LocalFileSystem(), place) if place.startswith("/") else fs.FileSystem.from_uri(place)


def sizes(places: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The size of each listed file; null if there is none."""
    for batch in places:
        found = []
        for place in batch.column(0).to_pylist():
            files, path = opened(place)
            info = files.get_file_info(path)
            found.append(info.size if info.type == fs.FileType.File else None)
        yield pa.record_batch([batch.column(0), pa.array(found, pa.int64())], names=["place", "size"])


def lines(path: str, files: fs.FileSystem, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(place, line) of the lines that begin from ``start`` to before ``end``."""
    with files.open_input_file(path) as file:
        at, held = max(start - 1, 0), b""
        file.seek(at)
        skip = start > 0  # up to the end of the line that begins before the range
        while True:
            data = file.read(READ_BYTES)
            held += data
            while (cut := held.find(b"\n")) >= 0 or (not data and held):
                line = held if cut < 0 else held[:cut]
                if not skip:
                    if at >= end:
                        return
                    yield at, line.removesuffix(b"\r")
                skip = False
                step = len(line) + (cut >= 0)
                at, held = at + step, held[step:]
            if not data or at >= end and not skip:
                return


def contents(one_per_file: bool):
    def read(ranges: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in ranges:
            out, size = [], 0
            for place, start, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                files, path = opened(place)
                if one_per_file:
                    with files.open_input_file(path) as file:
                        found = iter([(0, file.read())])
                else:
                    found = lines(path, files, start, end)
                for at, text in found:
                    out.append((place, text.decode("utf-8", "replace"), [at]))
                    size += len(text)
                    if len(out) >= ROWS or size >= TEXT_BYTES:
                        yield documents(out)
                        out, size = [], 0
            yield documents(out)

    return read


def documents(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.list_(pa.int64()))
    columns = list(zip(*rows, strict=True)) or [()] * 3
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["path", "doc", "at"])


def listed_documents(
    spark: SparkSession, manifest: DataFrame, base: str, one_per_file: bool = True, range_bytes: int = RANGE_BYTES
) -> tuple[DataFrame, DataFrame]:
    """((path, doc, at) rows of the files a manifest lists, the listed paths without a file).

    Lines are paths below ``base``, absolute paths or URIs; a file that is listed twice is
    read once. No other file is opened, or its folder listed. ``at`` is a document's place
    in its file. A listed file that cannot be read fails the job.
    """
    wanted = manifest.select(F.col("path").alias("line"), plain_path(F.col("path"), base).alias("place"))
    found = wanted.select("place").distinct().mapInArrow(sizes, "place string, size bigint")
    starts = F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(range_bytes).cast("bigint"))
    if one_per_file:
        starts = F.array(F.lit(0).cast("bigint"))
    ranges = found.filter("size is not null").select("place", F.explode(starts).alias("start"))
    ranges = ranges.withColumn("end", F.col("start") + range_bytes).repartition("place", "start")
    docs = ranges.mapInArrow(contents(one_per_file), "path string, doc string, at array<bigint>")
    missing = wanted.join(found.filter("size is null"), "place", "left_semi")
    return docs, missing.select(F.col("line").alias("path")).distinct()
