"""WARC archives with an index, and reads of byte ranges by that index.

Each task writes its pages to archive files of its own, one gzip member per record, and
returns an index row for each: file, offset, length, URL and digest. The index is a
stored table, so archives are found through it alone; a file left by a lost or repeated
task is in no index row and is never read. Of pages with equal payloads the one with the
largest page_id keeps the payload, the others are revisit records that refer to it.

Reading starts from any selection of index rows. Rows are sorted by file and offset, and
those near each other are one range, read at once; a range lies in one stripe of a file,
which bounds what a task holds.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barline.llm.tables import stored, text
from barline.session import fresh_path

FILE_BYTES = 256 << 20
STRIPE, GAP = 4 << 20, 64 << 10
MIN_REVISIT = 0

# Fixed values of the archive format.
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE = "<urn:page:{}>"

INDEX = (
    "file string, offset bigint, length bigint, url string, payload_digest string, page_id bigint,"
    " record_type string, refers_to bigint, payload_bytes bigint"
)
INDEX_ARROW = pa.schema([
    ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("url", pa.string()),
    ("payload_digest", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()),
    ("refers_to", pa.int64()), ("payload_bytes", pa.int64()),
])
RECORDS = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
RECORDS_ARROW = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("record_type", pa.string()), ("refers_to", pa.int64()),
])


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """A record as a gzip member. A revisit keeps the HTTP head, and so the payload's length."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    name = lambda x: PAGE.format("" if x is None else x)
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {name(page_id)}",
        f"WARC-Date: {DATE}", f"WARC-Target-URI: {re.sub('[\r\n]', lambda m: f'%{ord(m.group()):02X}', url)}",
        f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response",
    ]
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {name(refers_to)}"]
    lines.append(f"Content-Length: {len(block)}")
    whole = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return gzip.compress(whole, 1, mtime=0)


def parsed(member: bytes) -> dict:
    """The fields of a record read back; a response's payload is measured anew."""
    whole = gzip.decompress(member)
    head, _, rest = whole.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    revisit = fields["WARC-Type"] == "revisit"
    length = int(re.search(rb"Content-Length: (\d+)", http)[1])
    number = lambda x: int(n) if (n := x[len("<urn:page:") : -1]) else None
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if not revisit and (len(payload) != length or base32_sha1(payload) != digest):
        raise ValueError(f"record {fields['WARC-Record-ID']} is damaged")
    return {
        "page_id": number(fields["WARC-Record-ID"]), "url": fields["WARC-Target-URI"], "payload_bytes": length,
        "payload_digest": digest, "record_type": fields["WARC-Type"],
        "refers_to": number(fields["WARC-Refers-To"]) if revisit else None,
    }


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def writer(folder: str):
    """A function over batches of (page_id, url, html, keeper, own) that writes archives."""

    def write(batches):
        target, place = opened(folder)
        stream, name, offset = None, "", 0
        for batch in batches:
            index = []
            for page, url, html, keeper, own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if stream is None:
                    name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                    stream = target.open_output_stream(f"{place}/{name}", compression=None)
                payload = (html or "").encode()
                digest = base32_sha1(payload)
                data = record(page, url or "", payload, digest, keeper, not own)
                stream.write(data)
                kind = "response" if own else "revisit"
                index.append((name, offset, len(data), url or "", digest, page, kind, None if own else keeper, len(payload)))
                offset += len(data)
                if offset >= FILE_BYTES:
                    stream.close()
                    stream = None
            if index:
                columns = zip(*index, strict=True)
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, INDEX_ARROW, strict=True)], schema=INDEX_ARROW)
        if stream is not None:
            stream.close()

    return write


PAGE_KEY = ["known", "page_id", "digest", "bytes"]  # a page and its payload, whichever row holds them


def keepers(pages: DataFrame) -> DataFrame:
    """The keys of pages with a payload that several rows have, and the page that holds it."""
    seen = stored(pages.groupBy(*PAGE_KEY).agg(F.count("*").alias("n")), "warc-payloads")
    shared = seen.filter(F.col("bytes") >= MIN_REVISIT).groupBy("digest", "bytes").agg(
        F.max(F.struct("known", "page_id")).alias("last"), F.sum("n").alias("n")
    )
    shared = stored(shared.filter("n > 1").select("digest", "bytes", "last"), "warc-shared")
    return seen.join(shared, ["digest", "bytes"]).select(*PAGE_KEY, "last")


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html) below ``folder``; the index.

    A null html is an empty payload, a null url an empty one. Of rows with one page_id and
    one payload that with the last url keeps it and the others refer to their own page_id.
    Rows are told apart by what they hold, so it does not matter how a read splits files.
    """
    target, place = opened(folder)
    target.create_dir(place)
    page, payload = F.col("page_id").cast("bigint"), text("html")
    rows = pages.select(
        page.isNotNull().alias("known"), F.coalesce(page, F.lit(0)).alias("page_id"), F.unhex(F.sha1(payload)).alias("digest"),
        F.octet_length(payload).alias("bytes"), text("url").alias("url"), payload.alias("html"),
    )
    marked = rows.join(stored(keepers(rows.drop("url", "html")), "warc-keepers"), PAGE_KEY, "left")
    first = F.row_number().over(Window.partitionBy(*PAGE_KEY).orderBy(F.desc("url"))) == 1
    own = F.col("last").isNull() | ((F.struct("known", "page_id") == F.col("last")) & first)
    marked = marked.select(
        F.when(F.col("known"), F.col("page_id")).alias("page_id"), "url", "html",
        F.when(F.col("last.known"), F.col("last.page_id")).alias("keeper"), own.alias("own"),
    )
    return stored(marked.mapInArrow(writer(folder), INDEX), "warc-index")


def ranges(index: DataFrame) -> DataFrame:
    """(file, low, high, parts) of the byte ranges that hold the records of ``index``."""
    within = Window.partitionBy("file", "stripe").orderBy("offset")
    rows = index.select("file", "offset", "length", F.floor(F.col("offset") / STRIPE).alias("stripe"))
    apart = F.col("offset") - F.lag(F.col("offset") + F.col("length")).over(within) > GAP
    rows = rows.withColumn("apart", F.coalesce(apart, F.lit(False)).cast("int"))
    rows = rows.withColumn("range", F.sum("apart").over(within))
    grouped = rows.groupBy("file", "stripe", "range").agg(
        F.min("offset").alias("low"), F.max(F.col("offset") + F.col("length")).alias("high"),
        F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("parts"),
    )
    return grouped.select("file", "low", "high", "parts").sortWithinPartitions("file", "low")


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records of the rows of ``index``, read by range and parsed."""

    def read(batches):
        source, place = opened(folder)
        for batch in batches:
            for x in batch.to_pylist():
                with source.open_input_file(f"{place}/{x['file']}") as archive:
                    data = archive.read_at(x["high"] - x["low"], x["low"])
                found = []
                for part in x["parts"]:
                    at = part["offset"] - x["low"]
                    found.append(parsed(data[at : at + part["length"]]))
                yield pa.RecordBatch.from_pylist(found, RECORDS_ARROW)

    return ranges(index).mapInArrow(read, RECORDS)


def archived(pages: DataFrame) -> DataFrame:
    """Write all pages, then read every record back through the index."""
    folder = fresh_path(pages.sparkSession, "warc")
    return read_records(write_archives(pages, folder), folder)
