"""Web archives: write records with an index, read selected records by coalesced byte ranges.

Every task writes its own archive of gzip members, one per record, and returns
one index row per record: file, offset, length, URL and digest.  A task that is
run again writes a new file; the index only names files of tasks that ended, so
an archive left by a lost executor is never read.  Reading sorts the selected
index rows by file and offset and fetches neighbouring records in one read.

Defined results: a null payload is empty; of rows with equal payloads of at least
``revisit_from`` bytes the smallest key is the response and the others refer to
it; rows that repeat that key are responses too; a null key is never smaller than
another, and where all keys are null all are responses.  Line ends inside a URL are
dropped, a null URL stays null.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolake.llm.common import as_uri, stored

INDEX = "file string, offset long, length long, key long, url string, digest string, record_type string"
RECORD = "key long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"
#: Records no further apart are fetched together, up to this much in one read.
GAP_BYTES, READ_BYTES = 64 << 10, 8 << 20
DATE = "2000-01-01T00:00:00Z"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: each 5 hexadecimal digits are 4 of base 32."""
    digits = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digits, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _header(lines: list[tuple[str, str]], first: str) -> bytes:
    return (first + "\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n").encode()


def _encode(key, url, payload: bytes, digest: str, refers_to, refers) -> bytes:
    http = _header([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))], "HTTP/1.1 200 OK")
    body = http if refers else http + payload
    name = "" if key is None else key
    lines = [("WARC-Type", "revisit" if refers else "response"), ("WARC-Record-ID", f"<urn:page:{name}>"), ("WARC-Date", DATE)]
    if url is not None:
        lines.append(("WARC-Target-URI", url.replace("\r", "").replace("\n", "")))
    if refers:
        lines += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                  ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    lines += [("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response"),
              ("Content-Length", str(len(body)))]
    return gzip.compress(_header(lines, "WARC/1.1") + body + b"\r\n\r\n", compresslevel=4, mtime=0)


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html",
                   revisit_from: int = 0) -> DataFrame:
    """Write one record per row below ``folder``; returns the written index."""
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    rows = pages.select(F.col(key).cast("long").alias("key"), F.col(url).alias("url"), body.alias("payload"))
    rows = rows.withColumn("digest", base32_sha1(F.col("payload"))).withColumn("bytes", F.octet_length("payload"))
    # Only payloads that occur more than once; written, so that Spark picks the join by its size.
    first = stored(rows.where(F.col("bytes") >= revisit_from).groupBy("digest").agg(
        F.min("key").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "payloads")
    refers = F.col("first").isNotNull() & (F.col("key").isNull() | (F.col("key") > F.col("first")))
    records = rows.join(first, "digest", "left").select("key", "url", "payload", "digest", "first", refers.alias("refers"))
    base = as_uri(folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(base)
        out = offset = path = None
        try:
            for batch in batches:
                index = []
                for row in batch.to_pylist():
                    if out is None:
                        system.create_dir(root, recursive=True)
                        path, offset = f"{root}/{uuid.uuid4().hex}.warc.gz", 0
                        out = system.open_output_stream(path, compression=None)
                    record = _encode(row["key"], row["url"], row["payload"], row["digest"], row["first"], row["refers"])
                    out.write(record)
                    index.append((path.rpartition("/")[2], offset, len(record), row["key"], row["url"], row["digest"],
                                  "revisit" if row["refers"] else "response"))
                    offset += len(record)
                if index:
                    names = ["file", "offset", "length", "key", "url", "digest", "record_type"]
                    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*index), kinds)], names)
        finally:
            if out is not None:
                out.close()

    return stored(records.mapInArrow(write, INDEX), "warc-index")


def decode(record: bytes) -> dict:
    """The fields of one gzip member; raises if a response's payload differs from its digest."""
    raw = zlib.decompress(record, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    body = rest[:int(fields["Content-Length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    length = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != length or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"Damaged record {fields['WARC-Record-ID']}")

    def number(value: str | None) -> int | None:
        digits = (value or "").removeprefix("<urn:page:").rstrip(">")
        return int(digits) if digits else None

    return {"key": number(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "record_type": kind,
            "payload_bytes": length, "payload_digest": digest, "refers_to": number(fields.get("WARC-Refers-To")),
            "payload": payload if kind == "response" else None}


def byte_ranges(rows: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
    """(file, start, end, [(offset, length)]) of reads that cover sorted ``rows`` of (file, offset, length)."""
    file = start = end = None
    held: list[tuple[int, int]] = []
    for name, offset, length in rows:
        if held and (name != file or offset - end > GAP_BYTES or offset + length - start > READ_BYTES):
            yield file, start, end, held
            held = []
        if not held:
            file, start, end = name, offset, offset
        held.append((offset, length))
        end = max(end, offset + length)
    if held:
        yield file, start, end, held


def read_records(selected: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """The records of the ``selected`` index rows, read from the archives below ``folder``."""
    base = as_uri(folder)
    spark = selected.sparkSession
    total = selected.agg(F.sum("length")).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // (64 << 20) + 1)
    order = selected.select("file", "offset", "length").repartitionByRange(parts, "file", "offset").sortWithinPartitions("file", "offset")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(base)
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns)))
            for file, start, end, records in byte_ranges(rows):
                with system.open_input_file(f"{root}/{file}") as source:
                    block = source.read_at(end - start, start)
                found = [decode(block[offset - start:offset - start + length]) for offset, length in records]
                if not with_payload:
                    for row in found:
                        row["payload"] = None
                yield pa.RecordBatch.from_pylist(found, schema)

    schema = pa.schema([("key", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])
    return order.mapInArrow(read, RECORD)

