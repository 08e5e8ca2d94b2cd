"""Operator 7, WARC: index first, then coalesced byte-range reads.

*Write.* Payload digests are taken first; the smallest ``page_id`` of each digest is the response, all
other records of the digest are revisits without payload. Each task appends its records, one gzip
member each, to archives of its own in the shared folder, and returns one index row per record: archive,
offset, length, URL, digest. A retried task writes new files under new names; only rows of tasks that
finished reach the index, so that files of lost attempts are never read.

*Read.* The index rows of the selected records are dealt out by archive and stretch, sorted by
offset, and neighbouring byte ranges are joined into one read. Every record is parsed, and payloads
are checked against length and digest.

A third of all pages may share one payload: the digest's smallest id is a minimum with map-side
combination, and the join that brings it back to the pages is salted.

Defined cases: null html is an empty payload, and empty payloads are equal to each other; a null
``page_id`` is never a response while its digest has other ids (rows without any id are all responses);
repeated rows of the smallest id are all responses; null URLs are empty; URLs are percent-encoded where
a header could not hold them; an empty table gives an empty index and result.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from base64 import b32encode
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.shared import shared_path

ARCHIVE_BYTES = 64 << 20
READ_BYTES = 8 << 20
#: Unwanted bytes that a read may run across rather than begin anew.
GAP_BYTES = 64 << 10
SALTS = 16
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, archive string, offset bigint, length bigint"
RECORD = "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, payload binary"


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _id(urn: str) -> int | None:
    number = urn.strip("<>").rpartition(":")[2]
    return int(number) if number else None


def record(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record; a revisit carries the HTTP head only."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%-._~' + chr(39))}", f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_urn(refers_to)}"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """The fields of one record; a damaged one raises."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    field = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    size = int(field["Content-Length"])
    if not first.startswith("WARC/") or rest[size:] != b"\r\n\r\n":
        raise ValueError("damaged record")
    http, _, payload = rest[:size].partition(b"\r\n\r\n")
    length = int(next(line for line in http.decode().split("\r\n") if line.startswith("Content-Length:")).split(":")[1])
    kind, digest = field["WARC-Type"], field["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != length or b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError("payload does not match its length or digest")
    return {"page_id": _id(field["WARC-Record-ID"]), "url": field["WARC-Target-URI"], "record_type": kind, "refers_to": _id(field["WARC-Refers-To"]) if "WARC-Refers-To" in field else None, "payload_bytes": length, "payload_digest": digest, "payload": payload if kind == "response" else None}


def write_archives(spark: SparkSession, pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write all pages as archives under ``folder``; returns the index, written there as Parquet."""
    plain = pages.select(F.col(id_col).cast("long").alias("page_id"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    digested = plain.withColumn("digest", F.sha1("html")).withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int"))
    first = digested.groupBy("digest").agg(F.min("page_id").alias("first"))
    spread = first.select("digest", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    rows = digested.join(spread, ["digest", "salt"]).select("page_id", "url", "html", "digest", "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(f"{folder}/archives")
        system.create_dir(root, recursive=True)
        name, stream, at = "", None, 0
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if stream is None or at >= archive_bytes:
                    if stream is not None:
                        stream.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    stream = system.open_output_stream(f"{root}/{name}", compression=None)
                payload, digest = row["html"].encode(), b32encode(bytes.fromhex(row["digest"])).decode()
                revisit = row["page_id"] != row["first"]
                packer = zlib.compressobj(4, zlib.DEFLATED, 31)
                data = packer.compress(record(row["page_id"], row["url"], payload, digest, row["first"], revisit)) + packer.flush()
                stream.write(data)
                out.append((row["page_id"], row["url"], "revisit" if revisit else "response", row["first"] if revisit else None, len(payload), digest, name, at, len(data)))
                at += len(data)
            kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
            cols = list(zip(*out, strict=True)) if out else [[]] * 9
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=[c.split()[0] for c in INDEX.split(", ")])
        if stream is not None:
            stream.close()

    rows.mapInArrow(run, INDEX).write.parquet(f"{folder}/index")
    return spark.read.parquet(f"{folder}/index")


def coalesce(ranges: list[tuple[int, int]], gap: int = GAP_BYTES, most: int = READ_BYTES) -> list[tuple[int, int, list[int]]]:
    """(start, end, members) of the reads that cover the sorted ranges ``(offset, length)``."""
    reads: list[tuple[int, int, list[int]]] = []
    for k, (offset, length) in enumerate(ranges):
        if reads and offset - reads[-1][1] <= gap and offset + length - reads[-1][0] <= most:
            start, end, members = reads[-1]
            members.append(k)
            reads[-1] = (start, max(end, offset + length), members)
        else:
            reads.append((offset, offset + length, [k]))
    return reads


def read_records(index: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records of the given index rows, read back from the archives."""
    names = [c.split()[0] for c in RECORD.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(f"{folder}/archives")
        name, file = None, None
        for batch in batches:
            rows = batch.to_pylist()
            lo = 0
            while lo < len(rows):  # rows are sorted by archive and offset
                hi = lo
                while hi < len(rows) and rows[hi]["archive"] == rows[lo]["archive"]:
                    hi += 1
                if rows[lo]["archive"] != name:
                    if file is not None:
                        file.close()
                    name = rows[lo]["archive"]
                    file = system.open_input_file(f"{root}/{name}")
                for start, end, members in coalesce([(r["offset"], r["length"]) for r in rows[lo:hi]]):
                    data = file.read_at(end - start, start)
                    out = []
                    for k in members:
                        own = rows[lo + k]
                        found = parse(zlib.decompress(data[own["offset"] - start : own["offset"] - start + own["length"]], 31))
                        if not payloads:
                            found["payload"] = None
                        out.append([found[c] for c in names])
                    cols = list(zip(*out, strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)
                lo = hi
        if file is not None:
            file.close()

    # the index is small, the reads behind it are not: partitions follow the archived bytes
    total = index.agg(F.sum("length").alias("n")).first()["n"] or 0
    least = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least, -(-total // (4 * READ_BYTES)))
    stretch = (F.col("offset") / F.lit(READ_BYTES)).cast("long")
    placed = index.select("archive", "offset", "length", stretch.alias("stretch"))
    return placed.repartition(parts, "archive", "stretch").sortWithinPartitions("archive", "offset").select("archive", "offset", "length").mapInArrow(run, RECORD)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole ``pages`` table, written and read back."""
    folder = shared_path(spark, f"warc/{uuid.uuid4().hex}")
    index = write_archives(spark, spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    return read_records(index, folder, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
