"""WARC archives of web pages: deduplicating writer, index first, coalesced range reads.

``write_archives`` writes gzip-per-record WARC files under a shared folder and
returns the index: one row per record with archive, offset, length, URL and
digest. The index is the commit: it is a Spark table, so it names only files
that a finished task closed. A file of a lost task stays unread.

``read_records`` takes any selection of index rows, sorts each archive's byte
ranges, merges neighbours whose gap is small into one read of bounded length,
and cuts the records out of it.

Equal payloads of ``min_bytes`` or more share one ``response`` record, that
with the smallest page id; the others are ``revisit`` records that name it and
hold no payload. Rows that repeat the smallest page id are all responses, and
a null page id never is the smallest unless all are null.

Null html is an empty payload. A null URL is written as an empty one; control
characters and spaces in URLs are percent-encoded. Null page ids are kept.
Other columns of the input are ignored. An empty table gives an empty index.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelake.llm.common import map_rows, written

MIN_DEDUP_BYTES = 100
ARCHIVE_BYTES = 64 << 20
MAX_GAP = 64 << 10
MAX_RANGE = 8 << 20
READ_BYTES = 16 << 20  # archive bytes that a task reads, about
# The record date (a run's own time would make archives differ from run to run) and the revisit profile.
RECORD_DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX_SCHEMA = (
    "archive string, offset long, length long, page_id long, url string, digest string, record_type string, refers_to long"
)
RECORD_SCHEMA = "page_id long, url string, record_type string, refers_to long, digest string, payload string"


def filesystem(uri: str):
    """The file system and path of a folder or file that all executors share, from its URI."""
    from pyarrow import fs

    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def _quoted(url: str | None) -> str:
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url or "")


def record_bytes(page_id, url, digest, record_type, refers_to, payload: bytes) -> bytes:
    """One record, uncompressed."""
    key = f"{page_id}|{url}|{digest}|{record_type}"
    head = [
        "WARC/1.1",
        f"WARC-Type: {record_type}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, key)}>",
        f"WARC-Date: {RECORD_DATE}",
        f"WARC-Target-URI: {_quoted(url)}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Page-Id: {'' if page_id is None else page_id}",
    ]
    if record_type == "revisit":
        payload = b""
        head += [f"WARC-Profile: {PROFILE}", f"X-Refers-To-Page-Id: {refers_to}"]
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    n = int(fields["Content-Length"])
    payload, digest = rest[:n], fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if lines[0] != "WARC/1.1" or rest[n:] != b"\r\n\r\n":
        raise ValueError(f"not one WARC record: {lines[0]!r}")
    kind = fields["WARC-Type"]
    if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} differs from its digest")
    number = lambda k: int(fields[k]) if fields.get(k) else None
    return {
        "page_id": number("X-Page-Id"),
        "url": fields["WARC-Target-URI"],
        "record_type": kind,
        "refers_to": number("X-Refers-To-Page-Id"),
        "digest": digest,
        "payload": payload.decode() if kind == "response" else None,
    }


def tagged(pages: DataFrame, min_bytes: int = MIN_DEDUP_BYTES) -> DataFrame:
    """Pages with digest, record type and the response that a revisit names.

    Only digests and ids are aggregated (combined before the shuffle). The
    result is written and read back, so that the join stands on a shuffle of its own
    on both sides: AQE can then split the payload side where one payload is hot.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload")
    ).withColumn("digest", F.sha2(F.col("payload").cast("binary"), 256))
    first = (
        rows.where(F.octet_length("payload") >= min_bytes)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
    )
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    first = written(pages.sparkSession, first.select("digest", "first_id"), "warc-first")
    return rows.join(first, "digest", "left").select(
        "page_id",
        "url",
        "digest",
        "payload",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first_id")).alias("refers_to"),
    )


def write_archives(pages: DataFrame, root: str, min_bytes: int = MIN_DEDUP_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record per row of ``pages (page_id, url, html)`` under ``root``; returns the index, to be written once."""

    def run(batches):
        files, base = filesystem(root)
        out, name, at = None, None, 0
        try:
            for b in batches:
                rows = {k: [] for k in ("archive", "offset", "length")}
                for page_id, url, digest, payload, kind, refers in zip(
                    b["page_id"], b["url"], b["digest"], b["payload"], b["record_type"], b["refers_to"], strict=True
                ):
                    if out is None or at >= archive_bytes:
                        if out is not None:
                            out.close()
                        files.create_dir(base, recursive=True)
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = files.open_output_stream(f"{base}/{name}", compression=None)
                    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                    member = packer.compress(record_bytes(page_id, url, digest, kind, refers, payload.encode())) + packer.flush()
                    out.write(member)
                    for k, v in (("archive", name), ("offset", at), ("length", len(member))):
                        rows[k].append(v)
                    at += len(member)
                yield rows | {k: b[k] for k in ("page_id", "url", "digest", "record_type", "refers_to")}
        finally:
            if out is not None:
                out.close()

    return map_rows(tagged(pages, min_bytes), run, INDEX_SCHEMA)


def byte_ranges(selected: DataFrame, max_gap: int = MAX_GAP, max_range: int = MAX_RANGE) -> DataFrame:
    """Index rows as few reads: per archive, records in offset order share a read until a gap above ``max_gap`` or
    the next multiple of ``max_range``. A window holds the index rows of one archive, whose size is bounded."""
    w = Window.partitionBy("archive").orderBy("offset")
    end = F.lag(F.col("offset") + F.col("length")).over(w)
    cell = F.floor(F.col("offset") / max_range)
    starts = end.isNull() | (F.col("offset") - end > max_gap) | (cell != F.lag(cell).over(w))
    return (
        selected.select("archive", "offset", "length", F.when(starts, 1).otherwise(0).alias("new"))
        .withColumn("read", F.sum("new").over(w))
        .groupBy("archive", "read")
        .agg(F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("records"))
        .select("archive", F.col("records.offset").alias("offsets"), F.col("records.length").alias("lengths"))
    )


def read_records(selected: DataFrame, root: str, max_gap: int = MAX_GAP, max_range: int = MAX_RANGE) -> DataFrame:
    """The records of the selected index rows: ``page_id, url, record_type, refers_to, digest, payload`` (null for revisits).

    Reads are dealt to as many tasks as their bytes need: the rows that describe them are so few that Spark would
    leave them all to one.
    """

    def run(batches):
        files, base = filesystem(root)
        for b in batches:
            for name, offsets, lengths in zip(b["archive"], b["offsets"], b["lengths"], strict=True):
                with files.open_input_file(f"{base}/{name}") as f:
                    raw = f.read_at(offsets[-1] + lengths[-1] - offsets[0], offsets[0])
                found = [
                    parse_record(zlib.decompress(raw[o - offsets[0] : o - offsets[0] + n], 31))
                    for o, n in zip(offsets, lengths, strict=True)
                ]
                yield {k: [r[k] for r in found] for k in found[0]}

    size = selected.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("n")).first()["n"]
    ranges = byte_ranges(selected, max_gap, max_range).repartition(max(1, -(-size // READ_BYTES)), "archive", F.get("offsets", 0))
    return map_rows(ranges, run, RECORD_SCHEMA)
