"""WARC archives: a writer with revisit records and a reader that splits files by byte ranges.

Writing: every record is a gzip member of its own. A payload's first record (smallest page id among equal
payloads) is a ``response``; later ones are ``revisit`` records with the HTTP head and no payload.
Reading: tasks own byte ranges of the files. A task looks for the gzip magic inside its range, takes a find
for a member only if its first bytes inflate to a WARC head, and owns all records that start inside its
range, reading past its end to finish the last. Chance finds inside compressed data fail the check, or lie
inside a member that is already being read and are stepped over.

Contract: one record per page row, repeated rows included. A null payload is empty. A null page id gets a
record without an id and never serves as the target of a revisit. Payloads below ``least`` bytes always
become responses. An empty table gives an empty archive and an empty result. Urls are percent-encoded where
they hold blanks, line breaks or bytes outside ASCII. Nothing is truncated.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclake.llm.common import blocks, shared_dir, small_batches, table
from civiclake.llm.files import Writer, make_folder, open_file

MAGIC = b"\x1f\x8b\x08"
_DATE = b"1970-01-01T00:00:00Z"  # the pages carry no time; a fixed one keeps repeated tasks equal
_CHUNK = 1 << 20
_PIECE = 8 << 10
_HEAD = 512  # inflated bytes that must show a WARC head


def digest(payload: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One gzip member holding one record."""
    name = b"none" if page_id is None else str(page_id).encode()
    body = b"" if refers_to is not None else payload
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    lines = [b"WARC/1.1", b"WARC-Type: " + (b"response" if refers_to is None else b"revisit"),
             b"WARC-Record-ID: <urn:page:%s>" % name, b"WARC-Date: " + _DATE,
             b"WARC-Target-URI: " + quote(url or "", safe=":/?#[]@!$&'()*+,;=%-._~").encode(),
             b"WARC-Payload-Digest: sha1:" + digest(payload).encode(),
             b"Content-Type: application/http; msgtype=response", b"Content-Length: %d" % (len(http) + len(body))]
    if refers_to is not None:
        lines += [b"WARC-Refers-To: <urn:page:%d>" % refers_to,
                  b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(b"\r\n".join(lines) + b"\r\n\r\n" + http + body + b"\r\n\r\n") + packer.flush()


def write(pages: DataFrame, folder: str, least: int = 0) -> DataFrame:
    """Writes the archive into ``folder`` (which exists); returns the files (path, bytes), one row each.

    Equal payloads are found by the SHA-1 of their bytes. Who refers to whom is decided on (id, digest) rows,
    pre-aggregated per digest; payloads move only once, dealt by page id, so a common payload heats no task.
    """
    small_batches(pages.sparkSession)
    body = F.coalesce(F.col("html"), F.lit(""))
    size = F.octet_length(F.encode(body, "UTF-8"))
    keys = pages.select("page_id", F.sha1(F.encode(body, "UTF-8")).alias("sha"), size.alias("size"))
    first = keys.groupBy("sha").agg(F.min("page_id").alias("first"))
    refers = (keys.where((F.col("size") >= least) & F.col("page_id").isNotNull()).join(first, "sha")
              .where(F.col("page_id") != F.col("first")).select(F.col("page_id").alias("id"), F.col("sha").alias("id_sha"), "first").distinct())
    # A page id may come with several payloads; the digest is part of the key.
    told = (pages.select("page_id", "url", body.alias("html")).withColumn("sha", F.sha1(F.encode("html", "UTF-8")))
            .join(refers, F.col("page_id").eqNullSafe(F.col("id")) & (F.col("sha") == F.col("id_sha")), "left")
            .select("page_id", "url", "html", F.col("first").alias("refers_to")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = f"part-{TaskContext.get().partitionId():06d}.warc.gz"
        out = None
        for batch in blocks(batches, "html"):
            out = out or Writer(folder, name)
            for row in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to"))):
                out.write(record(row[0], row[1], (row[2] or "").encode(), row[3]))
        if out:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "bytes": [out.size]})

    return told.mapInArrow(run, "path string, bytes long")


class _Window:
    """A stretch of a file held in memory and moved along."""

    def __init__(self, file):
        self.file, self.start, self.data = file, 0, b""

    def load(self, at: int) -> int:
        """Makes bytes from ``at`` on available, all of the next piece where the file has it; their place in ``data``."""
        if not self.start <= at or at + _PIECE > self.start + len(self.data):
            self.file.seek(at)
            self.start, self.data = at, self.file.read(_CHUNK)
        return at - self.start


def _members(file, start: int, end: int) -> Iterator[bytes]:
    """Inflated members whose first byte lies in [start, end)."""
    window, at = _Window(file), start
    while at < end:
        k = window.load(at)
        found = window.data.find(MAGIC, k)
        if found < 0:
            if len(window.data) < _CHUNK:
                return
            at = max(at + 1, window.start + len(window.data) - len(MAGIC) + 1)
            continue
        at = window.start + found
        if at >= end:
            return
        member = _inflate(window, at)
        if member is None:
            at += 1
            continue
        data, length = member
        yield data
        at += length


def _inflate(window: _Window, at: int) -> tuple[bytes, int] | None:
    """Content and packed length of the member at ``at``; None unless it is a whole WARC record."""
    stream, parts, read, checked = zlib.decompressobj(31), [], 0, False
    try:
        while True:
            k = window.load(at + read)
            packed = window.data[k: k + _PIECE]
            if not packed:
                return None
            if not checked:
                if not zlib.decompressobj(31).decompress(packed, _HEAD).startswith(b"WARC/1."):
                    return None
                checked = True
            parts.append(stream.decompress(packed))
            read += len(packed)
            if stream.eof:
                return b"".join(parts), read - len(stream.unused_data)
    except zlib.error:
        return None


def _fields(head: bytes) -> dict[bytes, bytes]:
    lines = head.split(b"\r\n")[1:]
    return {k.lower(): v.strip() for k, v in (line.split(b":", 1) for line in lines if b":" in line)}


def _page(value: bytes | None) -> int | None:
    number = (value or b"").removeprefix(b"<urn:page:").removesuffix(b">")
    return int(number) if number.lstrip(b"-").isdigit() else None


def parse(member: bytes) -> dict:
    """Fields and payload of a record; the digest and size of a response are taken from its payload."""
    head, _, block = member.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = block[: int(fields[b"content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    kind = fields[b"warc-type"].decode()
    whole = kind == "response"
    return {"page_id": _page(fields.get(b"warc-record-id")), "url": fields.get(b"warc-target-uri", b"").decode(),
            "payload": payload if whole else None,
            "payload_bytes": len(payload) if whole else int(_fields(http)[b"content-length"]),
            "payload_digest": digest(payload) if whole else fields[b"warc-payload-digest"].decode().removeprefix("sha1:"),
            "record_type": kind, "refers_to": _page(fields.get(b"warc-refers-to"))}


#: Fields of a record that a reader can return.
KINDS = {"page_id": pa.int64(), "url": pa.string(), "payload": pa.binary(), "payload_bytes": pa.int64(),
         "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64()}
_SQL = {"page_id": "long", "url": "string", "payload": "binary", "payload_bytes": "long", "payload_digest": "string",
        "record_type": "string", "refers_to": "long"}


def read(files: DataFrame, columns: tuple[str, ...] = tuple(KINDS), split: int = 128 << 20) -> DataFrame:
    """Records of the files (path, bytes), read by ranges of ``split`` bytes."""
    steps = F.explode(F.expr(f"sequence(0L, greatest(bytes - 1, 0L), {split}L)"))
    ranges = files.select("path", "bytes", steps.alias("start"))
    ranges = ranges.select("path", "start", F.least("bytes", F.col("start") + split).alias("end"))
    # About a task per range: the count keeps Spark from joining these short rows into one task.
    ranges = ranges.repartition(max(1, ranges.count()), "path", "start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with open_file(row["path"]) as file:
                    rows, held = [], 0
                    for member in _members(file, row["start"], row["end"]):
                        one = parse(member)
                        rows.append([one[c] for c in columns])
                        held += len(member) if "payload" in columns else 100
                        if held > 4 << 20:
                            yield _batch(rows, columns)
                            rows, held = [], 0
                    if rows:
                        yield _batch(rows, columns)

    return ranges.mapInArrow(run, ", ".join(f"{c} {_SQL[c]}" for c in columns))


def _batch(rows: list[list], columns: tuple[str, ...]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(v), KINDS[c]) for c, v in zip(columns, zip(*rows))], list(columns))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records and read back."""
    folder = shared_dir(spark, "warc")
    make_folder(folder)
    index = f"{folder}-index"
    write(table(spark, sf_dir, "pages"), folder).write.parquet(index)
    files = spark.read.schema("path string, bytes long").parquet(index)
    return read(files, ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
