"""WARC archives as chunked record tables.

Writing: one gzip member per record, in ascending page order
within each file, files of bounded size. Records with equal payloads of a minimum size are kept once and revisited
by the others. Reading: an archive is streamed; each record becomes rows of
(record id, chunk number) that carry a piece of the payload, the bytes so far
and the SHA-256 so far. No record is held whole: memory is one chunk, whatever
the length of the payload.

Defined results: null html is an empty payload. Of equal payloads the rows with
the smallest page id are responses (all of them, if that row is repeated), the
others revisits; null ids come last, and if all are null all are responses.
Null URLs are written as ``urn:page:<id>``. Extra columns are ignored. An empty
table gives no files and no rows.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from threadloom.llm.base import query, table, written
from threadloom.llm.files import new_file, open_file
from threadloom.session import scratch_path

FILE_BYTES = 64 << 20
CHUNK_BYTES = 256 << 10
MIN_REVISIT = 100


def assign_types(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """page_id, url, html (never null) and refers_to (null for responses).

    Digests are grouped before anything is joined: groups of one row and small
    payloads never take part, and the pages themselves move once, by page id.
    """
    pages = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    digests = pages.where(F.octet_length("html") >= min_bytes).select(
        "page_id", F.sha2(F.col("html").cast("binary"), 256).alias("digest")
    )
    shared = (
        digests.groupBy("digest")
        .agg(F.min("page_id").alias("refers_to"), F.count("*").alias("copies"))
        .where("copies > 1 and refers_to is not null")
        .drop("copies")
    )
    # one row per digest on one side: a digest that many pages share is split by the skew join
    revisits = (
        digests.join(shared, "digest")
        .where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
        .select(F.col("page_id").alias("revisit_id"), F.col("digest").alias("revisit_digest"), "refers_to")
        .distinct()
    )
    return pages.join(
        revisits,
        pages["page_id"].eqNullSafe(revisits["revisit_id"])
        & (F.sha2(F.col("html").cast("binary"), 256) == F.col("revisit_digest")),
        "left",
    ).select("page_id", "url", "html", "refers_to")


def _record(page_id, url, payload: bytes, refers_to) -> Iterator[bytes]:
    """Header and body of one record; the payload is not copied."""
    kind = "response" if refers_to is None else "revisit"
    name = "null" if page_id is None else str(page_id)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    target = re.sub(r"[\r\n]", " ", url) if url else f"urn:page:{name}"
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{name}>",
        f"WARC-Target-URI: {target}",
        "WARC-Date: 2000-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha256:{hashlib.sha256(payload).hexdigest()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(http) + (len(payload) if refers_to is None else 0)}",
    ]
    if refers_to is not None:
        lines.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    yield ("\r\n".join(lines) + "\r\n\r\n").encode() + http
    if refers_to is None:
        yield payload
    yield b"\r\n\r\n"


def write_archives(pages: DataFrame, root: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes the records of ``assign_types`` below ``root``; table of (path, records, bytes)."""
    schema = "path string, records bigint, bytes bigint"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        rows = (row for batch in batches for row in _rows(batch))
        number, pending = 0, next(rows, None)
        while pending is not None:
            path = f"{root}/part-{part:05d}-{number:05d}.warc.gz"
            size = records = 0
            with new_file(path) as out:
                while pending is not None and size < file_bytes:
                    page_id, url, payload, refers_to = pending
                    pack = zlib.compressobj(1, wbits=31)
                    for piece in _record(page_id, url, payload, refers_to):
                        view = memoryview(piece)
                        for at in range(0, len(view), CHUNK_BYTES):
                            size += out.write(pack.compress(view[at : at + CHUNK_BYTES]))
                    size += out.write(pack.flush())
                    records += 1
                    pending = next(rows, None)
            number += 1
            yield pa.RecordBatch.from_pydict({"path": [path], "records": [records], "bytes": [size]})

    def _rows(batch):
        for i in range(batch.num_rows):
            yield (batch[0][i].as_py(), batch[1][i].as_py(), batch[2][i].as_buffer(), batch[3][i].as_py())

    ordered = pages.select("page_id", "url", F.col("html").cast("binary"), "refers_to").sortWithinPartitions("page_id", "url")
    return ordered.mapInArrow(write, schema)


class _Stream:
    """Bytes of a gzip file of many members, read as asked for."""

    def __init__(self, source, size: int):
        self.source, self.size = source, size
        self.unpack = zlib.decompressobj(wbits=31)
        self.raw, self.held, self.ended = b"", b"", False

    def _more(self) -> bool:
        while not self.ended:
            if self.unpack.eof:
                self.raw = self.unpack.unused_data + self.raw
                self.unpack = zlib.decompressobj(wbits=31)
            if not self.raw:
                self.raw = self.source.read(self.size)
                if not self.raw:
                    self.ended = True
                    return False
            got = self.unpack.decompress(self.raw, self.size)
            self.raw = self.unpack.unconsumed_tail if not self.unpack.eof else b""
            if got:
                self.held += got
                return True
        return False

    def line(self) -> bytes | None:
        while (at := self.held.find(b"\r\n")) < 0:
            if not self._more():
                return None
        line, self.held = self.held[:at], self.held[at + 2 :]
        return line

    def upto(self, n: int) -> bytes:
        if not self.held and not self._more():
            raise EOFError("an archive ends inside a record")
        out, self.held = self.held[:n], self.held[n:]
        return out


def _headers(stream: _Stream) -> dict[str, str]:
    found: dict[str, str] = {}
    while line := stream.line():
        name, _, value = line.decode().partition(":")
        found[name.strip().lower()] = value.strip()
    return found


CHUNK_SCHEMA = (
    "record_id string, record_type string, refers_to string, url string, chunk_no int, data binary, "
    "bytes_so_far bigint, digest_so_far string, last boolean, payload_bytes bigint, payload_digest string"
)


def _chunks(stream: _Stream, chunk_bytes: int) -> Iterator[tuple]:
    while (line := stream.line()) is not None:
        if not line:
            continue
        head = _headers(stream)
        length = int(head["content-length"])
        http_size = 0
        http: dict[str, str] = {}
        while part := stream.line():
            http_size += len(part) + 2
            name, _, value = part.decode().partition(":")
            http[name.strip().lower()] = value.strip()
        left = length - http_size - 2
        digest, so_far, number = hashlib.sha256(), 0, 0
        stated = head["warc-payload-digest"].removeprefix("sha256:")
        base = (head["warc-record-id"], head["warc-type"], head.get("warc-refers-to"), head["warc-target-uri"])
        size = int(http["content-length"])
        while True:
            parts, room = [], min(left, chunk_bytes)
            while room:
                piece = stream.upto(room)
                parts.append(piece)
                room -= len(piece)
            data = b"".join(parts)
            digest.update(data)
            left -= len(data)
            so_far += len(data)
            if not left and base[1] == "response" and digest.hexdigest() != stated:
                raise ValueError(f"digest of {base[0]} differs")
            yield (*base, number, data, so_far, digest.copy().hexdigest(), not left, size, stated)
            number += 1
            if not left:
                break
        stream.line(), stream.line()


def read_archives(files: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Chunk rows of the archives named in ``path``; each file is streamed by one task."""
    fields = [part.split()[0] for part in CHUNK_SCHEMA.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.string()] * 4 + [pa.int32(), pa.binary(), pa.int64(), pa.string(), pa.bool_(), pa.int64(), pa.string()]

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=fields)

        for batch in batches:
            for path in batch["path"].to_pylist():
                with open_file(path) as source:
                    rows, held = [], 0
                    for row in _chunks(_Stream(source, 64 << 10), chunk_bytes):
                        rows.append(row)
                        held += len(row[5]) + 400
                        if held > 4 << 20:
                            yield batch_of(rows)
                            rows, held = [], 0
                    if rows:
                        yield batch_of(rows)

    return files.select("path").mapInArrow(read, CHUNK_SCHEMA)


def spread(files: DataFrame, key: str = "path") -> DataFrame:
    """One row a task, up to the parallelism of the session's shuffles."""
    count = files.count()
    parts = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(max(1, min(count, parts)), key)


_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages
), d AS (
  SELECT page_id, octet_length(encode(html)) AS n, sha256(html) AS digest FROM p
), g AS (SELECT digest, min(page_id) AS first_id, count(*) AS c FROM d WHERE n >= 100 GROUP BY digest)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d.digest AS payload_digest,
       CASE WHEN first_id IS NOT NULL AND c > 1 AND page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id IS NOT NULL AND c > 1 AND page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM d LEFT JOIN g ON d.digest = g.digest AND d.n >= 100
"""


@query("op5_warc_chunks", _SQL)
def op5_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "warc")
    files = written(write_archives(assign_types(table(spark, sf_dir, "pages")), root), "warc-files")
    page = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1)
    return (
        read_archives(spread(files))
        .where("last")
        .select(
            F.expr("try_cast(regexp_extract(record_id, '^<urn:page:(-?[0-9]+)>$', 1) as bigint)").alias("page_id"),
            "payload_bytes",
            "payload_digest",
            "record_type",
            page(F.col("refers_to")).try_cast("bigint").alias("refers_to"),
        )
    )
