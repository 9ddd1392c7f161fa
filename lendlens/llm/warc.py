"""WARC archives with revisit records.

Only headers (id, payload size, payload digest) are shuffled by digest: the
smallest id of a digest is its response, the others become revisit records
that name it. The decisions then meet the payloads again by id, which spreads
evenly whatever the digests, and each partition writes archives of its own:
gzipped record by record, with fresh headers, at most ``ARCHIVE_BYTES`` of
records each. Archives appear under their name only when complete.

Defined cases: a null payload is the empty one; payloads shorter than
``min_bytes`` are all responses; rows that repeat an id and payload are the
same capture (all response or all revisit); a null id is never the original
of others unless the payload has no other, and refers_to of a revisit is never
null; a null URL is written as an empty one; line breaks in URLs are
percent-encoded; other columns are ignored; an empty table writes no archive.
"""

from __future__ import annotations

import base64
import datetime as dt
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _shared as S

ARCHIVE_BYTES = 256 << 20  # record bytes, before compression
# Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HEX32, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

MANIFEST = "path string, records long"
RECORDS = ("page_id long, payload_bytes long, payload_digest string, record_type string, "
           "refers_to long, url string, payload binary")


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a text's UTF-8 bytes, in the JVM:
    five hex digits are four base32 digits."""
    hex_ = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hex_, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), _HEX32, _BASE32)


def resolve(headers: DataFrame, min_bytes: int = 0) -> DataFrame:
    """record_type and refers_to for headers (page_id, payload_bytes, payload_digest)."""
    many = S.materialised(
        headers.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest")
        .agg(F.min("page_id").alias("original"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and original is not null").drop("n"), "warc-originals")
    again = ((F.col("payload_bytes") >= min_bytes) & F.col("original").isNotNull()
             & ~F.col("original").eqNullSafe(F.col("page_id")))
    return (headers.join(many, "payload_digest", "left")
            .select("page_id", "payload_bytes", "payload_digest",
                    F.when(again, "revisit").otherwise("response").alias("record_type"),
                    F.when(again, F.col("original")).alias("refers_to")))


def _id(page: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page}:{digest}')}>"


def _record(row: dict, date: str) -> bytes:
    """One record; the page's ids travel in extension fields."""
    payload = row["payload"].encode("utf-8") if row["record_type"] == "response" else b""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {row['payload_bytes']}\r\n\r\n").encode()
    url = (row["url"] or "").replace("\r", "%0D").replace("\n", "%0A")
    head = ["WARC/1.1", f"WARC-Type: {row['record_type']}",
            f"WARC-Record-ID: {_id(row['page_id'], row['payload_digest'])}", f"WARC-Date: {date}",
            f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha1:{row['payload_digest']}",
            f"X-Payload-Length: {row['payload_bytes']}"]
    if row["page_id"] is not None:
        head.append(f"X-Page-ID: {row['page_id']}")
    if row["record_type"] == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_id(row['refers_to'], row['payload_digest'])}",
                 f"X-Refers-To-Page-ID: {row['refers_to']}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + len(payload)}"]
    return b"".join(["\r\n".join(head).encode("utf-8"), b"\r\n\r\n", http, payload, b"\r\n\r\n"])


def _member(raw: bytes) -> bytes:
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(raw) + squeeze.flush()


def _write(batches, uri: str, date: str, most: int) -> Iterator[pa.RecordBatch]:
    where, folder = S.filesystem(uri)
    part = TaskContext.get().partitionId()
    rows = (row for batch in batches for row in _dicts(batch))
    row, number = next(rows, None), 0
    while row is not None:
        path = f"{folder}/part-{part:05d}-{number:05d}.warc.gz"
        number, size, records = number + 1, 0, 0
        with S.committed(where, path) as out:
            out.write(_member(f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid4()}>\r\n"
                              f"WARC-Date: {date}\r\nContent-Type: application/warc-fields\r\n"
                              "Content-Length: 18\r\n\r\nformat: WARC/1.1\r\n\r\n\r\n".encode()))
            while row is not None and (size < most or not records):
                raw = _record(row, date)
                out.write(_member(raw))
                size, records = size + len(raw), records + 1
                row = next(rows, None)
        yield pa.RecordBatch.from_pydict({"path": [f"{uri}/{path.rpartition('/')[2]}"], "records": [records]})


def _dicts(batch: pa.RecordBatch) -> Iterator[dict]:
    for k in range(0, batch.num_rows, 256):  # few payloads as Python objects at once
        yield from batch.slice(k, 256).to_pylist()


def write_archives(pages: DataFrame, uri: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", min_bytes: int = 0, date: str | None = None,
                   archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write deduplicated archives under the folder ``uri``; returns the
    manifest (path, records), itself a table in the shared folder."""
    date = date or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    S.make(uri)
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(payload_col), F.lit("")).alias("payload"))
    headed = rows.withColumns({"payload_bytes": F.octet_length("payload").cast("long"),
                               "payload_digest": base32_sha1(F.col("payload"))})
    decided = resolve(headed.select("page_id", "payload_bytes", "payload_digest"), min_bytes).distinct()
    decided = decided.select(F.col("page_id").alias("d_id"), F.col("payload_digest").alias("d_digest"),
                             "record_type", "refers_to")
    joined = headed.join(decided, headed.page_id.eqNullSafe(decided.d_id)
                         & (headed.payload_digest == decided.d_digest))
    ready = joined.select("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to",
                          F.when(F.col("record_type") == "response", F.col("payload")).alias("payload"))
    return S.materialised(ready.mapInArrow(lambda it: _write(it, uri, date, archive_bytes), MANIFEST),
                          "warc-manifest")


class _Gunzip:
    """Bytes of a file of gzip members, read piece by piece."""

    def __init__(self, source):
        self.source, self.raw, self.ready = source, b"", bytearray()
        self.expand = zlib.decompressobj(31)

    def _more(self) -> bool:
        if self.expand.eof:
            self.raw = self.expand.unused_data
            self.expand = zlib.decompressobj(31)
        if not self.raw:
            self.raw = self.source.read(1 << 18)
            if not self.raw:
                return False
        self.ready += self.expand.decompress(self.raw)
        self.raw = b""
        return True

    def line(self) -> bytes:
        while (end := self.ready.find(b"\r\n")) < 0:
            if not self._more():
                return b""
        return self.read(end + 2)

    def read(self, n: int) -> bytes:
        while len(self.ready) < n:
            if not self._more():
                raise ValueError("the archive ends inside a record")
        out = bytes(self.ready[:n])
        del self.ready[:n]
        return out


def records(source) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of every record of a gzipped archive."""
    stream = _Gunzip(source)
    while version := stream.line():
        if not version.startswith(b"WARC/1."):
            raise ValueError("not a WARC record")
        fields = {}
        while (line := stream.line()) != b"\r\n":
            name, _, value = line.decode("utf-8").partition(":")
            fields[name.lower()] = value.strip()
        block = stream.read(int(fields["content-length"]))
        stream.read(4)
        yield fields, block


def _read(batches, with_payload: bool) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    size = 0
    names = [c.split()[0] for c in RECORDS.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]

    def out():
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    for batch in batches:
        for path in batch.column(0).to_pylist():
            where, name = S.filesystem(path)
            with where.open_input_stream(name, compression=None) as source:
                for fields, block in records(source):
                    if fields["warc-type"] == "warcinfo":
                        continue
                    payload = block[block.index(b"\r\n\r\n") + 4:]
                    digest, length = fields["warc-payload-digest"].removeprefix("sha1:"), int(fields["x-payload-length"])
                    if fields["warc-type"] == "response":
                        length = len(payload)
                        found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                        if found != digest:
                            raise ValueError(f"payload of {fields['warc-record-id']} doesn't match its digest")
                    page, refers = fields.get("x-page-id"), fields.get("x-refers-to-page-id")
                    rows.append((page and int(page), length, digest, fields["warc-type"],
                                 refers and int(refers), fields["warc-target-uri"],
                                 payload if with_payload and fields["warc-type"] == "response" else None))
                    size += len(payload) if with_payload else 0
                    if len(rows) >= 10_000 or size > 16 << 20:
                        yield out()
                        rows, size = [], 0
    if rows:
        yield out()


def read_archives(manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives that ``manifest`` lists."""
    paths = manifest.select("path").repartition(S.partitions(manifest.sparkSession))
    out = paths.mapInArrow(lambda it: _read(it, with_payload), RECORDS)
    return out if with_payload else out.drop("payload")
