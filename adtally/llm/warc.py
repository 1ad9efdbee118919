"""WARC archives and revisit resolution.

``write_responses`` writes pages as gzip-compressed WARC files, one record per page.
``resolve`` reads the headers of such archives, shuffles them by payload digest, names the
smallest page of each digest the original, and writes deduplicated archives in which the
others are revisit records with fresh headers. ``read`` reads archives, and
``with_originals`` joins revisit records to the responses they refer to.

Payloads are read and written file by file and never shuffled; only headers are. Files are
named anew in each attempt of a task, and only files listed by a finished task count, so a
lost executor leaves at most files that nothing reads.

Defined cases: a NULL html is an empty payload; payloads shorter than ``least`` bytes are
never revisits; repeated page ids give a record each, and of equal payloads the one that
comes first by (page id, file, place) is the response; a NULL page id sorts last.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally.session import scratch_path

FILE_BYTES = 64 << 20
READ_BYTES = 1 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
FILES = "file string, records long"
HEADERS = "file string, place long, page_id long, kind string, uri string, digest string, refers_to long, payload_bytes long, payload_digest string"


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page(name: str | None) -> int | None:
    body = (name or "").strip("<>").rpartition(":")[2]
    return int(body) if body else None


def _head(fields: list[tuple[str, str]]) -> bytes:
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode()


def _response(page_id: int | None, uri: str, date: str, payload: bytes, digest: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = _head(
        [("WARC-Type", "response"), ("WARC-Record-ID", _name(page_id)), ("WARC-Date", date), ("WARC-Target-URI", uri),
         ("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http; msgtype=response"),
         ("Content-Length", str(len(http) + len(payload)))]
    )
    return b"".join((head, http, payload, b"\r\n\r\n"))


def _revisit(page_id: int | None, uri: str, date: str, digest: str, original: int | None) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    head = _head(
        [("WARC-Type", "revisit"), ("WARC-Record-ID", _name(page_id)), ("WARC-Date", date), ("WARC-Target-URI", uri),
         ("WARC-Profile", PROFILE), ("WARC-Refers-To", _name(original)), ("WARC-Payload-Digest", f"sha256:{digest}"),
         ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(http)))]
    )
    return b"".join((head, http, b"\r\n\r\n"))


def _one_line(value: str | None) -> str:
    """A header value: line breaks and what would be trimmed at its ends are percent-encoded."""
    return "".join(f"%{ord(c):02X}" if c in "\r\n" else c for c in value or "").strip()


class _Writer:
    """Archives of about ``FILE_BYTES`` in one folder; a gzip member per record."""

    def __init__(self, folder: str):
        self.store, self.folder = pafs.FileSystem.from_uri(folder)
        self.store.create_dir(self.folder, recursive=True)
        self.prefix, self.out, self.done = folder.rstrip("/"), None, []

    def add(self, record: bytes) -> None:
        if self.out is None:
            name = f"{uuid.uuid4().hex}.warc.gz"
            self.out, self.name, self.records, self.size = self.store.open_output_stream(f"{self.folder}/{name}", compression=None), name, 0, 0
        pack = zlib.compressobj(4, zlib.DEFLATED, 31)
        member = pack.compress(record) + pack.flush()
        self.out.write(member)
        self.records, self.size = self.records + 1, self.size + len(member)
        if self.size >= FILE_BYTES:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((f"{self.prefix}/{self.name}", self.records))
            self.out = None

    def listed(self) -> pa.RecordBatch:
        self.close()
        return pa.RecordBatch.from_arrays(
            [pa.array([f for f, _ in self.done], pa.string()), pa.array([n for _, n in self.done], pa.int64())], ["file", "records"]
        )


def _members(stream) -> Iterator[bytes]:
    """The unpacked gzip members of a stream, one at a time."""
    unpack, parts, rest = zlib.decompressobj(31), [], b""
    while rest or (rest := stream.read(READ_BYTES)):
        parts.append(unpack.decompress(rest))
        rest = b""
        if unpack.eof:
            yield b"".join(parts)
            rest, unpack, parts = unpack.unused_data, zlib.decompressobj(31), []


def records(file: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, payload) of each record in an archive; a revisit's payload is empty."""
    store, path = pafs.FileSystem.from_uri(file)
    with store.open_input_stream(path, compression=None) as stream:
        for record in _members(stream):
            head, _, block = record.partition(b"\r\n\r\n")
            fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in head.decode().split("\r\n")[1:])
            yield fields, block[: int(fields["Content-Length"])].partition(b"\r\n\r\n")[2]


def write_responses(pages: DataFrame, folder: str, date: str = DATE) -> DataFrame:
    """Write a response record per row of ``page_id, url, html``; returns the files."""

    def write(batches):
        writer = _Writer(folder)
        for batch in batches:
            for page_id, url, html in zip(*(batch.column(c) for c in ("page_id", "url", "html")), strict=True):
                payload = (html.as_py() or "").encode()
                writer.add(_response(page_id.as_py(), _one_line(url.as_py()), date, payload, hashlib.sha256(payload).hexdigest()))
        yield writer.listed()

    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(write, FILES)


def read(files: DataFrame) -> DataFrame:
    """A row of headers for each record of the listed archives; digest and length of responses are taken from what was read."""

    def scan(batches):
        for batch in batches:
            for file in batch.column("file").to_pylist():
                rows = []
                for place, (head, payload) in enumerate(records(file)):
                    whole = head["WARC-Type"] == "response"
                    refers = head.get("WARC-Refers-To")
                    rows.append({
                        "file": file, "place": place, "page_id": _page(head["WARC-Record-ID"]), "kind": head["WARC-Type"],
                        "uri": head["WARC-Target-URI"], "digest": head["WARC-Payload-Digest"].partition(":")[2],
                        "refers_to": _page(refers) if refers else None, "payload_bytes": len(payload) if whole else None,
                        "payload_digest": hashlib.sha256(payload).hexdigest() if whole else None,
                    })
                yield pa.RecordBatch.from_pylist(rows, _ARROW)

    return _spread(files).mapInArrow(scan, HEADERS)


_ARROW = pa.schema([
    ("file", pa.string()), ("place", pa.int64()), ("page_id", pa.int64()), ("kind", pa.string()), ("uri", pa.string()),
    ("digest", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
])


def _spread(files: DataFrame) -> DataFrame:
    """A file list is tiny; deal it over enough tasks to read archives side by side."""
    return files.select("file").repartition(_tasks(files), "file")


def _tasks(files: DataFrame) -> int:
    return max(1, min(files.count(), 20_000))


def originals(headers: DataFrame, least: int = 100) -> DataFrame:
    """Headers with ``revisit`` and ``original``: the page of the response that has the same payload."""
    order = F.struct(F.col("page_id").isNull().alias("a"), F.col("page_id").alias("b"), F.col("file").alias("c"), F.col("place").alias("d"))
    first = headers.where(F.col("payload_bytes") >= least).groupBy("payload_digest").agg(F.min(order).alias("first"))
    first = first.withColumnRenamed("payload_digest", "_digest")
    same = (F.col("payload_digest") == F.col("_digest")) & (F.col("payload_bytes") >= least)
    # headers compress well, so that file sizes say little: never broadcast one side for them
    return headers.join(first.hint("merge"), same, "left").select(
        *headers.columns, (F.col("first").isNotNull() & (F.col("first") != order)).alias("revisit"), F.col("first.b").alias("original")
    )


def resolve(files: DataFrame, folder: str, least: int = 100, date: str = DATE) -> DataFrame:
    """Write deduplicated copies of the listed archives; returns the new files."""
    decided = originals(read(files), least).select("file", "place", "revisit", "original")

    def rewrite(key, rows):
        # the rows of one archive, at most FILE_BYTES of records
        fate = {r["place"]: (r["revisit"], r["original"]) for r in rows.to_pylist()}
        writer = _Writer(folder)
        for place, (head, payload) in enumerate(records(key[0].as_py())):
            revisit, original = fate[place]
            page, uri, digest = _page(head["WARC-Record-ID"]), head["WARC-Target-URI"], head["WARC-Payload-Digest"].partition(":")[2]
            writer.add(_revisit(page, uri, date, digest, original) if revisit else _response(page, uri, date, payload, digest))
        return pa.Table.from_batches([writer.listed()])

    # one task per archive, though its header rows are few
    return decided.repartition(_tasks(files), "file").groupBy("file").applyInArrow(rewrite, FILES)


def with_originals(headers: DataFrame, least: int = 100) -> DataFrame:
    """Every record with the length and digest of its full payload; revisits get them from the response they refer to."""
    # responses of at least `least` bytes have one record per digest
    full = headers.where((F.col("kind") == "response") & (F.col("payload_bytes") >= least)).select(
        F.col("payload_digest").alias("of"), F.col("payload_bytes").alias("full_bytes"), F.col("page_id").alias("full_page")
    )
    own = headers.where(F.col("kind") == "response").select(
        "page_id", "payload_bytes", "payload_digest", F.col("kind").alias("record_type"), F.lit(None).cast("long").alias("refers_to")
    )
    again = headers.where(F.col("kind") == "revisit").join(
        full.hint("merge"), (F.col("digest") == F.col("of")) & F.col("refers_to").eqNullSafe(F.col("full_page"))
    )
    return own.unionByName(
        again.select("page_id", F.col("full_bytes").alias("payload_bytes"), F.col("of").alias("payload_digest"),
                     F.col("kind").alias("record_type"), "refers_to")
    )


def _listed(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def deduplicate(pages: DataFrame, least: int = 100, date: str = DATE) -> DataFrame:
    """Archive the pages, write deduplicated archives, read those back: a row per page."""
    spark = pages.sparkSession
    root = re.sub("^file:/+", "file:///", scratch_path(spark, "warc"))
    raw = _listed(spark, write_responses(pages, f"{root}/raw", date), f"{root}/raw-files")
    new = _listed(spark, resolve(raw, f"{root}/deduplicated", least, date), f"{root}/new-files")
    headers = _listed(spark, read(new), f"{root}/headers")
    return with_originals(headers, least)


REVISIT_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(COALESCE(html, ''))) AS n, sha256(COALESCE(html, '')) AS digest FROM pages),
f AS (SELECT digest, MIN(page_id) AS first_page FROM p WHERE n >= 100 GROUP BY digest)
SELECT p.page_id, CAST(p.n AS BIGINT) AS payload_bytes, p.digest AS payload_digest,
  CASE WHEN f.first_page < p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN f.first_page < p.page_id THEN f.first_page END AS refers_to
FROM p LEFT JOIN f ON p.digest = f.digest AND p.n >= 100
"""
