"""WARC archives as a Spark data source, read and written.

Reading. The driver lists the files and plans one partition for about ``partition_bytes`` of them. A task parses the
headers of a record first, tests the predicates that Spark pushed down on record type and headers, and seeks over the
block of an unwanted record; a wanted payload is decoded only if the schema asks for it.

Writing. Each task writes files of about ``file_bytes`` under a name that holds the task's attempt; the driver's commit
lists the files of successful attempts in a manifest, and only files in a manifest are read, so lost and repeated tasks
leave nothing behind that counts.

Defined results: a null html is an empty payload, an empty table gives no records, an html of any length is one block
that a task holds whole; repeated rows are records of their own; other columns are ignored.

Records follow WARC/1.1: responses hold an HTTP message whose entity is gzip-coded; revisits hold none and refer to the
response. ``X-`` fields carry the row's id and the payload's length. Header values are percent-encoded where they hold
control characters, a percent sign or anything outside ASCII.
"""

from __future__ import annotations

import base64
import gzip
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceWriter,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from ..session import written

#: Smaller payloads are always stored.
REVISIT_BYTES = 1000
FILE_BYTES = 128 << 20
PARTITION_BYTES = 128 << 20
DATE = "2024-01-01T00:00:00Z"
MANIFESTS = "_manifests"

VERSION = b"WARC/1.1"
_TEXT = "".join(chr(c) for c in range(0x20, 0x7F) if chr(c) != "%")

#: Column: header that holds it. Predicates on these are decided from the headers alone.
HEADERS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to": "X-Refers-To",
    "row_id": "X-Row-ID",
    "payload_bytes": "X-Payload-Length",
}
NUMBERS = {"refers_to", "row_id", "payload_bytes"}
HEADER_SCHEMA = (
    "record_type string, record_id string, target_uri string, payload_digest string, refers_to long, row_id long, "
    "payload_bytes long"
)
SCHEMA = f"{HEADER_SCHEMA}, payload binary"
#: Columns of the frame that is written.
WRITE_SCHEMA = "row_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary"


def _store(uri: str):
    """(file system, path) of a local path or a URI that pyarrow knows."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def sha1_field(hex_digest: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(hex_digest)).decode()


def sha1_hex(value: str) -> str:
    return base64.b32decode(value.removeprefix("sha1:")).hex()


def record(row) -> bytes:
    """The bytes of one record."""
    response = row.record_type == "response"
    if response:
        entity = gzip.compress(bytes(row.payload or b""), 1, mtime=0)
        block = (
            b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Encoding: gzip\r\n"
            b"Content-Length: %d\r\n\r\n" % len(entity)
        ) + entity
    else:
        block = b""
    name = lambda i: f"<urn:row:{i}>"
    fields = {
        "WARC-Type": row.record_type,
        "WARC-Record-ID": name(row.row_id) if row.row_id is not None else f"<urn:uuid:{uuid.uuid4()}>",
        "WARC-Date": DATE,
        "WARC-Target-URI": row.url,
        "WARC-Payload-Digest": sha1_field(row.payload_digest),
        "WARC-Profile": None if response else "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        "WARC-Refers-To": None if row.refers_to is None else name(row.refers_to),
        "X-Refers-To": row.refers_to,
        "X-Row-ID": row.row_id,
        "X-Payload-Length": row.payload_bytes,
        "Content-Type": "application/http;msgtype=response" if response else None,
        "Content-Length": len(block),
    }
    lines = [VERSION] + [f"{k}: {quote(str(v), safe=_TEXT)}".encode() for k, v in fields.items() if v is not None]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, int]]


class WarcWriter(DataSourceWriter):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"].rstrip("/")
        self.file_bytes = int(options.get("file_bytes", FILE_BYTES))

    def write(self, rows: Iterator) -> Written:
        store, top = _store(self.path)
        store.create_dir(top, recursive=True)
        attempt, files, out, held = uuid.uuid4().hex, [], None, 0
        for row in rows:
            if out is None:
                name, held = f"{attempt}-{len(files):05d}.warc", 0
                out = store.open_output_stream(f"{top}/{name}")
            held += out.write(record(row))
            if held >= self.file_bytes:
                out.close()
                files.append((name, held))
                out = None
        if out is not None:
            out.close()
            files.append((name, held))
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        store, top = _store(self.path)
        store.create_dir(f"{top}/{MANIFESTS}", recursive=True)
        with store.open_output_stream(f"{top}/{MANIFESTS}/{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps([f for m in messages if m is not None for f in m.files]).encode())

    def abort(self, messages: list[Written | None]) -> None:
        store, top = _store(self.path)
        for name, _ in (f for m in messages if m is not None for f in m.files):
            store.delete_file(f"{top}/{name}")


@dataclass
class Files(InputPartition):
    names: list[str]


def read_headers(stream) -> dict[str, str] | None:
    """Header fields of the next record by name in capitals; None at the end of the file."""
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"no WARC record at byte {stream.tell()}")
    fields: dict[str, str] = {}
    while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
        name, _, value = line.decode().partition(":")
        fields[name.strip().upper()] = unquote(value.strip())
    return fields


def payload_of(block: bytes) -> bytes:
    """The decoded entity of an HTTP response."""
    head, _, entity = block.partition(b"\r\n\r\n")
    return gzip.decompress(entity) if b"content-encoding: gzip" in head.lower() else entity


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: StructType):
        self.path = options["path"].rstrip("/")
        self.partition_bytes = int(options.get("partition_bytes", PARTITION_BYTES))
        self.columns = schema.names
        #: Column and the values it may have; None is any value but null.
        self.wanted: list[tuple[str, tuple | None]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes equality, membership and not-null predicates on header columns; the others stay with Spark."""
        for f in filters:
            column = f.attribute[0] if isinstance(f, (EqualTo, In, IsNotNull)) and len(f.attribute) == 1 else None
            if column in HEADERS and isinstance(f, EqualTo):
                self.wanted.append((column, (f.value,)))
            elif column in HEADERS and isinstance(f, In):
                self.wanted.append((column, tuple(f.value)))
            elif column in HEADERS:
                self.wanted.append((column, None))
            else:
                yield f

    def partitions(self) -> list[Files]:
        from pyarrow import fs

        store, top = _store(self.path)
        found: list[tuple[str, int]] = []
        for manifest in store.get_file_info(fs.FileSelector(f"{top}/{MANIFESTS}", allow_not_found=True)):
            with store.open_input_stream(manifest.path) as text:
                found += [tuple(x) for x in json.loads(text.read())]
        groups: list[Files] = []
        room = 0
        for name, size in sorted(found):
            if size > room or not groups:
                groups.append(Files([]))
                room = self.partition_bytes
            groups[-1].names.append(name)
            room -= size
        return groups or [Files([])]

    def value(self, column: str, fields: dict[str, str]):
        text = fields.get(HEADERS[column].upper())
        if text is None:
            return None
        if column == "payload_digest":
            return sha1_hex(text)
        return int(text) if column in NUMBERS else text

    def read(self, partition: Files) -> Iterator[tuple]:
        import pyarrow as pa

        store, top = _store(self.path)
        for name in partition.names:
            raw = store.open_input_file(f"{top}/{name}")
            stream = pa.PythonFile(raw, mode="r") if not hasattr(raw, "readline") else raw
            with stream:
                yield from self.records(_Lines(stream))

    def records(self, stream: _Lines) -> Iterator[tuple]:
        while (fields := read_headers(stream)) is not None:
            length = int(fields["CONTENT-LENGTH"])
            values = {c: self.value(c, fields) for c in HEADERS if c in self.columns or any(c == w for w, _ in self.wanted)}
            fits = all(values[c] is not None and (among is None or values[c] in among) for c, among in self.wanted)
            if not fits or "payload" not in self.columns or not length:
                stream.skip(length)
                payload = None
            else:
                payload = payload_of(stream.read(length))
            if fits:
                yield tuple(payload if c == "payload" else values[c] for c in self.columns)


class _Lines:
    """Lines, bytes and skips over a seekable file, through a buffer of its own."""

    CHUNK = 1 << 20

    def __init__(self, raw):
        self.raw, self.held, self.at = raw, b"", 0

    def tell(self) -> int:
        return self.raw.tell() - len(self.held) + self.at

    def _more(self) -> bool:
        chunk = self.raw.read(self.CHUNK)
        self.held, self.at = self.held[self.at :] + chunk, 0
        return bool(chunk)

    def readline(self) -> bytes:
        while (end := self.held.find(b"\n", self.at)) < 0:
            if not self._more():
                end = len(self.held) - 1
                break
        line = self.held[self.at : end + 1]
        self.at = end + 1
        return line

    def read(self, size: int) -> bytes:
        here = self.held[self.at : self.at + size]
        self.at += len(here)
        if len(here) < size:
            here += self.raw.read(size - len(here))
        return here

    def skip(self, size: int) -> None:
        left = len(self.held) - self.at
        if size <= left:
            self.at += size
        else:
            self.raw.seek(self.raw.tell() + size - left)
            self.held, self.at = b"", 0


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(self.options, schema)

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options)


def register(spark: SparkSession) -> None:
    """Makes format ``warc`` known and lets Spark push filters into Python data sources."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def plan_records(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """The records of pages (page_id, url, html), in the columns that the writer takes.

    Of pages with equal payloads of at least ``revisit_bytes``, that with the largest id is the response and the others
    revisit it. A null html is an empty payload. Rows that repeat the largest id are responses too; a null id is below
    all others, so it revisits if any other page has its payload. A group without any id is all responses. Groups are
    reduced to one row per task and digest before they move, and the join back can be split.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("row_id"), "url", payload.alias("payload")).select(
        "*", F.sha1("payload").alias("payload_digest"), F.length("payload").cast("long").alias("payload_bytes")
    )
    shared = (
        rows.filter(F.col("payload_bytes") >= revisit_bytes)
        .groupBy("payload_digest")
        .agg(F.max("row_id").alias("largest"), F.count("*").alias("n"))
        .filter("n > 1 and largest is not null")
        .select(F.col("payload_digest").alias("digest"), "largest")
    )
    revisit = F.col("largest").isNotNull() & ~F.col("row_id").eqNullSafe(F.col("largest"))
    # Written, as AQE splits the partition of a payload that many pages share only between two shuffles.
    rows = rows.join(written(shared, "shared-payloads"), F.col("payload_digest") == F.col("digest"), "left")
    return rows.select(
        "row_id",
        "url",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("largest")).alias("refers_to"),
        "payload_digest",
        "payload_bytes",
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def write_archives(records: DataFrame, path: str, file_bytes: int = FILE_BYTES) -> None:
    """Adds records to the archives below ``path``, a folder that all executors reach."""
    register(records.sparkSession)
    records.write.format("warc").option("path", path).option("file_bytes", str(file_bytes)).mode("append").save()


def read_archives(spark: SparkSession, path: str, partition_bytes: int = PARTITION_BYTES, payload: bool = True) -> DataFrame:
    """The records below ``path`` with their headers and decoded payloads; an empty folder gives no rows.

    Without ``payload`` no block is read. Filters on record type and headers are decided before a block is read.
    """
    register(spark)
    reader = spark.read.format("warc").option("partition_bytes", str(partition_bytes))
    return (reader if payload else reader.schema(HEADER_SCHEMA)).load(path)
