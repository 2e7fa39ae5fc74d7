"""Web archives (WARC) as a Spark data source, for reading and writing.

``spark.read.format("warc")`` plans parts of files as partitions: the writer leaves a list of
its files with places where records start, about every 64 MB; a file from elsewhere is one part.
In a part the headers of a record are parsed first. Predicates on the record type and the other
header columns are pushed into the reader (with the setting
``spark.sql.python.filterPushdown.enabled``) and decided on the headers alone; the payload of an
unwanted record, or any payload with the option ``payload=false``, is skipped by seeking.

Each record is a gzip member of its own, as usual for archives, whose extra field ``sl`` holds its
length; so only the first bytes of an unwanted record are decompressed. Files without
that field are decompressed as a stream, and uncompressed files are read as well.

Files are opened with pyarrow's file systems, so a path may be local, HDFS or an object store.
A write becomes visible with its list of files, which is written at the commit; files that lost
or repeated tasks leave behind are in no list and never read.
"""

from __future__ import annotations

import gzip
import io
import json
import operator
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources.scratch import scratch_path

SCHEMA = (
    "page_id bigint, url string, record_type string, refers_to bigint,"
    " payload_bytes bigint, payload_digest string, payload binary"
)
ARROW = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
     ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())]
)
#: Payloads shorter than this are stored again, however often they occur.
LEAST_SHARED = 1000
LIST = "_files.json"
SPLIT_BYTES, FILE_BYTES, BATCH_BYTES, BATCH_ROWS = 64 << 20, 1 << 30, 4 << 20, 1000
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_COMPARE = {
    "EqualTo": operator.eq, "GreaterThan": operator.gt, "GreaterThanOrEqual": operator.ge,
    "LessThan": operator.lt, "LessThanOrEqual": operator.le,
}


#: Gzip header with an extra field of 12 bytes, whose ``sl`` part has the lengths of the member
#: and of its content. Behind the header come the data and eight bytes of checksum and length.
_MEMBER = struct.Struct("<10sH2sHII")
_GZIP_START = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff"
HEAD_BYTES = 2048


def _opened(path: str) -> tuple[pafs.FileSystem, str]:
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]+:/", path):
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def _urn(page_id: int) -> str:
    return f"<urn:page:{page_id}>"


def _header(value: str) -> str:
    """A header value on one line; control characters are percent-encoded."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record(row: dict) -> bytes:
    """One record. A revisit has the headers of its page but no payload."""
    revisit = row["record_type"] == "revisit"
    http = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {row['payload_bytes']}\r\n\r\n"
    ).encode()
    block = http if revisit else http + row["payload"]
    own = f"<urn:uuid:{uuid.uuid4()}>" if row["page_id"] is None else _urn(row["page_id"])
    lines = ["WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: {own}", f"WARC-Date: {DATE}"]
    if row["url"] is not None:
        lines.append(f"WARC-Target-URI: {_header(row['url'])}")
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_urn(row['refers_to'])}"]
    lines += [
        f"WARC-Payload-Digest: sha1:{row['payload_digest']}",
        f"X-Payload-Length: {row['payload_bytes']}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member that tells its own length."""
    packer = zlib.compressobj(1, zlib.DEFLATED, -zlib.MAX_WBITS)
    packed = packer.compress(data) + packer.flush()
    size = _MEMBER.size + len(packed) + 8
    start = _MEMBER.pack(_GZIP_START, 12, b"sl", 8, size, len(data))
    return start + packed + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


@dataclass
class Written(ds.WriterCommitMessage):
    files: list[dict]


class WarcWriter(ds.DataSourceArrowWriter):
    def __init__(self, path: str, split_bytes: int, compressed: bool):
        self.path, self.split_bytes = path, split_bytes
        self.packed, self.ending = (member, ".warc.gz") if compressed else (bytes, ".warc")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, base = _opened(self.path)
        fs.create_dir(base, recursive=True)
        files, out, at = [], None, 0
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None or at >= FILE_BYTES:
                    if out is not None:
                        files[-1]["size"] = at
                        out.close()
                    files.append({"name": f"part-{uuid.uuid4().hex}{self.ending}", "starts": [0]})
                    out, at = fs.open_output_stream(f"{base}/{files[-1]['name']}", compression=None), 0
                if at - files[-1]["starts"][-1] >= self.split_bytes:
                    files[-1]["starts"].append(at)
                at += out.write(self.packed(record(row)))
        if out is not None:
            files[-1]["size"] = at
            out.close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        fs, base = _opened(self.path)
        fs.create_dir(base, recursive=True)
        with fs.open_output_stream(f"{base}/{LIST}") as out:
            out.write(json.dumps([f for m in messages if m for f in m.files]).encode())

    def abort(self, messages: list[Written | None]) -> None:
        fs, base = _opened(self.path)
        for file in (f for m in messages if m for f in m.files):
            fs.delete_file(f"{base}/{file['name']}")


@dataclass
class Part(ds.InputPartition):
    """Records of a file that start at ``start`` or later and before ``stop`` (None: its end)."""

    file: str
    start: int
    stop: int | None


class WarcReader(ds.DataSourceReader):
    def __init__(self, path: str, payload: bool):
        self.path, self.payload, self.tests = path, payload, []

    def pushFilters(self, filters: list[ds.Filter]):
        for f in filters:
            name, column = type(f).__name__, getattr(f, "attribute", ("payload",))
            known = name in _COMPARE or name in ("In", "IsNotNull")
            if known and len(column) == 1 and column[0] in ARROW.names[:-1]:
                self.tests.append((name, column[0], getattr(f, "value", None)))
            else:
                yield f

    def partitions(self) -> list[Part]:
        fs, base = _opened(self.path)
        info = fs.get_file_info(base)
        if info.type == pafs.FileType.File:
            return [Part(base, 0, None)]
        if fs.get_file_info(f"{base}/{LIST}").type == pafs.FileType.File:
            with fs.open_input_stream(f"{base}/{LIST}") as list_file:
                files = json.loads(list_file.read())
            found = [
                Part(f"{base}/{f['name']}", a, b)
                for f in files
                for a, b in zip(f["starts"], [*f["starts"][1:], f["size"]])
            ]
        else:
            names = (i.path for i in fs.get_file_info(pafs.FileSelector(base, recursive=True)))
            found = [Part(n, 0, None) for n in sorted(names) if n.endswith((".warc", ".warc.gz"))]
        return found or [Part("", 0, 0)]

    def _wanted(self, row: dict) -> bool:
        for name, column, value in self.tests:
            own = row[column]
            if own is None or name == "In" and own not in value:
                return False
            if name in _COMPARE and not _COMPARE[name](own, value):
                return False
        return True

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        if not partition.file:
            return
        fs, _ = _opened(self.path)
        with fs.open_input_file(partition.file) as raw:
            stream = io.BufferedReader(raw, 1 << 16)
            stream.seek(partition.start)
            records = self._members if partition.file.endswith(".gz") else self._rows
            rows, size = [], 0
            for row in records(stream, partition.stop):
                rows.append(row)
                size += len(row["payload"] or b"")
                if size >= BATCH_BYTES or len(rows) >= BATCH_ROWS:
                    yield pa.RecordBatch.from_pylist(rows, ARROW)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, ARROW)

    def _members(self, stream: io.BufferedIOBase, stop: int | None) -> Iterator[dict]:
        while stop is None or stream.tell() < stop:
            at, start = stream.tell(), stream.read(_MEMBER.size)
            if not start:
                return
            if len(start) < _MEMBER.size or start[3] != 4 or _MEMBER.unpack(start)[2] != b"sl":
                stream.seek(at)
                yield from self._rows(gzip.GzipFile(fileobj=stream), None)
                return
            left = _MEMBER.unpack(start)[4] - _MEMBER.size - 8
            unpacker, data = zlib.decompressobj(-zlib.MAX_WBITS), b""
            while b"\r\n\r\n" not in data and left > 0:
                taken = stream.read(min(HEAD_BYTES, left))
                left -= len(taken)
                data += unpacker.decompress(taken)
            content = io.BytesIO(data)
            row = _row(head := _headers(content))
            if self._wanted(row):
                if self.payload and row["record_type"] != "revisit":
                    rest = unpacker.decompress(stream.read(left)) + unpacker.flush()
                    block = (data[content.tell() :] + rest)[: int(head.get("content-length", 0))]
                    row["payload"] = _body(head, block)
                yield row
            stream.seek(at + _MEMBER.unpack(start)[4])

    def _rows(self, stream: io.BufferedIOBase, stop: int | None) -> Iterator[dict]:
        while stop is None or stream.tell() < stop:
            head = _headers(stream)
            if head is None:
                return
            length = int(head.get("content-length", 0))
            row = _row(head)
            if not self._wanted(row):
                stream.seek(length, io.SEEK_CUR)
                continue
            stored = row["record_type"] != "revisit"
            if self.payload and stored:
                row["payload"] = _body(head, stream.read(length))
            else:
                stream.seek(length, io.SEEK_CUR)
            yield row


def _headers(stream: io.BufferedIOBase) -> dict[str, str] | None:
    """Headers of the next record by lower-case name; None at the end."""
    line = stream.readline()
    while line and not line.strip():
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"not the start of a record: {line[:40]!r}")
    head: dict[str, str] = {}
    while (line := stream.readline().rstrip(b"\r\n")):
        name, _, value = line.decode("utf-8", "replace").partition(":")
        head[name.lower()] = value.strip()
    return head


def _body(head: dict[str, str], block: bytes) -> bytes:
    """The payload in a record's block, behind the headers of an HTTP response."""
    http = head.get("content-type", "").startswith("application/http")
    return block.partition(b"\r\n\r\n")[2] if http else block


def _row(head: dict[str, str]) -> dict:
    page = lambda name: int(m[1]) if (m := re.fullmatch(r"<urn:page:(-?\d+)>", head.get(name, ""))) else None
    length = head.get("x-payload-length")
    return {
        "page_id": page("warc-record-id"),
        "url": head.get("warc-target-uri"),
        "record_type": head.get("warc-type"),
        "refers_to": page("warc-refers-to"),
        "payload_bytes": int(length) if length else None,
        "payload_digest": head.get("warc-payload-digest", "").removeprefix("sha1:") or None,
        "payload": None,
    }


class WarcSource(ds.DataSource):
    """Options: ``path``; ``payload`` (default true); for writing ``splitBytes`` and
    ``compression`` (gzip or none)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(self.options["path"], self.options.get("payload", "true").lower() != "false")

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        compressed = self.options.get("compression", "gzip") == "gzip"
        return WarcWriter(self.options["path"], int(self.options.get("splitBytes", SPLIT_BYTES)), compressed)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def records_of(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Rows for the writer. Of equal payloads of 1,000 bytes or more the page with the largest
    id is stored, the others become revisits of it.

    A null page is an empty payload. Rows without an id are stored unless another page has
    their payload; rows that repeat the largest id are all stored.
    """
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id_col).alias("page_id"),
        F.col(url_col).alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha1(payload).alias("payload_digest"),
        F.sha2(payload, 256).alias("same"),
    )
    shared = (
        rows.where(F.col("payload_bytes") >= LEAST_SHARED)
        .groupBy("same")
        .agg(F.max("page_id").alias("keeper"), F.count("*").alias("n"))
        .where("n > 1 AND keeper IS NOT NULL")
    )
    revisit = F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    return rows.join(shared.hint("merge"), "same", "left").select(
        "page_id",
        "url",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("keeper")).alias("refers_to"),
        "payload_bytes",
        "payload_digest",
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def write_archive(rows: DataFrame, path: str, split_bytes: int = SPLIT_BYTES, compression: str = "gzip") -> None:
    """Write ``rows`` of :func:`records_of` as archives, in files of about ``split_bytes``.

    A null payload is written without content, a null id as a record without one. Repeated rows are as many records,
    an empty table writes an archive without records; columns besides those of the schema are not written.
    """
    register(rows.sparkSession)
    options = {"splitBytes": split_bytes, "compression": compression}
    rows.write.format("warc").options(**options).mode("append").save(path)


def read_archive(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records of an archive; without ``payload`` none is decoded, and the column is null.

    An archive without records gives an empty table.
    """
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def archived_pages(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write the pages to an archive, read it back and describe every record.

    Returns (page_id, payload_bytes, payload_digest, record_type, refers_to). Size and digest of
    a response come from the payload read back, those of a revisit from its headers, for which
    no payload is decoded. An empty table gives an empty table.
    """
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_archive(records_of(pages), path)
    stored = read_archive(spark, path).where("record_type = 'response'").select(
        "page_id",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"),
        "record_type",
        "refers_to",
    )
    again = read_archive(spark, path, payload=False).where("record_type = 'revisit'").drop("url", "payload")
    return stored.unionByName(again)
