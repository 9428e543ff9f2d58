"""WARC archives as a Python data source: ``spark.read.format("warc")`` and ``df.write.format("warc")``.

Reading plans partitions from the files, takes over predicates on the record type and other headers, parses a
record's headers first, and leaves the payload of an unwanted record compressed. Every record written is a gzip member of
its own that says its size in an extra field, so that an unwanted one is skipped with a seek, and a large file is read
in parts by several tasks. Files of others may have any number of records in a member; they are one task each. What is
cut off is an error.
Paths are those of any file system that Arrow knows (local, S3, GCS, HDFS); they must be reachable by the driver
and all executors. Writing is by task: a file comes to its place only when the whole job commits.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull, StringStartsWith, WriterCommitMessage

from .shared import beside, shared_dir, tune, written

SCHEMA = "record_id string, record_type string, target_uri string, date string, content_type string, refers_to string, header_digest string, content_length long, payload_length long, payload_digest string, payload binary"
#: Columns that a record's headers alone decide.
HEADERS = {"record_id": "warc-record-id", "record_type": "warc-type", "target_uri": "warc-target-uri", "date": "warc-date", "content_type": "content-type", "refers_to": "warc-refers-to", "header_digest": "warc-payload-digest"}
#: Files that one partition reads have so many bytes together, unless one file alone has more; files roll over at MAX_FILE.
PARTITION_BYTES, MAX_FILE = 64 << 20, 512 << 20
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMES = [x.split(" ")[0] for x in SCHEMA.split(", ")]
_ARROW = pa.schema([(x.split(" ")[0], {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[x.split(" ")[1]]) for x in SCHEMA.split(", ")])


def open_fs(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def member(data: bytes, level: int = 6) -> bytes:
    """A gzip member that says its own size in an extra field ``sl``: compressed, then uncompressed bytes."""
    c = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = c.compress(data) + c.flush()
    head = b"\x1f\x8b\x08\x04" + bytes(5) + b"\xff"
    extra = struct.pack("<2sHII", b"sl", 8, len(body) + 32, len(data) & 0xFFFFFFFF)
    return head + struct.pack("<H", len(extra)) + extra + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def record(kind: str, record_id: str, date: str, headers: list[tuple[str, str]], content_type: str, block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {date}", *(f"{k}: {v}" for k, v in headers), f"Content-Type: {content_type}", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _one_line(text: str) -> str:
    return " ".join(text.split())


@dataclass
class Files(WriterCommitMessage):
    names: list[str]


class Writer(DataSourceArrowWriter):
    """Writes rows (record_id, record_type, target_uri, date, refers_to, payload); a null payload is empty."""

    def __init__(self, options: dict[str, str]):
        self.path, self.level = options["path"], int(options.get("level", 6))
        self.roll = int(options.get("max_file_bytes", MAX_FILE))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Files:
        from pyspark import TaskContext

        fs, base = open_fs(self.path)
        fs.create_dir(f"{base}/_temporary", recursive=True)
        part, names, out, size = TaskContext.get().partitionId(), [], None, 0
        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    if out is None:
                        names.append(f"part-{part:05d}-{len(names):03d}-{uuid.uuid4().hex}.warc.gz")
                        out, size = fs.open_output_stream(f"{base}/_temporary/{names[-1]}", compression=None), 0
                        about = json.dumps({"format": "WARC File Format 1.1", "file": names[-1]}).encode()
                        out.write(member(record("warcinfo", f"urn:uuid:{uuid.uuid4()}", row["date"], [("WARC-Filename", names[-1])], "application/json", about), self.level))
                    data = self.encode(row)
                    out.write(data)
                    size += len(data)
                    if size >= self.roll:
                        out.close()
                        out = None
        finally:
            if out is not None:
                out.close()
        return Files(names)

    def encode(self, row: dict[str, Any]) -> bytes:
        payload = row["payload"] or b""
        http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
        headers = [("WARC-Target-URI", _one_line(row["target_uri"] or "")), ("WARC-Payload-Digest", f"sha1:{digest(payload)}")]
        if row["record_type"] == "revisit":
            headers += [("WARC-Profile", REVISIT), ("WARC-Refers-To", f"<{row['refers_to']}>")]
            payload = b""
        return member(record(row["record_type"], row["record_id"], row["date"], headers, "application/http;msgtype=response", http + payload), self.level)

    def commit(self, messages: list[Files | None]) -> None:
        fs, base = open_fs(self.path)
        for m in messages:
            for name in m.names if m else ():
                fs.move(f"{base}/_temporary/{name}", f"{base}/{name}")
        fs.create_dir(f"{base}/_temporary", recursive=True)
        fs.delete_dir(f"{base}/_temporary")

    def abort(self, messages: list[Files | None]) -> None:
        fs, base = open_fs(self.path)
        for m in messages:
            for name in m.names if m else ():
                fs.delete_file(f"{base}/_temporary/{name}")


@dataclass
class Part(InputPartition):
    """Files with the range of bytes in which the members or records begin that are read."""

    files: list[tuple[str, int, int]]


def _parse(head: bytes) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in head.split(b"\r\n")[1:]:
        k, _, v = line.decode("utf-8", "replace").partition(":")
        out[k.strip().lower()] = v.strip()
    return out


#: How a member written here begins: gzip with one extra field, ``sl``, of eight bytes.
_SIGN = re.compile(rb"\x1f\x8b\x08\x04.{6}\x0c\x00sl\x08\x00", re.DOTALL)


class Records:
    """The records of an open file, one after another, plain or as gzip members: one record a member, several, or parts.

    After :meth:`headers`, :meth:`block` reads the record's block or :meth:`skip` leaves it out. What a record announces and
    the file does not hold is an error, never a record less.
    """

    def __init__(self, f, start: int, stop: int, gzipped: bool):
        self.f, self.gzipped, self.stop, self.size = f, gzipped, stop, f.size()
        self.z, self.raw, self.data, self.at = None, b"", b"", start  # at: where what is read next begins in the file
        self.member = start  # where the member or record at hand begins
        f.seek(start)

    def _more(self) -> bool:
        """Appends to ``data``; False at the end of the file."""
        if not self.gzipped:
            got = self.f.read(1 << 16)
            self.data += got
            return bool(got)
        while True:
            if not self.raw:
                self.raw = self.f.read(1 << 16)
                if not self.raw:
                    if self.z is not None:
                        raise EOFError(f"the gzip member at byte {self.member} is cut off")
                    return False
                self.at = self.f.tell() - len(self.raw)
            if self.z is None:
                if not self.data and self.at >= self.stop:
                    return False
                if self.raw.strip(b"\0") == b"" and self.f.tell() == self.size:
                    return False  # padding behind the last member
                self.z, self.member = zlib.decompressobj(31), self.at
                self.fresh = not self.data  # a member begins where a record does
                if len(self.raw) < 20:
                    self.raw += self.f.read(20)
                self.jump = struct.unpack("<II", self.raw[16:24]) if _SIGN.match(self.raw) and len(self.raw) >= 24 else None
            got = self.z.decompress(self.raw, 1 << 20)
            rest = self.z.unused_data if self.z.eof else self.z.unconsumed_tail
            self.at += len(self.raw) - len(rest)
            self.raw = rest
            if self.z.eof:
                self.z = None
            if got:
                self.data += got
                return True

    def _over(self) -> bool:
        """Whether the next record begins behind the range."""
        if not self.gzipped:
            return self.f.tell() - len(self.data) >= self.stop
        return self.z is None and not self.data and self.at >= self.stop

    def headers(self) -> dict[str, str] | None:
        while True:
            self.data = self.data.lstrip(b"\r\n")
            if not self.data and self._over():
                return None
            if b"\r\n\r\n" in self.data:
                break
            if not self._more():
                if self.data:
                    raise EOFError(f"the record at or behind byte {self.member} is cut off")
                return None
        if not self.gzipped:
            if self._over():
                return None
            self.member = self.f.tell() - len(self.data)
        head, _, self.data = self.data.partition(b"\r\n\r\n")
        self.head = len(head) + 4
        out = _parse(head)
        if not head.startswith(b"WARC/") or not out.get("content-length", "").isdigit():
            raise ValueError(f"no record at or behind byte {self.member}")
        return out

    def block(self, length: int) -> bytes:
        parts, have = [self.data], len(self.data)
        while have < length:
            self.data = b""
            if not self._more():
                raise EOFError(f"the record at or behind byte {self.member} is shorter than it says")
            parts.append(self.data)
            have += len(self.data)
        whole = b"".join(parts)
        self.data = whole[length:]
        return whole[:length]

    def skip(self, length: int) -> None:
        if not self.gzipped and len(self.data) < length:
            to = self.f.tell() - len(self.data) + length
            if to > self.size:
                raise EOFError(f"the record at byte {self.member} is shorter than it says")
            self.f.seek(to)
            self.data = b""
        elif self.gzipped and self.z is not None and self.fresh and self.jump and self.jump[1] == (self.head + length + 4) & 0xFFFFFFFF:
            if self.member + self.jump[0] > self.size:
                raise EOFError(f"the gzip member at byte {self.member} is cut off")
            self.f.seek(self.member + self.jump[0])
            self.z, self.raw, self.data, self.at = None, b"", b"", self.member + self.jump[0]
        else:
            left = length
            while len(self.data) < left:
                left -= len(self.data)
                self.data = b""
                if not self._more():
                    raise EOFError(f"the record at or behind byte {self.member} is shorter than it says")
            self.data = self.data[left:]


def first_member(f, start: int, stop: int) -> int:
    """Where the first member written here begins at ``start`` or behind; the end of the file if none does.

    From there each member must begin where the one before says that it ends, up to ``stop``. So what merely looks like a
    member is passed over, be it an archive within an archive.
    """
    size, at, window = f.size(), start, b""
    while at < size:
        f.seek(at)
        window = f.read(1 << 20)
        for m in _SIGN.finditer(window):
            here = at + m.start()
            to = here
            while to < stop:
                f.seek(to)
                head = f.read(20)
                if not _SIGN.match(head):
                    break
                to += struct.unpack("<I", head[16:20].ljust(4, b"\0"))[0]
            if stop <= to <= size:
                return here
        at += max(1, len(window) - 15)
        if at + 16 > size:
            break
    return size


class Reader(DataSourceReader):
    """Options: ``payload`` is ``full`` (default), ``digest`` (payloads are hashed, not returned) or ``none``."""

    def __init__(self, options: dict[str, str]):
        self.path, self.payload = options["path"], options.get("payload", "full")
        self.bytes = int(options.get("partition_bytes", PARTITION_BYTES))
        self.tests: list[tuple[str, str, Any]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name in HEADERS and isinstance(f, EqualTo):
                self.tests.append((name, "in", {f.value}))
            elif name in HEADERS and isinstance(f, In):
                self.tests.append((name, "in", set(f.value)))
            elif name in HEADERS and isinstance(f, StringStartsWith):
                self.tests.append((name, "starts", f.value))
            elif name in HEADERS and isinstance(f, IsNotNull):
                self.tests.append((name, "some", None))
            else:
                yield f

    def partitions(self) -> list[Part]:
        fs, base = open_fs(self.path)
        info = fs.get_file_info(base)
        if info.type == pafs.FileType.File:
            files = [info]
        else:
            files = [x for x in fs.get_file_info(pafs.FileSelector(base, recursive=True)) if x.type == pafs.FileType.File and x.path.endswith((".warc", ".warc.gz")) and "/_" not in x.path[len(base) :]]
        pieces = []
        for x in sorted(files, key=lambda x: x.path):
            ours = x.size > self.bytes and x.path.endswith(".gz") and self._ours(fs, x.path)
            step = self.bytes if ours else max(1, x.size)  # members written here can be found from any place
            pieces += [(x.path, at, min(at + step, x.size)) for at in range(0, max(1, x.size), step)]
        out, size = [], self.bytes
        for piece in pieces:
            if size + piece[2] - piece[1] > self.bytes:
                out.append(Part([]))
                size = 0
            out[-1].files.append(piece)
            size += piece[2] - piece[1]
        return out or [Part([])]

    @staticmethod
    def _ours(fs: pafs.FileSystem, path: str) -> bool:
        with fs.open_input_file(path) as f:
            return bool(_SIGN.match(f.read(16)))

    def wanted(self, row: dict[str, Any]) -> bool:
        for name, test, value in self.tests:
            x = row[name]
            if x is None or test == "in" and x not in value or test == "starts" and not x.startswith(value):
                return False
        return True

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        fs, _ = open_fs(self.path)
        rows, size = [], 0
        for name, start, stop in partition.files:
            with fs.open_input_file(name) as f:
                gzipped = name.endswith(".gz")
                if start:
                    start = first_member(f, start, stop)
                records = Records(f, start, stop, gzipped)
                while start < stop and (h := records.headers()) is not None:
                    row = {c: h.get(k) for c, k in HEADERS.items()}
                    for c in ("record_id", "refers_to"):
                        row[c] = row[c] and row[c].strip("<>")
                    length = int(h["content-length"])
                    if not self.wanted(row):
                        records.skip(length)
                        continue
                    row["content_length"] = length
                    if self.payload != "none":
                        self.decode(row, records.block(length))
                    else:
                        records.skip(length)
                    rows.append(row)
                    size += 200 + len(row.get("payload") or b"")
                    if len(rows) >= 4096 or size >= 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    def decode(self, row: dict[str, Any], block: bytes) -> None:
        if (row["content_type"] or "").startswith("application/http"):
            head, _, body = block.partition(b"\r\n\r\n")
            if row["record_type"] == "revisit":  # the length of what it revisits; its digest stands in the headers
                row["payload_length"] = int(_parse(head).get("content-length", 0))
                row["payload_digest"] = (row["header_digest"] or "").removeprefix("sha1:") or None
                return
        else:
            body = block
        row["payload_length"], row["payload_digest"] = len(body), digest(body)
        said = row["header_digest"]
        if said and said.startswith("sha1:") and said != f"sha1:{row['payload_digest']}":
            raise ValueError(f"{row['record_id']}: the payload is not the one that its headers announce")
        if self.payload == "full":
            row["payload"] = body


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Reader:
        return Reader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> Writer:
        return Writer(dict(self.options))


def register(spark: SparkSession) -> None:
    tune(spark)
    spark.dataSource.register(WarcSource)


def archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = 0, date: str = "1970-01-01T00:00:00Z") -> None:
    """Writes one record per row to ``path``: of equal payloads of at least ``least`` bytes the smallest id is a
    response, the others revisit it. Null html is an empty payload. Rows that repeat the smallest id of a payload
    are all responses; a null id is larger than any other. Payloads move once, in a join by id and digest."""
    register(pages.sparkSession)
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), F.encode(F.coalesce(html_col, F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("sha", F.sha1("payload"))
    keys = rows.filter(F.length("payload") >= least).select("id", "sha")
    several = keys.groupBy("sha").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    again = written(keys.join(several, "sha").filter("first IS NOT NULL AND NOT (id <=> first)").distinct())
    again = again.select(F.col("id").alias("again"), F.col("sha").alias("of"), "first")
    name = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("null")))
    rows = beside(rows, again, F.col("id").eqNullSafe(F.col("again")) & (F.col("sha") == F.col("of")), "left").select(
        name("id").alias("record_id"),
        F.when(F.col("first").isNull(), "response").otherwise("revisit").alias("record_type"),
        F.col("url").alias("target_uri"),
        F.lit(date).alias("date"),
        F.when(F.col("first").isNotNull(), name("first")).alias("refers_to"),
        "payload",
    )
    rows.write.format("warc").mode("append").save(path)


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """:func:`archive` into the shared folder, and what its records say: page_id, payload_bytes, payload_digest,
    record_type, refers_to, target_uri. Payloads are decoded and hashed anew. No rows, no records."""
    spark = pages.sparkSession
    path = shared_dir(spark)
    archive(pages, path, **options)
    back = spark.read.format("warc").option("payload", "digest").load(path).filter(F.col("record_type").isin("response", "revisit"))
    page = lambda c: F.expr(f"try_cast(substring({c}, 10) AS bigint)")
    return back.select(page("record_id").alias("page_id"), F.col("payload_length").alias("payload_bytes"), "payload_digest", "record_type", page("refers_to").alias("refers_to"), "target_uri")
