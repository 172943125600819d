"""WARC archives as a Spark data source that reads and writes in parallel: ``spark.read.format("warc").load(folder)``.

- Partitions: the driver lists the archives (``*.warc``, ``*.warc.gz``) and packs small ones together up to ``splitBytes``. An archive is read
  by one task as a stream; the writer starts a new one after ``fileBytes``, so that none grows with the table.
- Pushed predicates: comparisons of record_type, record_id, target_uri, date, payload_digest and refers_to with values. A record's header
  is parsed first; if a predicate fails, the payload is neither inflated nor decoded. Spark 4.1 remembers what it has pushed into a Python
  source for all plans of the DataFrame, so that a second, different filter would get the first one's rows. Predicates are therefore given
  to ``read``: they are pushed into a source of their own, and filters that follow stay above it. ``spark.read`` pushes nothing. The writer notes each gzip member's length
  in its extra field (``sl``), so that the reader seeks to the next record; members without it are inflated and thrown away.
- Columns: those of ``COLUMNS``; ``schema()`` may name fewer, and without ``payload`` no payload is decoded. A decoded payload must have
  the record's SHA-1 (``verify``), else the task fails.
- Writing: each task writes archives of its own under ``_temporary``; the commit moves those of successful tasks into the folder, so an
  attempt that is lost or repeated leaves no record behind.

Paths are those of Arrow's file systems (local, HDFS, object stores). ``records`` makes records of pages: of pages with equal payloads
that with the smallest id is a response, the others revisit it.

Nulls: a null payload is empty; a null id is no smaller than any, a page without one revisits one that has it, and if none has, all are responses.
Rows that share the smallest id and the payload are responses all. Null addresses and ids are left out of the header. Line breaks in
header values are percent-encoded. An empty table makes no archive, and an empty folder reads as no rows. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan,
    LessThanOrEqual, Not, StringContains, StringEndsWith, StringStartsWith, WriterCommitMessage,
)
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from waymark.operators.barrier import keep_where

COLUMNS = "record_id string, record_type string, target_uri string, date string, payload_digest string, refers_to string, payload_bytes long, headers map<string,string>, payload binary"
# Fixed values of the format: header names of the columns.
NAMES = {
    "record_id": "WARC-Record-ID", "record_type": "WARC-Type", "target_uri": "WARC-Target-URI", "date": "WARC-Date",
    "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To",
}
BRACKETED = {"record_id", "refers_to"}
FORMAT_NAMES = {n.lower() for n in NAMES.values()} | {"content-length", "content-type", "warc-profile"}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DIGEST = "sha1:"
GZIP_HEAD = b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff"

SPLIT_BYTES = 128 << 20
FILE_BYTES = 256 << 20
BATCH_BYTES = 8 << 20
BATCH_ROWS = 10_000
BLOCK = 1 << 16
NO_DATE = "1970-01-01T00:00:00Z"
# A hot payload's pages are dealt to so many tasks.
SALTS = 32


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    path = re.sub(r"^file:/+", "/", path)
    if re.match(r"^[a-z][a-z0-9+.-]*:", path):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


# Writing


def clean(value: str) -> str:
    """A header value without control characters, and without blanks at its ends."""
    return re.sub(r"[\x00-\x1f\x7f]|^ | $", lambda m: f"%{ord(m[0]):02X}", value)


def record(row: dict) -> bytes:
    """One record. A revisit has the payload's HTTP head only."""
    payload, kind = row.get("payload") or b"", row.get("record_type") or "response"
    head = {"payload_digest": DIGEST + digest(payload), "date": NO_DATE, **{k: v for k, v in row.items() if k in NAMES and v is not None}, "record_type": kind}
    lines = [f"{name}: " + (f"<{clean(head[c])}>" if c in BRACKETED else clean(head[c])) for c, name in NAMES.items() if c in head]
    if kind == "revisit":
        lines.append(f"WARC-Profile: {REVISIT_PROFILE}")
    for name, value in dict(row.get("headers") or {}).items():
        if not re.fullmatch(r"[!#-'*+.^-z|~0-9A-Z-]+", name) or name.lower() in FORMAT_NAMES:
            raise ValueError(f"{name!r} can't name an extra header")
        if value is not None:
            lines.append(f"{name}: {clean(value)}")
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode() + (payload if kind != "revisit" else b"")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(["WARC/1.1", *lines, "", ""]).encode() + block + b"\r\n\r\n"


def member(data: bytes, level: int = 6) -> bytes:
    """A gzip member that notes its own length and that of its content."""
    squeeze = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = squeeze.compress(data) + squeeze.flush()
    size = len(GZIP_HEAD) + 14 + len(body) + 8
    extra = struct.pack("<H2sHII", 12, b"sl", 8, size, len(data)) if max(size, len(data)) < 1 << 32 else struct.pack("<H10x", 10)
    return GZIP_HEAD + extra + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


@dataclass
class Written(WriterCommitMessage):
    files: list


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite = options["path"].rstrip("/"), overwrite
        self.gzip = options.get("compression", "gzip") == "gzip"
        self.most = int(options.get("filebytes", FILE_BYTES))
        self.job = uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, path = file_system(self.path)
        folder, files, out, size = f"{path}/_temporary/{self.job}", [], None, 0
        try:
            for batch in iterator:
                names = batch.schema.names
                for row in zip(*(column.to_pylist() for column in batch.columns)):
                    if out is None or size >= self.most:
                        if out is not None:
                            out.close()
                        else:
                            store.create_dir(folder)
                        files.append(f"part-{uuid.uuid4().hex}.warc" + ".gz" * self.gzip)
                        out, size = io.BufferedWriter(store.open_output_stream(f"{folder}/{files[-1]}", compression=None), 1 << 20), 0
                    data = record(dict(zip(names, row)))
                    size += out.write(member(data) if self.gzip else data)
        finally:
            if out is not None:
                out.close()
        return Written(files)

    def commit(self, messages: list) -> None:
        store, path = file_system(self.path)
        store.create_dir(path)
        old = archives(store, path) if self.overwrite else []
        for message in messages:
            for name in message.files if message else []:
                store.move(f"{path}/_temporary/{self.job}/{name}", f"{path}/{name}")
        for info in old:
            store.delete_file(info.path)
        self.abort(messages)

    def abort(self, messages: list) -> None:
        store, path = file_system(self.path)
        folder = f"{path}/_temporary/{self.job}"
        if store.get_file_info(folder).type == fs.FileType.Directory:
            store.delete_dir(folder)


# Reading


def archives(store: fs.FileSystem, path: str) -> list[fs.FileInfo]:
    """The archives of a folder by name, or the one that ``path`` names."""
    here = store.get_file_info(path)
    if here.type == fs.FileType.File:
        return [here]
    found = store.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return sorted((x for x in found if x.type == fs.FileType.File and re.search(r"\.warc(\.gz)?$", x.base_name)), key=lambda x: x.path)


class Plain:
    """A record of an archive that isn't compressed: bytes from where it begins."""

    def __init__(self, source: io.BufferedReader):
        self.source = source

    def begin(self) -> bool:
        self.at = self.source.tell()
        return bool(self.source.peek(1))

    def read(self, n: int) -> bytes:
        return self.source.read(n)

    def end(self, size: int) -> None:
        """Go to the next record, ``size`` bytes behind the start of this one."""
        self.source.seek(self.at + size)


class Zipped:
    """A record that is a gzip member, inflated as far as it is read."""

    def __init__(self, source: io.BufferedReader):
        self.source = source

    def begin(self) -> bool:
        """Whether another member follows; finds its length, if noted."""
        self.at = self.source.tell()
        head = self.source.read(12)
        if not head:
            return False
        if head[:2] != GZIP_HEAD[:2]:
            raise ValueError(f"no gzip member at byte {self.at}")
        extra = self.source.read(struct.unpack("<H", head[10:12])[0]) if head[3] & 4 and len(head) == 12 else b""
        self.size = 0
        while len(extra) >= 4:
            name, n = struct.unpack("<2sH", extra[:4])
            if name == b"sl" and n == 8:
                self.size = struct.unpack("<I", extra[4:8])[0]
            extra = extra[4 + n :]
        self.source.seek(self.at)
        self.inflater, self.left = zlib.decompressobj(31), b""
        return True

    def read(self, n: int) -> bytes:
        out = []
        while n > 0 and not self.inflater.eof:
            if not self.left:
                most = BLOCK if not self.size else min(BLOCK, self.at + self.size - self.source.tell())
                self.left = self.source.read(most)
                if not self.left:
                    raise EOFError("the archive ends inside a record")
            got = self.inflater.decompress(self.left, n)
            self.left = self.inflater.unconsumed_tail
            out.append(got)
            n -= len(got)
        return b"".join(out)

    def end(self, size: int) -> None:
        """Go to the next member."""
        if self.size:
            self.source.seek(self.at + self.size)
            return
        while not self.inflater.eof:
            self.read(BLOCK)
        self.source.seek(-len(self.inflater.unused_data), io.SEEK_CUR)


class Lines:
    """Bytes of a record up to an empty line, and then the rest."""

    def __init__(self, source: Plain | Zipped):
        self.source, self.held = source, b""

    def head(self, limit: int | None = None) -> tuple[dict[str, str], int]:
        """Header fields by lower-case name, and the bytes that they took. Reads at most ``limit`` bytes."""
        taken, want = 0, 1024
        while (end := self.held.find(b"\r\n\r\n")) < 0:
            got = self.source.read(want if limit is None else min(want, limit - taken))
            taken += len(got)
            if not got:
                return {}, 0
            self.held, want = self.held + got, 2 * want
        text, self.held = self.held[:end].decode("utf-8", "replace"), self.held[end + 4 :]
        lines = re.sub(r"\r\n[ \t]+", " ", text).split("\r\n")
        pairs = [x.partition(":") for x in lines[1:]]
        return {"": lines[0], **{k.strip().lower(): v.strip() for k, _, v in pairs}}, end + 4

    def read(self, n: int) -> bytes:
        out, self.held = self.held[:n], self.held[n:]
        return out if len(out) == n else out + self.source.read(n - len(out))


def field(head: dict[str, str], column: str) -> str | None:
    value = head.get(NAMES[column].lower())
    if value is None:
        return None
    if column in BRACKETED:
        return value.removeprefix("<").removesuffix(">")
    return value.removeprefix(DIGEST) if column == "payload_digest" else value


# What a pushed predicate says of a value that is not null.
TESTS = {
    EqualTo: lambda x, v: x == v, In: lambda x, v: x in v, GreaterThan: lambda x, v: x > v, GreaterThanOrEqual: lambda x, v: x >= v, LessThan: lambda x, v: x < v,
    LessThanOrEqual: lambda x, v: x <= v, StringStartsWith: lambda x, v: x.startswith(v), StringEndsWith: lambda x, v: x.endswith(v), StringContains: lambda x, v: v in x,
}


def test(f: Filter):
    """(column, function of its value that is true, false or None) of a predicate on a header field, or None."""
    if isinstance(f, Not):
        inner = test(f.child)
        return inner and (inner[0], lambda x: None if (y := inner[1](x)) is None else not y)
    column = getattr(f, "attribute", ("", ""))
    if len(column) != 1 or column[0] not in NAMES:
        return None
    if isinstance(f, (IsNull, IsNotNull)):
        return column[0], lambda x: (x is None) == isinstance(f, IsNull)
    known, value = TESTS.get(type(f)), getattr(f, "value", None)
    if known is None or value is None:
        return None
    if isinstance(f, (GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
        value = value.encode()  # Spark orders strings by their bytes
        return column[0], lambda x: None if x is None else known(x.encode(), value)
    return column[0], lambda x: None if x is None else known(x, value)


class Archives(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class WarcReader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.path, self.schema, self.columns = options["path"].rstrip("/"), schema, schema.fieldNames()
        self.split = int(options.get("splitbytes", SPLIT_BYTES))
        self.verify, self.pushdown = (options.get(k, default) == "true" for k, default in (("verify", "true"), ("pushdown", "false")))
        self.filters: list[Filter] = []
        kinds = dict(x.rsplit(" ", 1) for x in COLUMNS.split(", "))
        if unknown := [c.name for c in schema if kinds.get(c.name) != c.dataType.simpleString().replace("bigint", "long")]:
            raise ValueError(f"no such columns or types: {unknown}; known are {COLUMNS}")

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if self.pushdown and test(f):
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[Archives]:
        store, path = file_system(self.path)
        parts, size = [], 0
        for info in archives(store, path):
            if not parts or size + info.size > self.split:
                parts.append([])
                size = 0
            parts[-1].append(info.path)
            size += info.size
        return [Archives(x) for x in parts] or [Archives([])]

    def read(self, partition: Archives) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(self.schema)
        store, _ = file_system(self.path)
        tests = [test(f) for f in self.filters]
        rows, size = [], 0
        for path in partition.paths:
            with io.BufferedReader(store.open_input_file(path), 1 << 20) as source:
                for row in self.rows(Zipped(source) if path.endswith(".gz") else Plain(source), tests):
                    rows.append(row)
                    size += len(row.get("payload") or b"")
                    if size >= BATCH_BYTES or len(rows) >= BATCH_ROWS:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    def rows(self, source: Plain | Zipped, tests: list) -> Iterator[dict]:
        """The records that pass, as far as the columns ask for them."""
        while source.begin():
            lines = Lines(source)
            head, begin = lines.head()
            if not head.get("", "").startswith("WARC/"):
                raise ValueError(f"no WARC record: {head.get('', '')[:40]!r}")
            if not field(head, "record_type"):
                raise ValueError("a WARC record without a type")
            size = int(head["content-length"])
            if all(fits(field(head, column)) for column, fits in tests):
                row = {c: field(head, c) for c in NAMES if c in self.columns}
                if "headers" in self.columns:
                    row["headers"] = [(k, v) for k, v in head.items() if k and k not in FORMAT_NAMES]
                if {"payload", "payload_bytes"} & {*self.columns}:
                    self.block(head, lines, size, row)
                yield row
            source.end(begin + size + 4)

    def block(self, head: dict[str, str], lines: Lines, size: int, row: dict) -> None:
        """Fills in the payload and its size."""
        revisit, http, taken = field(head, "record_type") == "revisit", {}, 0
        if head.get("content-type", "").startswith("application/http"):
            http, taken = lines.head(size)
        length = int(http["content-length"]) if revisit and "content-length" in http else size - taken
        if "payload_bytes" in self.columns:
            row["payload_bytes"] = length
        if "payload" in self.columns and not revisit:
            row["payload"] = lines.read(size - taken)
            known = head.get(NAMES["payload_digest"].lower(), "")
            if self.verify and known.startswith(DIGEST) and known.removeprefix(DIGEST) != digest(row["payload"]):
                raise ValueError(f"the payload of {field(head, 'record_id')} is not the one that was written")


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return COLUMNS

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader({k.lower(): v for k, v in self.options.items()}, schema)

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter({k.lower(): v for k, v in self.options.items()}, overwrite)


def register(spark: SparkSession) -> None:
    """Make ``format("warc")`` known, and let Spark push predicates into Python sources."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


# Records of pages


def uuid_of(*columns) -> F.Column:
    h = F.md5(F.concat_ws(":", *columns))
    return F.concat(F.lit("urn:uuid:"), F.regexp_replace(h, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"))


def records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Rows for the writer from page_id, url and html. Equal payloads of ``least_bytes`` at least are written once.

    Only hashes are grouped. A payload that many pages share is salted, so that its pages meet its first id in many tasks.
    """
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    key = F.when(F.octet_length("payload") >= least_bytes, F.sha2("payload", 256))
    shared = rows.groupBy(key.alias("digest")).agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1 and first is not null and digest is not null")
    shared = shared.select("digest", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    rows = rows.withColumns({"digest": F.sha2("payload", 256), "salt": F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int")})
    rows = rows.join(shared, ["digest", "salt"], "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    extra = F.map_from_entries(F.filter(F.array(F.struct(F.lit("Page-ID"), F.col("page_id").cast("string").alias("v")), F.struct(F.lit("Refers-To-Page-ID"), F.when(revisit, F.col("first")).cast("string").alias("v"))), lambda e: e["v"].isNotNull()))
    return rows.select(
        uuid_of(F.col("page_id").cast("string"), F.col("digest")).alias("record_id"), F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.col("url").alias("target_uri"),
        F.when(revisit, uuid_of(F.col("first").cast("string"), F.col("digest"))).alias("refers_to"), extra.alias("headers"), "payload",
    )


def write(rows: DataFrame, path: str, **options) -> None:
    register(rows.sparkSession)
    rows.write.format("warc").mode(options.pop("mode", "append")).options(**options).save(path)


def read(spark: SparkSession, path: str, where: str | F.Column | None = None, columns: str = COLUMNS, **options) -> DataFrame:
    """The records that meet ``where``, whose comparisons of header fields are pushed into the reader."""
    register(spark)
    rows = spark.read.format("warc").schema(columns).options(pushdown=str(where is not None).lower(), **options).load(path)
    return rows if where is None else keep_where(rows.filter(where), F.lit(True))
