"""WARC as a PySpark Python data source, for reading and writing.

Reading (``spark.read.format("warc").load(path)``, after ``register(spark)``):

* partitions are planned from the file list: files are packed into partitions of
  about ``partition_bytes``, a larger file alone (the writer rolls its files);
* equality, IN, prefix and null filters on record_type, record_id, target_uri,
  payload_digest, refers_to and content_type are pushed down;
* headers are parsed first. A record that a filter rejects is skipped without
  decoding its payload: an uncompressed one by its Content-Length, a compressed
  one by the skip length in its gzip member. With the option ``payload=false``
  no payload is decoded at all.

Compressed archives have one gzip member a record, as the format asks. Members
written here carry the lengths in the gzip extra field ("sl": compressed and full length)
and flush after the headers, so that these inflate alone; members of other
writers are inflated to their end.

Writing: ``df.write.format("warc").mode("append").save(path)`` with columns
record_type, record_id, and where given target_uri, refers_to, payload_digest
(or payload_sha1 in hex), content_type, payload, payload_bytes. Each task writes files of its own name;
the names of the tasks that succeeded go to a manifest, which readers follow, so
failed and repeated attempts leave no records.

Defined results: a null payload is written as empty; null header values are left
out; line ends in header values are percent-encoded; rows are written one by one,
repeats included; an empty table gives an archive without records; columns of
other names are ignored. Very long payloads are one record.
"""

from __future__ import annotations

import base64
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull, IsNull,
                                    StringStartsWith, WriterCommitMessage)

from snapfeed.llm.common import shared_folder

FIELDS = ["record_id", "record_type", "target_uri", "date", "content_type", "payload_digest", "payload_sha1", "refers_to"]
# Fixed values of the format.
HEADERS = {"warc-record-id": "record_id", "warc-type": "record_type", "warc-target-uri": "target_uri", "warc-date": "date", "content-type": "content_type",
           "warc-payload-digest": "payload_digest", "warc-refers-to": "refers_to"}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SCHEMA = ", ".join(f"{c} string" for c in FIELDS) + ", payload_bytes bigint, payload binary"
ARROW = pa.schema([*((c, pa.string()) for c in FIELDS), ("payload_bytes", pa.int64()), ("payload", pa.binary())])
MANIFEST = "_records.json"
PARTITION_BYTES = 64 << 20
BATCH_BYTES = 8 << 20
HEAD = 4096


def open_folder(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder's URI (local, HDFS or object store) and the path in it."""
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def digest_header(hex_digest: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(hex_digest)).decode()


def digest_hex(header: str | None) -> str | None:
    """Lower-case hex of a SHA-1 digest header in base 32 or hex; None for others."""
    kind, _, value = (header or "").partition(":")
    if kind.lower() != "sha1" or len(value) not in (32, 40):
        return None
    return value.lower() if len(value) == 40 else base64.b32decode(value.upper()).hex()


def record_head(row: dict, size: int, date: str) -> bytes:
    """Headers of a record; a response or revisit starts with an HTTP head that
    states the payload's length."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: {row.get('content_type') or 'text/html; charset=utf-8'}\r\nContent-Length: {size}\r\n\r\n".encode()
    length = len(http) + (0 if row["record_type"] == "revisit" else size)
    lines = ["WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: {row['record_id']}", f"WARC-Date: {date}"]
    if row.get("payload_sha1") is not None:
        row = row | {"payload_digest": digest_header(row["payload_sha1"])}
    for name, key in (("WARC-Target-URI", "target_uri"), ("WARC-Payload-Digest", "payload_digest"), ("WARC-Refers-To", "refers_to")):
        if row.get(key) is not None:
            lines.append(f"{name}: " + row[key].replace("\r", "%0D").replace("\n", "%0A"))
    if row["record_type"] == "revisit":
        lines.append(f"WARC-Profile: {REVISIT_PROFILE}")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {length}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http


def member(head: bytes, payload, level: int) -> bytes:
    """One gzip member: extra field with the lengths, head, flush, payload."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(head) + deflate.flush(zlib.Z_FULL_FLUSH) + deflate.compress(payload) + deflate.compress(b"\r\n\r\n") + deflate.flush()
    check = zlib.crc32(b"\r\n\r\n", zlib.crc32(payload, zlib.crc32(head)))
    full = len(head) + len(payload) + 4
    packed = 24 + len(body) + 8
    known = (packed, full) if packed < 1 << 32 and full < 1 << 32 else (0, 0)
    return (b"\x1f\x8b\x08\x04" + b"\0" * 5 + b"\xff" + struct.pack("<H", 12) + b"sl" + struct.pack("<HII", 8, *known)
            + body + struct.pack("<II", check, full & 0xFFFFFFFF))


def parse_head(head: bytes) -> dict:
    """Header lines up to the empty line; names in lower case."""
    out: dict[str, str] = {}
    for line in head.split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if colon:
            out[name.strip().lower().decode()] = value.strip().decode("utf-8", "replace")
    return out


class Records:
    """The records of one open archive file."""

    def __init__(self, file, packed: bool, wanted, payload: bool):
        self.file, self.packed, self.wanted, self.payload = file, packed, wanted, payload
        self.size = file.size()

    def __iter__(self) -> Iterator[dict]:
        at = 0
        while at < self.size:
            if self.packed:
                row, at = self.unpack(at)
            else:
                row, at = self.plain(at)
            if row is not None:
                yield row

    def read(self, at: int, n: int) -> bytes:
        return self.file.read_at(max(0, min(n, self.size - at)), at)

    def plain(self, at: int) -> tuple[dict | None, int]:
        head, n = b"", HEAD
        while b"\r\n\r\n" not in head and len(head) < self.size - at:
            head, n = self.read(at, n), n * 2
        cut = head.find(b"\r\n\r\n") + 4
        fields = parse_head(head[:cut])
        length = int(fields["content-length"])
        row = self.row(fields)
        if row is not None:
            wants = self.payload and row["record_type"] != "revisit"
            block = self.read(at + cut, length if wants else min(length, HEAD))
            self.split(row, fields, block, length, wants)
        return row, at + cut + length + 4

    def unpack(self, at: int) -> tuple[dict | None, int]:
        start = self.read(at, HEAD)
        packed = 0
        if start[3:4] == b"\x04" and start[12:14] == b"sl":
            packed = struct.unpack("<I", start[16:20])[0]
        if not packed:
            return self.unpack_unknown(at)
        inflate, taken = zlib.decompressobj(-15), min(len(start), packed)
        head, fed = b"", start[24:packed]
        while fed and not inflate.eof and head.count(b"\r\n\r\n") < 2:
            head += inflate.decompress(fed, HEAD)
            fed = inflate.unconsumed_tail
            if not fed and taken < packed:
                fed = self.read(at + taken, min(HEAD, packed - taken))
                taken += len(fed)
        cut = head.find(b"\r\n\r\n") + 4
        fields = parse_head(head[:cut])
        row = self.row(fields)
        if row is not None:
            wants = self.payload and row["record_type"] != "revisit"
            block = head[cut:]
            length = int(fields["content-length"])
            if wants and len(block) < length:
                block += inflate.decompress(fed + self.read(at + taken, packed - taken))
            self.split(row, fields, block[:length], length, wants)
        return row, at + packed

    def unpack_unknown(self, at: int) -> tuple[dict | None, int]:
        """A member of unknown length: inflated to its end."""
        inflate, out, place = zlib.decompressobj(31), [], at
        while not inflate.eof and place < self.size:
            piece = self.read(place, 1 << 16)
            place += len(piece)
            out.append(inflate.decompress(piece))
        data = b"".join(out)
        cut = data.find(b"\r\n\r\n") + 4
        fields = parse_head(data[:cut])
        length = int(fields["content-length"])
        row = self.row(fields)
        if row is not None:
            self.split(row, fields, data[cut:cut + length], length, self.payload and row["record_type"] != "revisit")
        return row, place - len(inflate.unused_data)

    def row(self, fields: dict) -> dict | None:
        row = {c: None for c in FIELDS} | {HEADERS[k]: v for k, v in fields.items() if k in HEADERS}
        row["payload_sha1"] = digest_hex(row["payload_digest"])
        return row if self.wanted(row) else None

    def split(self, row: dict, fields: dict, block: bytes, length: int, wants: bool) -> None:
        """The payload: what follows the HTTP head, or the whole block."""
        if fields.get("content-type", "").startswith("application/http"):
            cut = block.find(b"\r\n\r\n") + 4
            http = parse_head(block[:cut])
            row["content_type"] = http.get("content-type")
            row["payload_bytes"] = int(http.get("content-length", length - cut))
        else:
            cut, row["payload_bytes"] = 0, length
        row["payload"] = block[cut:] if wants else None


@dataclass
class Files(InputPartition):
    names: list


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.payload = options["path"], options.get("payload", "true").lower() == "true"
        self.partition_bytes = int(options.get("partition_bytes", PARTITION_BYTES))
        self.tests: list[tuple] = []

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            column = ".".join(getattr(f, "attribute", ()))
            kinds = {EqualTo: "=", In: "in", StringStartsWith: "starts", IsNotNull: "set", IsNull: "unset"}
            if column in FIELDS and type(f) in kinds:
                self.tests.append((kinds[type(f)], column, tuple(f.value) if isinstance(f, In) else getattr(f, "value", None)))
            else:
                yield f

    def wanted(self, row: dict) -> bool:
        for kind, column, value in self.tests:
            have = row[column]
            if kind == "unset":
                if have is not None:
                    return False
            elif have is None or kind == "=" and have != value or kind == "in" and have not in value or kind == "starts" and not have.startswith(value):
                return False
        return True

    def partitions(self):
        fs, path = open_folder(self.path)
        infos = {i.base_name: i.size for i in fs.get_file_info(pafs.FileSelector(path)) if i.base_name.endswith((".warc", ".warc.gz"))}
        if fs.get_file_info(f"{path}/{MANIFEST}").type != pafs.FileType.NotFound:
            with fs.open_input_stream(f"{path}/{MANIFEST}") as f:
                names = json.loads(f.read())
        else:
            names = sorted(infos)
        out, now, size = [], [], 0
        for name in names:
            if now and size + infos[name] > self.partition_bytes:
                out, now, size = [*out, Files(now)], [], 0
            now.append(name)
            size += infos[name]
        return [*out, Files(now)]

    def read(self, partition: Files):
        fs, path = open_folder(self.path)
        rows, size = [], 0
        for name in partition.names:
            with fs.open_input_file(f"{path}/{name}") as file:
                for row in Records(file, name.endswith(".gz"), self.wanted, self.payload):
                    rows.append(row)
                    size += 500 + len(row["payload"] or b"")
                    if size > BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema=ARROW)
                        rows, size = [], 0
        yield pa.RecordBatch.from_pylist(rows, schema=ARROW)


@dataclass
class Written(WriterCommitMessage):
    names: list


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.level = int(options.get("level", 1))  # 0: uncompressed archives
        self.date = options.get("date", "1970-01-01T00:00:00Z")
        self.roll_bytes = int(options.get("roll_bytes", PARTITION_BYTES))

    def write(self, iterator) -> Written:
        fs, path = open_folder(self.path)
        fs.create_dir(path, recursive=True)
        names, out = [], None
        for batch in iterator:
            columns = [c for c in (*FIELDS, "payload_bytes") if c in batch.schema.names]
            heads = batch.select(columns).to_pylist()
            payloads = batch.column("payload") if "payload" in batch.schema.names else [None] * len(heads)
            for row, payload in zip(heads, payloads, strict=True):
                data = payload.as_buffer() if payload is not None and payload.is_valid else b""
                size = row.get("payload_bytes")
                head = record_head(row, len(data) if size is None else size, self.date)
                if row["record_type"] == "revisit":
                    data = b""
                if out is None or out.tell() > self.roll_bytes:
                    if out is not None:
                        out.close()
                    names.append(f"{uuid.uuid4().hex}.warc" + ".gz" * bool(self.level))
                    out = fs.open_output_stream(f"{path}/{names[-1]}", compression=None)
                if self.level:
                    out.write(member(head, data, self.level))
                else:
                    out.write(head), out.write(data), out.write(b"\r\n\r\n")
        if out is not None:
            out.close()
        return Written(names)

    def commit(self, messages) -> None:
        fs, path = open_folder(self.path)
        fs.create_dir(path, recursive=True)
        names = sorted(n for m in messages if m is not None for n in m.names)
        before = []
        if fs.get_file_info(f"{path}/{MANIFEST}").type != pafs.FileType.NotFound:
            with fs.open_input_stream(f"{path}/{MANIFEST}") as f:
                before = json.loads(f.read())
        with fs.open_output_stream(f"{path}/{MANIFEST}", compression=None) as f:
            f.write(json.dumps(before + names).encode())

    def abort(self, messages) -> None:
        fs, path = open_folder(self.path)
        for m in messages:
            for name in m.names if m is not None else ():
                fs.delete_file(f"{path}/{name}")


class Warc(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        if overwrite:
            raise ValueError("warc: write to a new folder or append")
        return WarcWriter(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Warc)


LEAST_REVISIT = 1000
_ID = "<urn:page:%s>"


def page_records(pages: DataFrame) -> DataFrame:
    """Records of (page_id, url, html): of equal payloads of at least 1000 bytes the
    one with the largest page_id is the response and the others revisit it (rows
    that repeat that page_id are responses too)."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("target_uri"), F.coalesce(F.encode(F.col("html").cast("string"), "utf-8"), F.lit(b"")).alias("payload"))
    pages = pages.withColumns({"payload_bytes": F.length("payload").cast("long"), "sha1": F.sha1("payload")})
    same = pages.where(F.col("payload_bytes") >= LEAST_REVISIT).groupBy(F.col("sha1").alias("of"), F.col("payload_bytes").alias("long"))
    same = same.agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null")
    pages = pages.join(same, [F.col("sha1") == F.col("of"), F.col("payload_bytes") == F.col("long")], "left")
    revisits = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return pages.select(
        F.when(revisits, "revisit").otherwise("response").alias("record_type"), F.format_string(_ID, "page_id").alias("record_id"), "target_uri",
        F.when(revisits, F.format_string(_ID, "first")).alias("refers_to"), F.col("sha1").alias("payload_sha1"),
        F.when(~revisits, F.col("payload")).alias("payload"), "payload_bytes")


def round_trip(pages: DataFrame) -> DataFrame:
    """Write a record per page, read the archives back, and describe each page: the
    digest of a response is that of the payload read, of a revisit its header's."""
    spark = pages.sparkSession
    register(spark)
    path = shared_folder(spark, "warc")
    page_records(pages).write.format("warc").mode("append").save(path)
    records = spark.read.format("warc").load(path).where(F.col("record_type").isin("response", "revisit"))
    page = lambda c: F.regexp_extract(c, r"<urn:page:(-?\d+)>", 1).try_cast("long")
    read = F.sha1("payload")
    intact = F.when(read.isNull() | (read == F.col("payload_sha1")), F.col("payload_sha1")).otherwise(F.raise_error(F.concat(F.lit("payload differs from its digest: "), "record_id")))
    return records.select(page("record_id").alias("page_id"), "payload_bytes", intact.alias("payload_digest"), "record_type", page("refers_to").alias("refers_to"))
