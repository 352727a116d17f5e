"""WARC archives: written by Spark tasks, read by a PySpark Python data source.

**Writing.** Each task writes its rows to files of at most about ``FILE_BYTES``: gzip with one member per record, and in each
member's header the sizes of the member (subfield ``sl``), so a reader can step over it. A file gets its final name by a rename when it is
whole; a repeated task replaces it by the same content, and what a failed attempt left lies in ``_attempts``, which no reader lists.
Of equal payloads of ``REVISIT_BYTES`` or more, the record with the largest ``page_id`` is the response and the others are revisits
that name it; a revisit has the HTTP header, with the full length, and no payload.

**Reading** (format ``warc``). A partition is one archive file. Filters on ``record_type``, ``target_uri``, ``record_id`` and
``payload_digest`` are pushed to the reader. It decodes a member only up to the end of the WARC headers and steps over the rest when
the filters refuse it, or when ``option("payload", "false")`` leaves payloads out. Members without ``sl`` (written by others) are decoded
in chunks to find their end, and plain ``.warc`` files are stepped through by ``Content-Length``. An archive that breaks off, a record
shorter than it announces and a wrong checksum of a decoded member end the read with ``Damaged``; with ``option("damaged", "keep")`` the
place is a row of type ``damaged`` with the reason as ``record_id``. Members that are stepped over are not checked.

Rows: one record per input row. A null ``html`` is an empty payload. A null ``page_id`` is written as no number; such a row
is a revisit if another row with the payload has a number, else a response. Rows that repeat page and payload are all responses
if they are the largest. A null ``url`` is an empty target. Other columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull, StringStartsWith

from shelfwright.llm.frames import checked_broadcast, written

REVISIT_BYTES, FILE_BYTES, BROADCAST_BYTES = 1000, 256 << 20, 64 << 20
CHUNK, BATCH_BYTES, BATCH_ROWS = 1 << 14, 8 << 20, 512
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2020-01-01T00:00:00Z"
HEAD_END = CLOSE = b"\r\n\r\n"
SCHEMA = ("record_type string, record_id string, target_uri string, date string, refers_to string, payload_digest string, "
          "payload_length long, payload binary")


def _record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    """A gzip member with its sizes in the header."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    size = 10 + 14 + len(body) + 8
    extra = struct.pack("<H2sHII", 12, b"sl", 8, size, len(data)) if max(size, len(data)) < 1 << 32 else struct.pack("<H10x", 10)
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + extra
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def _header_value(text: str) -> str:
    return " ".join(text.split())


def plan_records(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """``page_id, url, payload, digest, kind, refers_to`` of each page."""
    rows = pages.select(
        F.col("page_id").cast("long"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"))
    big = F.octet_length("payload") >= REVISIT_BYTES
    groups = rows.where(big).select("page_id", F.sha2("payload", 256).alias("key")).groupBy("key").agg(
        F.count("*").alias("n"), F.max("page_id").alias("first")).where("n > 1 and first is not null").select("key", "first")
    groups = written(spark, groups, "equal")
    # Rows that can't have an equal one are dealt out by a key of their own: no sum of a payload looks like it.
    keyed = rows.withColumn("key", F.when(big, F.sha2("payload", 256)).otherwise(F.concat(F.lit("-"), F.xxhash64("page_id", "url", "payload"))))
    joined = keyed.join(checked_broadcast(groups, 160 * groups.count(), BROADCAST_BYTES), "key", "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select(
        "page_id", "url", "payload", F.sha1("payload").alias("digest"),
        F.when(again, "revisit").otherwise("response").alias("kind"), F.when(again, F.col("first")).alias("refers_to"))


def write(spark: SparkSession, pages: DataFrame, path: str) -> int:
    """Archive all pages into ``path``, a new folder that all executors share; returns the number of files."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = fs.FileSystem.from_uri(path)
        place, number, out, size = TaskContext.get().partitionId(), 0, None, 0
        attempt = f"{folder}/_attempts/{uuid.uuid4().hex}"

        def close() -> None:
            out.close()
            store.move(f"{attempt}-{number}", f"{folder}/part-{place:06d}-{number:03d}.warc.gz")

        for batch in batches:
            for i in range(batch.num_rows):
                page, url, payload, digest, kind, refers = (c[i].as_py() for c in batch.columns)
                if out is None:
                    store.create_dir(f"{folder}/_attempts", recursive=True)
                    out, size = store.open_output_stream(f"{attempt}-{number}"), 0
                    out.write(_member(_record("warcinfo", [("WARC-Record-ID", f"<urn:info:{place}-{number}>"), ("WARC-Date", DATE)], b"")))
                headers = [("WARC-Record-ID", f"<urn:page:{'' if page is None else page}>"), ("WARC-Date", DATE),
                           ("WARC-Target-URI", _header_value(url)), ("WARC-Payload-Digest", f"sha1:{digest}"),
                           ("Content-Type", "application/http; msgtype=response")]
                if kind == "revisit":
                    headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers}>")]
                http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
                data = _member(_record(kind, headers, http if kind == "revisit" else http + payload))
                out.write(data)
                size += len(data)
                if size >= FILE_BYTES:
                    close()
                    number, out = number + 1, None
        if out is not None:
            close()
            number += 1
        yield pa.RecordBatch.from_arrays([pa.array([number])], ["files"])

    return plan_records(spark, pages).mapInArrow(run, "files long").agg(F.sum("files").alias("n")).first()["n"] or 0


@dataclass
class Archive(InputPartition):
    """One archive file."""

    path: str

    def __init__(self, path: str):
        self.path = path


class Damaged(ValueError):
    """An archive that breaks off, or whose bytes are not what it announces."""


class _Member:
    """One record of an archive, decoded only as far as asked for."""

    def __init__(self, file, gzipped: bool, end: int):
        self.file, self.start, self.end, self.size = file, file.tell(), end, None
        self.unpacker = None
        self.data = bytearray()
        if gzipped:
            head = file.read(12)
            if len(head) < 12:
                raise Damaged("it ends inside a member's header")
            if head[3] & 4:
                extra = file.read(struct.unpack("<H", head[10:12])[0])
                if extra[:2] == b"sl":
                    self.size = struct.unpack("<I", extra[4:8])[0]
            file.seek(self.start)
            self.unpacker = zlib.decompressobj(31)

    def more(self) -> bool:
        """Decode another chunk; False at the end of the member or, without compression, of the file."""
        if self.unpacker is not None and self.unpacker.eof:
            return False
        raw = self.file.read(CHUNK)
        if self.unpacker is None:
            self.data += raw
            return bool(raw)
        if not raw:
            raise Damaged("it ends inside a member")
        self.data += self.unpacker.decompress(raw)
        return True

    def upto(self, mark: bytes, start: int = 0, limit: int | None = None) -> int:
        """Place after ``mark``, decoding as needed; -1 if it does not end within the record or the first ``limit`` bytes."""
        at = self.data.find(mark, start, limit)
        while at < 0:
            start = max(start, len(self.data) - len(mark) + 1)
            if (limit is not None and len(self.data) >= limit) or not self.more():
                return -1
            at = self.data.find(mark, start, limit)
        return at + len(mark)

    def whole(self, length: int) -> None:
        """Decode the record's ``length`` bytes; a compressed one to its end, where its checksum is compared."""
        while (self.unpacker is not None or len(self.data) < length) and self.more():
            pass
        if len(self.data) < length:
            raise Damaged("a record is shorter than announced")

    def finish(self, length: int) -> None:
        """Go to the next record; ``length`` is this record's with its headers, without the line ends that close it."""
        if self.unpacker is None:
            to = self.start + length + len(CLOSE)
            short = self.start + length > self.end
        elif self.size is not None:
            to = self.start + self.size
            short = to > self.end
        else:
            n = len(self.data)
            self.data.clear()
            while self.more():
                n += len(self.data)
                self.data.clear()
            to, short = self.file.tell() - len(self.unpacker.unused_data), n < length
        if short:
            raise Damaged("it ends inside a record")
        self.file.seek(to)


def _headers(data: bytes | bytearray) -> dict[str, str]:
    lines = (line.partition(":") for line in data.decode("utf-8", "replace").split("\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, _, v in lines if k}


def _columns(headers: dict[str, str]) -> dict[str, str | None]:
    return {"record_type": headers.get("warc-type"), "record_id": headers.get("warc-record-id"), "target_uri": headers.get("warc-target-uri"),
            "date": headers.get("warc-date"), "refers_to": headers.get("warc-refers-to"), "payload_digest": headers.get("warc-payload-digest")}


def records(path: str, tests: list, payloads: bool = True, keep_damaged: bool = False) -> Iterator[tuple]:
    """Rows of ``SCHEMA`` of one archive. ``tests``: functions of the header columns that all must hold.

    Where the archive is damaged, the rows before that place are followed by ``Damaged`` or, with ``keep_damaged``, by one row of type
    ``damaged`` with the reason as ``record_id``; what lies behind it can't be found.
    """
    store, at = fs.FileSystem.from_uri(path)
    with store.open_input_file(at) as file:
        try:
            yield from _records(file, path.endswith(".gz"), tests, payloads)
        except (Damaged, zlib.error, struct.error) as fault:
            reason = f"{path}, at byte {file.tell()}: {fault}"
            if not keep_damaged:
                raise Damaged(reason) from fault
            columns = dict.fromkeys(_columns({})) | {"record_type": "damaged", "record_id": reason}
            if all(test(columns) for test in tests):
                yield (*columns.values(), None, None)


def _announced(headers: dict[str, str], default: str) -> int:
    value = headers.get("content-length", default)
    if not value.isdecimal():
        raise Damaged(f"a length of {value!r}")
    return int(value)


def _records(file, gzipped: bool, tests: list, payloads: bool) -> Iterator[tuple]:
    end = file.size()
    while file.tell() < end:
        member = _Member(file, gzipped, end)
        head = member.upto(HEAD_END)
        if head < 0:
            if not member.data.strip():
                return
            raise Damaged("it ends inside a record's headers")
        headers = _headers(member.data[:head])
        length = head + _announced(headers, "0")
        columns = _columns(headers)
        if all(test(columns) for test in tests):
            size, payload = None, None
            if columns["record_type"] in ("response", "revisit"):
                body = member.upto(HEAD_END, head, length)
                wanted = payloads and columns["record_type"] == "response"
                if wanted:
                    member.whole(length)
                if body > 0:
                    size = _announced(_headers(member.data[head:body]), str(length - body))
                    payload = bytes(member.data[body:length]) if wanted else None
            yield (*columns.values(), size, payload)
        member.finish(length)


def _test(pushed: Filter):
    """A filter as a function of the header columns, or None if the reader can't decide it."""
    names = ("record_type", "record_id", "target_uri", "payload_digest")
    name = pushed.attribute[0] if hasattr(pushed, "attribute") and len(pushed.attribute) == 1 else None
    if name not in names:
        return None
    if isinstance(pushed, EqualTo):
        return lambda c, v=pushed.value: c[name] == v
    if isinstance(pushed, In):
        return lambda c, v=frozenset(pushed.value): c[name] in v
    if isinstance(pushed, IsNotNull):
        return lambda c: c[name] is not None
    if isinstance(pushed, StringStartsWith):
        return lambda c, v=pushed.value: c[name] is not None and c[name].startswith(v)
    return None


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.payloads, self.pushed = options["path"], options.get("payload", "true").lower() == "true", []
        self.keep_damaged = options.get("damaged", "fail").lower() == "keep"

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for one in filters:
            if _test(one) is None:
                yield one
            else:
                self.pushed.append(one)

    def partitions(self) -> list[Archive]:
        store, folder = fs.FileSystem.from_uri(self.path)
        info = store.get_file_info(folder)
        found = [info] if info.type == fs.FileType.File else store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        names = sorted(f.base_name for f in found if f.base_name.endswith((".warc", ".warc.gz")))
        return [Archive(self.path if info.type == fs.FileType.File else f"{self.path.rstrip('/')}/{n}") for n in names]

    def read(self, partition: Archive) -> Iterator[pa.RecordBatch]:
        tests, rows, size = [_test(f) for f in self.pushed], [], 0
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        types = [pa.string()] * 6 + [pa.int64(), pa.binary()]
        for row in records(partition.path, tests, self.payloads, self.keep_damaged) if partition else ():
            rows.append(row)
            size += len(row[-1] or b"")
            if size >= BATCH_BYTES or len(rows) >= BATCH_ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)


class WarcSource(DataSource):
    """``spark.read.format("warc").load(folder or file)``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)


def read(spark: SparkSession, path: str, payloads: bool = True, damaged: str = "fail") -> DataFrame:
    """Records of the archives below ``path``; ``damaged``: ``fail`` or ``keep``. Switches the session's filter push-down for Python sources on."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").option("payload", str(payloads).lower()).option("damaged", damaged).load(path)


def pages_of(archived: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to``; a response's size and digest are those of the payload read."""
    kept = archived.where(F.col("record_type").isin("response", "revisit"))
    number = lambda c: F.regexp_extract(c, "^<urn:page:(-?[0-9]+)>$", 1)
    whole = F.col("record_type") == "response"
    return kept.select(
        F.nullif(number("record_id"), F.lit("")).cast("long").alias("page_id"),
        F.when(whole, F.octet_length("payload").cast("long")).otherwise(F.col("payload_length")).alias("payload_bytes"),
        F.when(whole, F.sha1("payload")).otherwise(F.regexp_replace("payload_digest", "^sha1:", "")).alias("payload_digest"),
        "record_type", F.nullif(number("refers_to"), F.lit("")).cast("long").alias("refers_to"))
