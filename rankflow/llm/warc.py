"""WARC archives as a Spark data source, read and written.

``spark.read.format("warc")`` plans partitions from a listing of the files, packing small ones
together. Predicates on the record type and on other header columns are pushed into the
reader (inside :func:`pushdown`, as Spark asks for a setting), which parses a record's headers first and passes over the
payload of a record that is not wanted. Archives are one gzip member per record; the member's ``sl`` extra field states its length
(the skip-length convention of record-wise compressed archives), so an unwanted record costs one seek after
its headers. Members without the field are inflated piece by piece and dropped.

Options: ``path`` (a file or folder, with any scheme that pyarrow's file systems know),
``payload`` (``false`` leaves payloads undecoded), ``pushdown`` (``true`` takes predicates) and ``targetBytes`` (bytes of
files per partition).

Defined results: a missing header is null. A payload is what follows the HTTP headers of an
``application/http`` block, or else the whole block; a revisit has none. An archive without
records gives no rows. Writing into a folder adds files; a failed write leaves none behind. A damaged archive raises an error
that names the file and the place: bytes that begin no record (line breaks at a file's end aside), a file that ends within a
record, a block shorter than its stated length, a gzip member that fails its checksum. The payload of a record that is
passed over by its stated length is not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceWriter,
    EqualTo,
    In,
    InputPartition,
    IsNotNull,
    StringStartsWith,
    WriterCommitMessage,
)

from rankflow.llm.common import picked
from rankflow.session import cut, scratch, scratch_path, session_settings

# Names and texts of the archive format.
VERSION = b"WARC/1.1"
HEADERS = {
    "record_id": "WARC-Record-ID",
    "record_type": "WARC-Type",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
    "content_type": "Content-Type",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http; msgtype=response"
GZIP_MAGIC = b"\x1f\x8b\x08"
EXTRA_FLAG = 4

SCHEMA = (
    "record_id string, record_type string, target_uri string, date string, payload_digest string, "
    "refers_to string, content_type string, content_length bigint, payload_length bigint, payload binary"
)
WRITE_SCHEMA = (
    "record_id string, record_type string, target_uri string, date string, payload_digest string, "
    "refers_to string, payload_length bigint, payload binary"
)
CHUNK = 1 << 16
TARGET_BYTES = 128 << 20
FILE_BYTES = 512 << 20
LEVEL = 6


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- records as bytes ------------------------------------------------------------------------


def encode_record(row) -> bytes:
    """One record, uncompressed. The HTTP headers state the payload's length, for revisits too."""
    payload = bytes(row["payload"] or b"") if row["record_type"] != "revisit" else b""
    block = (
        b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
        % row["payload_length"]
    ) + payload
    lines = [VERSION]
    values = {name: row[name] for name in HEADERS if name != "content_type"}
    values["content_type"] = HTTP_TYPE
    for name, value in values.items():
        if value is not None:
            prefix = "sha1:" if name == "payload_digest" else ""
            clean = str(value).replace("\r", "%0D").replace("\n", "%0A")
            lines.append(f"{HEADERS[name]}: {prefix}{clean}".encode())
    if row["record_type"] == "revisit":
        lines.append(f"WARC-Profile: {REVISIT_PROFILE}".encode())
    lines.append(b"Content-Length: %d" % len(block))
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(record: bytes) -> bytes:
    """A gzip member whose extra field holds its own length and that of ``record``."""
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, -zlib.MAX_WBITS)
    body = packer.compress(record) + packer.flush()
    size = 10 + 2 + 20 + len(body) + 8
    extra = b"sl" + struct.pack("<HQQ", 16, size, len(record))
    head = GZIP_MAGIC + bytes([EXTRA_FLAG]) + b"\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra
    return head + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


class DamagedArchive(ValueError):
    """Bytes that are no record where one is due."""


class Member:
    """Reads one gzip member, or one record of an uncompressed file, from ``start``."""

    def __init__(self, stream, start: int, end: int):
        self.stream, self.start, self.end, self.length = stream, start, end, None
        stream.seek(start)
        head = stream.read(12)
        self.packed = head.startswith(GZIP_MAGIC)
        if self.packed and len(head) == 12 and head[3] & EXTRA_FLAG:
            extra = stream.read(struct.unpack("<H", head[10:12])[0])
            if extra[:2] == b"sl" and len(extra) == 20:
                self.length = struct.unpack("<Q", extra[4:12])[0]
        stream.seek(start)
        self.unpacker = zlib.decompressobj(zlib.MAX_WBITS | 16) if self.packed else None
        # What is inflated and not yet read, how much of the file it took, and how much of the record was seen.
        self.held, self.taken, self.seen, self.done = b"", 0, 0, False

    def _damaged(self, what: str) -> DamagedArchive:
        return DamagedArchive(f"at byte {self.start}: {what}")

    def _more(self) -> None:
        raw = self.stream.read(CHUNK)
        if self.unpacker is None:
            self.done = not raw
            self.taken += len(raw)
            self.held += raw
            return
        if not raw:
            raise self._damaged("the file ends within a gzip member")
        try:
            self.held += self.unpacker.decompress(raw)
        except zlib.error as error:
            raise self._damaged(str(error)) from error
        self.taken += len(raw) - len(self.unpacker.unused_data)
        self.done = self.unpacker.eof

    def headers(self) -> dict[str, str]:
        """The headers by lower-case name."""
        while b"\r\n\r\n" not in self.held and not self.done:
            if len(self.held) >= 5 and not self.held.startswith(b"WARC/"):
                break
            self._more()
        head, found, self.held = self.held.partition(b"\r\n\r\n")
        if not found or not head.startswith(b"WARC/"):
            raise self._damaged("no record begins here")
        self.head_size = len(head) + 4
        fields = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])
        return {name.strip().lower(): value.strip() for name, _, value in fields}

    def block(self, size: int) -> bytes:
        parts = [self.held]
        have = len(self.held)
        while have < size and not self.done:
            self.held = b""
            self._more()
            parts.append(self.held)
            have += len(self.held)
        self.held = b"".join(parts)
        if have < size:
            raise self._damaged(f"a block of {size} bytes ends after {have}")
        return self.held[:size]

    def next_start(self, size: int, whole: bool) -> int:
        """Where the next record starts, passing over what was not read; a record read ``whole`` is checked to its end."""
        if self.unpacker is None:
            after = self.start + self.head_size + size + 4
        elif self.length is not None and not whole:
            after = self.start + self.length
        else:
            while not self.done:
                self.held = b""
                self._more()
            after = self.start + self.taken
        if after > self.end:
            raise self._damaged("the file ends within a record")
        return after


def http_parts(block: bytes) -> tuple[int | None, bytes]:
    """The length that an HTTP block states, and the payload that it holds."""
    head, _, payload = block.partition(b"\r\n\r\n")
    for line in head.split(b"\r\n"):
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"content-length" and value.strip().isdigit():
            return int(value), payload
    return None, payload


def read_records(stream, wanted=lambda row: True, payload: bool = True) -> Iterator[tuple]:
    """Rows of :data:`SCHEMA`. ``wanted`` sees the header columns before any payload is decoded."""
    start, end = 0, stream.seek(0, 2)
    while start < end:
        stream.seek(start)
        if not stream.read(16).strip(b"\r\n") and end - start <= 16:
            return  # line breaks at the end
        member = Member(stream, start, end)
        headers = member.headers()
        size = headers.get("content-length", "")
        if not size.isdigit():
            raise DamagedArchive(f"at byte {start}: a record states no length")
        size = int(size)
        row = {name: headers.get(header.lower()) for name, header in HEADERS.items()}
        if row["payload_digest"]:
            row["payload_digest"] = row["payload_digest"].removeprefix("sha1:")
        read = wanted(row)
        if read:
            http = (row["content_type"] or "").startswith("application/http")
            length, body = None, None
            if payload or not http:
                block = member.block(size)
                length, body = http_parts(block) if http else (size, block)
            else:
                probe = min(size, 1024)
                while True:
                    block = member.block(probe)
                    if b"\r\n\r\n" in block or probe >= size:
                        break
                    probe = min(size, probe * 4)
                length, _ = http_parts(block)
            if row["record_type"] == "revisit" or not payload:
                body = None
            yield (*row.values(), size, length, body)
        start = member.next_start(size, whole=read and payload)


# --- the data source -------------------------------------------------------------------------


@dataclass
class Files(InputPartition):
    paths: list[str]


@dataclass
class Written(WriterCommitMessage):
    paths: list[str]


def _filesystem(path: str):
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (
        pafs.LocalFileSystem(), path
    )


class WarcReader(DataSourceReader):
    """Reads whole files; tests on header columns are those that :class:`FilteringReader` takes over."""

    def __init__(self, options):
        self.path = options["path"]
        self.payload = options.get("payload", "true").lower() != "false"
        self.target = int(options.get("targetbytes", options.get("targetBytes", TARGET_BYTES)))
        self.tests: list[tuple[str, str, object]] = []

    def wanted(self, row: dict) -> bool:
        for name, kind, value in self.tests:
            have = row[name]
            if have is None:
                return False
            if kind == "eq" and have != value or kind == "in" and have not in value:
                return False
            if kind == "prefix" and not have.startswith(value):
                return False
        return True

    def partitions(self):
        """Files sorted by name, packed up to the target size; no file is opened here."""
        files, root = _filesystem(self.path)
        info = files.get_file_info(root)
        found = [info] if info.is_file else files.get_file_info(pafs.FileSelector(root, recursive=True))
        names = sorted(
            (f.path, f.size) for f in found
            if f.is_file and f.path.endswith((".warc", ".warc.gz")) and "/_" not in f.path[len(root):]
        )
        parts, held, size = [], [], 0
        for name, length in names:
            if held and size + length > self.target:
                parts.append(Files(held))
                held, size = [], 0
            held.append(name)
            size += length
        return [*parts, Files(held)] if held or not parts else parts

    def read(self, partition: Files):
        files, _ = _filesystem(self.path)
        for path in partition.paths:
            with files.open_input_file(path) as stream:
                try:
                    yield from read_records(stream, self.wanted, self.payload)
                except DamagedArchive as error:
                    raise DamagedArchive(f"{path}: {error}") from error


class FilteringReader(WarcReader):
    """The same with predicates pushed down, which Spark allows only while its setting is on."""

    def pushFilters(self, filters):
        """Takes over equality, membership, prefix and not-null tests on header columns."""
        kinds = {EqualTo: "eq", In: "in", StringStartsWith: "prefix", IsNotNull: "set"}
        for test in filters:
            kind = kinds.get(type(test))
            if kind and len(test.attribute) == 1 and test.attribute[0] in HEADERS:
                self.tests.append((test.attribute[0], kind, getattr(test, "value", None)))
            else:
                yield test


class WarcWriter(DataSourceWriter):
    """Tasks write under a name of their own; the driver moves finished files into place."""

    def __init__(self, options):
        self.path = options["path"]
        self.job = uuid.uuid4().hex

    def write(self, rows):
        files, root = _filesystem(self.path)
        folder = f"{root}/_temporary-{self.job}"
        files.create_dir(folder, recursive=True)
        names, stream, size = [], None, 0
        try:
            for row in rows:
                if stream is None or size >= FILE_BYTES:
                    if stream is not None:
                        stream.close()
                    names.append(f"{uuid.uuid4().hex}.warc.gz")
                    stream, size = files.open_output_stream(f"{folder}/{names[-1]}", compression=None), 0
                size += stream.write(gzip_member(encode_record(row))) or 0
        finally:
            if stream is not None:
                stream.close()
        return Written(names)

    def commit(self, messages):
        files, root = _filesystem(self.path)
        folder = f"{root}/_temporary-{self.job}"
        for name in (name for message in messages if message for name in message.paths):
            files.move(f"{folder}/{name}", f"{root}/{name}")
        if files.get_file_info(folder).type != pafs.FileType.NotFound:
            files.delete_dir(folder)

    def abort(self, messages):
        files, root = _filesystem(self.path)
        folder = f"{root}/_temporary-{self.job}"
        if files.get_file_info(folder).type != pafs.FileType.NotFound:
            files.delete_dir(folder)


class WarcDataSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        filtering = self.options.get("pushdown", "false").lower() == "true"
        return FilteringReader(self.options) if filtering else WarcReader(self.options)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcDataSource)


PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def pushdown(spark: SparkSession):
    """A context in which predicates on header columns reach the reader. What is read in it has to be used in it."""
    return session_settings(spark, {PUSHDOWN: "true"})


# --- pages to archives -----------------------------------------------------------------------


def page_records(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    date: str = "1970-01-01T00:00:00Z", min_revisit_bytes: int = 0,
) -> DataFrame:
    """A record per row; of equal payloads the one with the smallest id is the response.

    Payloads are equal if their lengths and SHA-256 digests are. Rows that repeat the response's id
    are responses too; a null id comes last. The smallest ids are found by partial aggregation
    and joined back, so that one payload shared by very many pages is no hot group.
    """
    named = picked(pages, id=id_col, url=url_col, html=html_col)
    body = named.select(
        "id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload")
    ).select("*", F.sha2("payload", 256).alias("same"), F.octet_length("payload").cast("bigint").alias("size"))
    firsts = (
        picked(pages, id=id_col, html=html_col)
        .select("id", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
        .select("id", F.sha2("payload", 256).alias("f_same"), F.octet_length("payload").cast("bigint").alias("f_size"))
        .groupBy("f_same", "f_size")
        .agg(F.min("id").alias("first"), F.count("*").alias("copies"))
        .filter((F.col("copies") > 1) & (F.col("f_size") >= min_revisit_bytes))
    )
    joined = body.join(
        firsts,
        (F.col("same") == F.col("f_same")) & (F.col("size") == F.col("f_size")), "left",
    )
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    record = lambda key: F.concat(F.lit("<urn:page:"), key.cast("string"), F.lit(">"))
    return joined.select(
        record(F.coalesce(F.col("id").cast("string"), F.lit("none"))).alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.col("url").alias("target_uri"),
        F.lit(date).alias("date"),
        base32(F.unhex(F.sha1("payload"))).alias("payload_digest"),
        F.when(revisit, record(F.col("first"))).alias("refers_to"),
        F.col("size").alias("payload_length"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


# The digits of base 32.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32(digest):
    """Base 32 of 20 bytes: four groups of 40 bits, each giving eight digits."""
    hexed = F.hex(digest)
    groups = [F.conv(F.substring(hexed, 1 + 10 * g, 10), 16, 10).cast("bigint") for g in range(4)]
    digits = F.split(F.lit(",".join(BASE32)), ",")
    return F.concat(*[
        F.get(digits, F.shiftright(group, 35 - 5 * d).bitwiseAND(31).cast("int"))
        for group in groups for d in range(8)
    ])


def write_archives(records: DataFrame, path: str) -> None:
    register(records.sparkSession)
    records.write.format("warc").mode("append").option("path", path).save()


def read_archives(spark: SparkSession, path: str, payload: bool = True, **options) -> DataFrame:
    register(spark)
    filtering = spark.conf.get(PUSHDOWN, "false")
    reader = spark.read.format("warc").option("path", path).option("payload", str(payload).lower()).option("pushdown", filtering)
    return reader.options(**options).load()


def page_of(record_id):
    """The page id in a record id that :func:`page_records` made; null for a page without one."""
    digits = F.regexp_extract(record_id, r"^<urn:page:(-?[0-9]+)>$", 1)
    return F.nullif(digits, F.lit("")).cast("bigint")


def round_trip(pages: DataFrame, **columns: str) -> DataFrame:
    """Writes the pages' archives below the shared folder and reads them back, ``(record_id, record_type, payload_length,
    payload_digest, refers_to)`` per record.

    Responses are decoded, and their lengths and digests computed from the bytes that come back. Revisits are
    read by their headers alone and take both from the response that they name, by its id and digest, as rows may share an id.
    The archives are gone afterwards.
    """
    spark = pages.sparkSession
    with scratch(spark) as own, pushdown(spark):
        path = scratch_path(spark, "archives")
        write_archives(page_records(pages, **columns), path)
        decoded = read_archives(spark, path).filter(F.col("record_type") == "response").select(
            "record_id", F.octet_length("payload").cast("bigint").alias("payload_length"),
            base32(F.unhex(F.sha1("payload"))).alias("payload_digest"),
        )
        responses = cut(decoded, "responses")
        headers = read_archives(spark, path, payload=False).filter(F.col("record_type") == "revisit")
        revisits = headers.select("record_id", "record_type", "payload_digest", "refers_to")
        held = responses.distinct().select(
            F.col("record_id").alias("r_id"), "payload_length", F.col("payload_digest").alias("r_digest")
        )
        met = revisits.join(
            held, (F.col("refers_to") == F.col("r_id")) & (F.col("payload_digest") == F.col("r_digest")), "left"
        ).select("record_id", "record_type", "payload_length", F.col("r_digest").alias("payload_digest"), "refers_to")
        whole = responses.withColumns(
            {"record_type": F.lit("response"), "refers_to": F.lit(None).cast("string")}
        ).unionByName(met)
        return own.result(cut(whole, "records"))
