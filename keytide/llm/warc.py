"""WARC archives: a writer, and a Python data source that reads headers first.

Every record that is written is a gzip member of its own whose extra field holds the member's
length, as gzip allows.  The reader takes a record's headers from the first bytes
of its member and, unless the record is wanted with its payload, goes on to the
next member without inflating the rest.  In an uncompressed archive it goes on by the
record's length; one whose members have no such field is inflated piece by piece, and what is
not wanted is dropped.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import struct
import zlib
from collections.abc import Iterator, Mapping, Sequence
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from keytide.llm.common import cut
from keytide.llm.storage import list_files, open_file, write_whole

SUFFIX = ".warc.gz"
SUFFIXES = (SUFFIX, ".warc")  # that are read
FILE_BYTES = 32 << 20
PARTITION_BYTES = 32 << 20
HEAD_BYTES = 4096
SKIP_BYTES = 1 << 20
BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20
MEMBER = struct.Struct("<4sIBBHBBHI")  # gzip header with one extra field: id "KL", 4 bytes, the member's length
LEVEL = 4

SCHEMA = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, record_id string, payload binary"
)
ARROW = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("record_id", pa.string()), ("payload", pa.binary()),
])
# Columns that filters can be pushed down for, and the header each comes from.
HEADERS = {
    "record_type": "WARC-Type", "page_id": "WARC-Record-ID", "url": "WARC-Target-URI", "refers_to": "WARC-Refers-To",
    "payload_bytes": "X-Payload-Length", "payload_digest": "WARC-Payload-Digest", "record_id": "WARC-Record-ID",
}


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def member(block: bytes) -> bytes:
    """A gzip member that knows its own length."""
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, -15)
    body = packer.compress(block) + packer.flush()
    size = MEMBER.size + len(body) + 8
    head = MEMBER.pack(b"\x1f\x8b\x08\x04", 0, 0, 255, 8, ord("K"), ord("L"), 4, size)
    return head + body + struct.pack("<II", zlib.crc32(block), len(block) & 0xFFFFFFFF)


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _from_urn(text: str | None) -> int | None:
    """The page of an id that ``_urn`` made; other archives' ids name none."""
    value = (text or "").strip("<> ").removeprefix("urn:page:")
    return int(value) if value.isascii() and value.lstrip("-").isdigit() else None


def record(page_id: int | None, url: str | None, payload: bytes, payload_digest: str, refers_to: int | None) -> bytes:
    """A response with its payload, or a revisit that refers to one."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_urn(page_id)}",
        f"WARC-Payload-Digest: sha1:{payload_digest}", f"X-Payload-Length: {len(payload)}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.insert(3, f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=~', errors='surrogatepass')}")
    if revisit:
        lines += [f"WARC-Refers-To: {_urn(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return "\r\n".join([*lines, "", ""]).encode() + block + b"\r\n\r\n"


def _writer(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition = TaskContext.get().partitionId()
        number, held, size = 0, [], 0

        def flush() -> pa.RecordBatch:
            nonlocal number, held, size
            path = f"{folder}/part-{partition:06d}-{number:06d}{SUFFIX}"
            write_whole(path, held)
            out = pa.RecordBatch.from_pydict({"path": [path], "bytes": pa.array([size], pa.int64())})
            number, held, size = number + 1, [], 0
            return out

        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "html", "refers_to")]
            for page_id, url, html, refers_to in zip(*columns):
                payload = html.as_buffer().to_pybytes()
                made = member(record(page_id.as_py(), url.as_py(), payload, digest(payload), refers_to.as_py()))
                held.append(made)
                size += len(made)
                if size >= FILE_BYTES:
                    yield flush()
        if held:
            yield flush()

    return write


def write_archives(
    pages: DataFrame, folder: str, least_bytes: int = 0, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """Write a record per page to ``folder`` and return the files' ``path, bytes``.

    Of pages with equal payloads of at least ``least_bytes``, the one with the
    largest id is the response and the others revisit it; rows that repeat that
    id are responses as well.  A null page is empty; null ids have no order, so
    such a page is a response unless a page with an id has the same payload.
    Payloads move once, with their own id; only ids and digests meet by payload.
    """
    rows = pages.select(
        F.col(f"`{id_column}`").cast("long").alias("page_id"), F.col(f"`{url_column}`").cast("string").alias("url"),
        F.coalesce(F.col(f"`{html_column}`").cast("string"), F.lit("")).alias("html"),
    ).withColumn("key", F.when(F.octet_length("html") >= least_bytes, F.sha1(F.col("html").cast("binary"))))
    keyed = rows.select("page_id", "key").where("key is not null").distinct()
    largest = keyed.groupBy("key").agg(F.max("page_id").alias("largest"), F.count("*").alias("n")).where("n > 1").drop("n")
    revisits = keyed.join(largest, "key").where("not page_id <=> largest")
    revisits = revisits.select(F.col("page_id").alias("_id"), F.col("key").alias("_key"), F.col("largest").alias("refers_to"))
    joined = rows.join(revisits, F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")), "left")
    files = joined.select("page_id", "url", "html", "refers_to").mapInArrow(_writer(folder), "path string, bytes long")
    return cut(files)


class Part(InputPartition):
    def __init__(self, paths: list[str]):
        super().__init__(0)
        self.paths = paths


class WarcReader(DataSourceReader):
    """Plans groups of files, and tests headers before it decodes a payload.

    Option ``payload``: ``true`` inflates the payloads of responses and resources and checks
    their SHA-1 digests, ``false`` leaves them out.  Option ``where``: JSON lists of the values
    wanted of some of the columns in ``HEADERS``.
    """

    def __init__(self, options: dict):
        self.path = options["path"]
        self.payload = options.get("payload", "true").lower() == "true"
        self.partition_bytes = int(options.get("partitionBytes", PARTITION_BYTES))
        self.tests: list[tuple[str, tuple]] = []
        if options.get("recordTypes"):
            self.tests.append(("record_type", tuple(options["recordTypes"].split(","))))
        for name, values in json.loads(options.get("where", "{}")).items():
            if name not in HEADERS:
                raise ValueError(f"{name}: no column that headers answer")
            self.tests.append((name, tuple(v for v in values if v is not None)))

    def partitions(self) -> list[Part]:
        groups: list[list[str]] = [[]]
        held = 0
        for path, size in sorted(f for suffix in SUFFIXES for f in list_files(self.path, suffix)):
            if groups[-1] and held + size > self.partition_bytes:
                groups.append([])
                held = 0
            groups[-1].append(path)
            held += size
        return [Part(group) for group in groups]

    def read(self, partition: Part | None) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for path in partition.paths if partition else ():
            for row in self.records(path):
                rows.append(row)
                held += len(row["payload"] or b"")
                if len(rows) >= BATCH_ROWS or held >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, ARROW)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, ARROW)

    def wanted(self, row: dict) -> bool:
        return all(row[name] in values for name, values in self.tests)

    def records(self, path: str) -> Iterator[dict]:
        """The wanted records of a file, of members that know their length for as long as there are such."""
        with open_file(path) as file:
            place, end = 0, file.size()
            while place < end:
                start = file.read_at(min(HEAD_BYTES, end - place), place)
                size = member_size(start)
                if size is None:
                    file.seek(place)
                    source = io.BufferedReader(file, HEAD_BYTES)
                    yield from self.streamed(path, gzip.GzipFile(fileobj=source) if start[:2] == b"\x1f\x8b" else source)
                    return
                if place + size > end:
                    raise ValueError(f"{path} at {place}: the record is cut off")
                row = self.direct(file, place, size, start, path)
                if row is not None:
                    yield row
                place += size

    def direct(self, file, place: int, size: int, start: bytes, path: str) -> dict | None:
        """The record of a member of known size, if it is wanted."""
        unpacker = zlib.decompressobj(-15)
        body = start[MEMBER.size : size - 8]
        head = unpacker.decompress(body, HEAD_BYTES)
        read = min(len(start), size)
        while b"\r\n\r\n" not in head:  # headers longer than the first look
            body = unpacker.unconsumed_tail
            if not body:
                body = file.read_at(min(HEAD_BYTES, size - read), place + read)
                read += len(body)
            if not body:
                raise ValueError(f"{path} at {place}: a record without an end of its headers")
            head += unpacker.decompress(body, HEAD_BYTES)
        text, _, block = head.partition(b"\r\n\r\n")
        headers = parse(text)
        row = columns(headers)
        if not self.wanted(row):
            return None
        if self.payload and row["record_type"] == "response":
            rest = unpacker.unconsumed_tail + (file.read_at(size - read, place + read) if read < size else b"")
            block += unpacker.decompress(rest) + unpacker.flush()
            row["payload"] = checked(block.partition(b"\r\n\r\n")[2][: row["payload_bytes"]], row, f"{path} at {place}")
        return row

    def streamed(self, path: str, source) -> Iterator[dict]:
        """The wanted records of a file that is read from record to record."""
        number = 0
        while (line := source.readline()).strip() or line:
            if not line.strip():
                continue  # between records
            lines = [line]
            while (line := source.readline()).strip():
                lines.append(line)
            number += 1
            where = f"{path}, record {number}"
            headers = parse(b"".join(lines))
            left = int(headers["content-length"])
            row = columns(headers)
            http = row["record_type"] in ("response", "revisit", "request") and "application/http" in headers.get("content-type", "").lower()
            # A length that no header has is known after the block's own headers.
            late = row["payload_bytes"] is None
            known = [t for t in self.tests if not (late and t[0] == "payload_bytes")]
            if all(row[name] in values for name, values in known):
                if http:
                    left -= skip_head(source, left)
                if late:
                    row["payload_bytes"] = left
                if self.wanted(row):
                    if self.payload and row["record_type"] in ("response", "resource"):
                        payload = source.read(left)
                        if len(payload) < left:
                            raise ValueError(f"{where}: it is cut off")
                        row["payload"], left = checked(payload, row, where), 0
                    yield row
            skip(source, left, where)


def member_size(start: bytes) -> int | None:
    """The length that a gzip member says it has; none if it is another kind of file."""
    if len(start) < MEMBER.size or start[:4] != b"\x1f\x8b\x08\x04":
        return None
    *_, extra, first, second, length, size = MEMBER.unpack_from(start)
    if (extra, first, second, length) != (8, ord("K"), ord("L"), 4):
        return None
    if size <= MEMBER.size + 8:
        raise ValueError(f"a member of {size} bytes")
    return size


def skip_head(source, most: int) -> int:
    """Read a block's own headers, and the empty line behind them; returns their bytes."""
    read = 0
    while read < most:
        line = source.readline(most - read)
        read += len(line)
        if not line.strip():
            break
    return read


def skip(source, count: int, where: str) -> None:
    if isinstance(source, gzip.GzipFile):
        while count > 0:
            read = len(source.read(min(count, SKIP_BYTES)))
            if not read:
                raise ValueError(f"{where}: it is cut off")
            count -= read
    elif count:
        source.seek(count, io.SEEK_CUR)


def checked(payload: bytes, row: dict, where: str) -> bytes:
    """The payload, once its SHA-1 digest is right; sets the digest where no header has one."""
    found = digest(payload)
    given = row["payload_digest"]
    if given is None:
        row["payload_digest"] = found
    elif ":" not in given and given != found:
        raise ValueError(f"{where}: the payload does not have its digest")
    return payload


def parse(text: bytes) -> dict[str, str]:
    """A record's headers by their names in lower case; the first line is the version."""
    version, *lines = text.decode("utf-8", "replace").splitlines()
    if not version.startswith("WARC/"):
        raise ValueError(f"{version[:40]!r}: no WARC record")
    pairs = (line.partition(":") for line in lines)
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def columns(headers: dict[str, str]) -> dict:
    """What headers say of a record, without its payload.

    A SHA-1 digest is bare and any other keeps its algorithm's name.  ``payload_bytes`` is
    null if no header has it: only that of HTTP's own headers would tell.
    """
    size = headers.get("x-payload-length")
    given = headers.get("warc-payload-digest")
    return {
        "page_id": _from_urn(headers.get("warc-record-id")),
        "url": unquote(headers["warc-target-uri"]) if "warc-target-uri" in headers else None,
        "record_type": headers.get("warc-type"),
        "refers_to": _from_urn(headers.get("warc-refers-to")),
        "payload_bytes": None if size is None else int(size),
        "payload_digest": given and (given[5:] if given.lower().startswith("sha1:") else given),
        "record_id": headers.get("warc-record-id"),
        "payload": None,
    }


class PushedWarcReader(WarcReader):
    """Takes equalities on header columns from the optimizer as well."""

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            name = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if isinstance(f, EqualTo) and name in HEADERS:
                self.tests.append((name, (f.value,)))
            elif isinstance(f, In) and name in HEADERS:
                self.tests.append((name, tuple(f.value)))
            else:
                yield f


class WarcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        pushed = self.options.get("pushdown", "false").lower() == "true"
        return (PushedWarcReader if pushed else WarcReader)(self.options)


def read_archives(
    spark: SparkSession, folder: str, where: Mapping[str, Sequence] | None = None, pushdown: bool = False, **options: str
) -> DataFrame:
    """Records of the archives ``.warc.gz`` and ``.warc`` under ``folder``; see ``WarcReader`` for the options.

    ``where`` gives the values wanted of header columns.  With ``pushdown`` the DataFrame's own filters
    on them reach the headers too; such a DataFrame may be read once only, as in Spark 4.1 all
    uses of a Python source's DataFrame share the last filter that was pushed into it.  Records of other makers
    have a null ``page_id``; HTTP payloads are as stored, with their transfer's coding.
    """
    if pushdown:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)
    reader = spark.read.format("warc").options(**options).option("pushdown", str(pushdown).lower())
    return (reader.option("where", json.dumps({k: list(v) for k, v in where.items()})) if where else reader).load(folder)
