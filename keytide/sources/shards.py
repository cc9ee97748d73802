"""A sharded stream of keyed records in shared files: its sink and its source.

Under ``path`` lie the records, a Parquet file per writing task, and a manifest
per batch.  A record's place is its shard, by a hash of its key, and its
position there.  A batch shows as a whole once its manifest is there, written
beside and moved in place; a manifest says where each shard ends, so the newest
one alone gives the latest position.

Tasks write and read rows; the driver handles file names and counts.  A batch
that was committed before adds nothing when it comes again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamArrowWriter,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.streaming import StreamingQuery

FORMAT = "keytide_shards"
SHARDS = 8
PARTITION_ROWS = 1_000_000  # that one task reads
LIMIT = 10_000  # records of a shard in a micro-batch
SCHEMA = "shard int, position long, key string, value binary"
STORED = pa.schema([("shard", pa.int32()), ("key", pa.string()), ("value", pa.binary())])


def shard_of(key: Column, shards: int) -> Column:
    """Shards are equal ranges of the first 32 bits of the key's MD5; a null key is in the first."""
    hashed = F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("long")
    return F.coalesce(F.shiftright(hashed * shards, 32), F.lit(0)).cast("int")


def for_shards(records: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Records ``key, value`` as the sink takes them: with their shard, and by shard within each task."""
    rows = records.select(shard_of(F.col("key"), shards).alias("shard"), F.col("key").cast("string"), F.col("value").cast("binary"))
    return rows if records.isStreaming else rows.sortWithinPartitions("shard")


@dataclass
class Segment:
    """Rows ``row .. row + count`` of a file: a shard's records from position ``first`` on."""

    shard: int
    first: int
    file: str
    row: int
    count: int


class Log:
    """The manifests and files under a path."""

    def __init__(self, path: str):
        self.system, self.base = fs.FileSystem.from_uri(path)

    def file(self, name: str) -> str:
        return f"{self.base}/data/{name}.parquet"

    def numbers(self) -> list[int]:
        """Of the committed batches, in order."""
        listed = self.system.get_file_info(fs.FileSelector(f"{self.base}/batches", allow_not_found=True))
        return sorted(int(f.base_name.removesuffix(".json")) for f in listed if f.base_name.endswith(".json"))

    def manifest(self, number: int) -> dict:
        with self.system.open_input_stream(f"{self.base}/batches/{number:012d}.json") as source:
            return json.loads(source.read())

    def ends(self) -> dict[str, int]:
        """Each shard's end, as the newest manifest has it."""
        numbers = self.numbers()
        return self.manifest(numbers[-1])["ends"] if numbers else {}

    def commit(self, number: int, files: list[tuple[str, list[tuple[int, int]]]]) -> bool:
        """Publish files, each with its ``(shard, rows)`` in order; false if the batch is there already."""
        numbers = self.numbers()
        if number in numbers:
            return False
        if numbers and number < numbers[-1]:
            raise ValueError(f"batch {number} comes after batch {numbers[-1]}")
        ends = self.manifest(numbers[-1])["ends"] if numbers else {}
        segments = []
        for name, parts in sorted(files):
            row = 0
            for shard, count in parts:
                first = ends.get(str(shard), 0)
                segments.append([shard, first, name, row, count])
                ends[str(shard)] = first + count
                row += count
        self.write(f"batches/{number:012d}.json", {"ends": ends, "segments": segments})
        return True

    def write(self, name: str, content: dict) -> None:
        """A small file that is there whole or not at all."""
        place = f"{self.base}/{name}"
        self.system.create_dir(place.rsplit("/", 1)[0], recursive=True)
        draft = f"{place}.{uuid.uuid4().hex}.draft"
        with self.system.open_output_stream(draft) as out:
            out.write(json.dumps(content).encode())
        self.system.move(draft, place)

    def segments(self, start: dict[str, int], end: dict[str, int]) -> Iterator[Segment]:
        """What lies between two positions, read from the newest manifest back to the start."""
        for number in reversed(self.numbers()):
            manifest = self.manifest(number)
            for shard, first, file, row, count in manifest["segments"]:
                low = max(first, start.get(str(shard), 0))
                high = min(first + count, end.get(str(shard), 0))
                if low < high:
                    yield Segment(shard, low, file, row + low - first, high - low)
            before = {str(s): f for s, f, *_ in reversed(manifest["segments"])}  # each shard's first of the batch
            if all(before.get(s, e) <= start.get(s, 0) for s, e in manifest["ends"].items()):
                return


class Part(InputPartition):
    def __init__(self, segments: list[Segment]):
        super().__init__(0)
        self.segments = segments


def parts_of(segments: Iterator[Segment], rows: int) -> list[Part]:
    """Segments in tasks of about ``rows`` records; a longer one is cut."""
    parts: list[Part] = []
    held = rows
    for s in sorted(segments, key=lambda s: (s.file, s.row)):
        done = 0
        while done < s.count:
            if held >= rows:
                parts.append(Part([]))
                held = 0
            count = min(s.count - done, rows - held)
            parts[-1].segments.append(Segment(s.shard, s.first + done, s.file, s.row + done, count))
            done, held = done + count, held + count
    return parts


def read_part(log: Log, part: Part) -> Iterator[pa.RecordBatch]:
    for s in part.segments:
        with log.system.open_input_file(log.file(s.file)) as source:
            file = pq.ParquetFile(source)
            row, position = 0, s.first
            for group in range(file.num_row_groups):
                n = file.metadata.row_group(group).num_rows
                if row + n > s.row and row < s.row + s.count:  # other row groups are not read
                    table = file.read_row_group(group, ["key", "value"])
                    low, high = max(s.row - row, 0), min(s.row + s.count - row, n)
                    for batch in table.slice(low, high - low).to_batches():
                        places = pa.array(range(position, position + batch.num_rows), pa.int64())
                        position += batch.num_rows
                        shard = pa.array([s.shard] * batch.num_rows, pa.int32())
                        yield pa.RecordBatch.from_arrays([shard, places, *batch.columns], ["shard", "position", "key", "value"])
                row += n


class ShardReader(DataSourceReader):
    """All records up to the newest manifest."""

    def __init__(self, options: dict):
        self.path, self.rows = options["path"], int(options.get("partitionRows", PARTITION_ROWS))

    def partitions(self) -> list[Part]:
        log = Log(self.path)
        return parts_of(log.segments({}, log.ends()), self.rows) or [Part([])]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        return read_part(Log(self.path), partition)


class ShardStreamReader(DataSourceStreamReader):
    """An offset per shard.

    Options: ``start`` is ``latest`` or ``earliest`` and counts only without a
    checkpoint.  ``positions`` is a folder of this consumer's own that keeps the
    last planned position, also that of a start that found nothing to read.
    ``limit`` is how many records of each shard a batch takes at most, and an
    ``availableNow`` start in all; it needs ``positions``, as after a restart Spark
    asks for the next position before it says where it stopped.
    """

    def __init__(self, options: dict):
        self.path, self.rows = options["path"], int(options.get("partitionRows", PARTITION_ROWS))
        self.start = options.get("start", "latest")
        if self.start not in ("latest", "earliest"):
            raise ValueError(f"start={self.start!r}: use 'latest' or 'earliest'")
        self.limit = int(options["limit"]) if options.get("limit") else None
        if self.limit is not None and not options.get("positions"):
            raise ValueError("limit: name the folder of this consumer's positions")
        self.kept = Log(options["positions"]) if options.get("positions") else None
        self.planned: dict[str, int] | None = None

    def initialOffset(self) -> dict:
        """Asked for only without a checkpoint, maybe after ``latestOffset``; a kept position wins."""
        if self.planned is None:
            self.planned = self._last()
        if self.planned is None:
            self.planned = Log(self.path).ends() if self.start == "latest" else {}
            self._keep()
        return self.planned

    def latestOffset(self) -> dict:
        ends = Log(self.path).ends()
        if self.limit is None:
            return ends
        self.initialOffset()
        return {s: min(e, self.planned.get(s, 0) + self.limit) for s, e in ends.items()}

    def partitions(self, start: dict, end: dict) -> list[Part]:
        self.planned = end
        self._keep()
        return parts_of(Log(self.path).segments(start, end), self.rows)

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        return read_part(Log(self.path), partition)

    def _keep(self) -> None:
        if self.kept:
            self.kept.write("planned.json", self.planned)

    def _last(self) -> dict[str, int] | None:
        if not self.kept or self.kept.system.get_file_info(f"{self.kept.base}/planned.json").type == fs.FileType.NotFound:
            return None
        with self.kept.system.open_input_stream(f"{self.kept.base}/planned.json") as source:
            return json.loads(source.read())


@dataclass
class Written(WriterCommitMessage):
    file: str | None
    parts: list[tuple[int, int]]


class _Tasks:
    """What batch and stream writers share: the task's file, and its removal."""

    def __init__(self, options: dict):
        self.path = options["path"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """One file per task, named anew by each attempt; runs of one shard are noted in order."""
        log, name, parts, out = Log(self.path), uuid.uuid4().hex, [], None
        try:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                if out is None:
                    log.system.create_dir(f"{log.base}/data", recursive=True)
                    out = pq.ParquetWriter(log.file(name), STORED, filesystem=log.system, compression="zstd")
                table = pa.Table.from_batches([batch]).select(STORED.names).sort_by("shard").cast(STORED)
                out.write_table(table)
                for shard, count in zip(*(x.tolist() for x in _streaks(table.column("shard").to_numpy()))):
                    if parts and parts[-1][0] == shard:
                        parts[-1] = (shard, parts[-1][1] + count)
                    else:
                        parts.append((shard, count))
        finally:
            if out is not None:
                out.close()
        return Written(name if out is not None else None, parts)

    def publish(self, messages: list[Written | None], number: int) -> None:
        files = [(m.file, m.parts) for m in messages if m and m.file]
        if not Log(self.path).commit(number, files):
            self.drop(messages)

    def drop(self, messages: list[Written | None]) -> None:
        log = Log(self.path)
        for m in messages:
            if m and m.file and log.system.get_file_info(log.file(m.file)).type == fs.FileType.File:
                log.system.delete_file(log.file(m.file))


def _streaks(shards):
    import numpy as np

    first = np.flatnonzero(np.append(True, shards[1:] != shards[:-1]))
    return shards[first], np.diff(np.append(first, len(shards)))


class ShardWriter(_Tasks, DataSourceArrowWriter):
    """A batch write is the next batch."""

    def commit(self, messages: list) -> None:
        self.publish(messages, max(Log(self.path).numbers(), default=-1) + 1)

    def abort(self, messages: list) -> None:
        self.drop(messages)


class ShardStreamWriter(_Tasks, DataSourceStreamArrowWriter):
    """A micro-batch keeps its number, so that one that runs again is not published twice.

    The numbers go on from the query's checkpoint: a log has one streaming writer.
    """

    def commit(self, messages: list, batchId: int) -> None:
        self.publish(messages, batchId)

    def abort(self, messages: list, batchId: int) -> None:
        self.drop(messages)


class ShardSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ShardReader:
        return ShardReader(self.options)

    def streamReader(self, schema) -> ShardStreamReader:
        return ShardStreamReader(self.options)

    def writer(self, schema, overwrite: bool) -> ShardWriter:
        if overwrite:
            raise ValueError(f"{FORMAT}: records are only added")
        return ShardWriter(self.options)

    def streamWriter(self, schema, overwrite: bool) -> ShardStreamWriter:
        return ShardStreamWriter(self.options)


def use_shards(spark: SparkSession) -> str:
    """Make the format known to a session; returns its name."""
    spark.dataSource.register(ShardSource)
    return FORMAT


def send(records: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Add a batch of records ``key, value`` to a sharded stream."""
    for_shards(records, shards).write.format(use_shards(records.sparkSession)).mode("append").save(path)


def stream_shards(
    spark: SparkSession, path: str, start: str = "latest", limit: int | None = None, positions: str | None = None
) -> DataFrame:
    """A sharded stream; see ``ShardStreamReader`` for the options."""
    reader = spark.readStream.format(use_shards(spark)).option("start", start)
    for name, value in (("limit", limit), ("positions", positions)):
        reader = reader if value is None else reader.option(name, value)
    return reader.load(path)


def send_stream(records: DataFrame, path: str, checkpoint: str, shards: int = SHARDS) -> StreamingQuery:
    """Start to send a stream of records ``key, value``; each is there once, however often a batch runs."""
    rows = for_shards(records, shards)
    writer = rows.writeStream.format(use_shards(records.sparkSession)).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """All records of a sharded stream, as a batch."""
    return spark.read.format(use_shards(spark)).load(path)
