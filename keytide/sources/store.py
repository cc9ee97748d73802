"""Scans of a keyed store through a client that the caller plugs in.

The store keeps its rows by ranges of a hash of the key.  Its client says which pieces
of work a scan has, or a lookup of some keys, and reads one of them; Spark runs each as a
task.  A lookup's keys reach the client, so it touches the ranges of those keys only.

The keys are an option of the scan and not a filter pushed by the optimizer: in Spark 4.1 all
uses of a Python source's DataFrame share what the last pushed filter left of it, so one that is read
twice, with a filter and without, loses rows.

``FileClient`` reads what ``export`` writes, a folder of files per range.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Sequence
from importlib import import_module
from typing import Any, Protocol

import pyarrow as pa
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from keytide.sources.shards import shard_of

FORMAT = "keytide_store"
RANGES = 16


class Client(Protocol):
    """A store's client.  It is made anew in the planner and in every task, from the scan's options."""

    key: str

    def plan(self, keys: Sequence[Any] | None) -> list[Any]:
        """Pieces of work, small and picklable, that together hold the rows of the keys, or all rows."""

    def read(self, piece: Any, columns: Sequence[str]) -> Iterator[pa.RecordBatch]:
        """A piece's rows."""


class FileClient:
    """Files by ranges of the key's hash, as ``export`` writes them; a piece is a file and the keys wanted of it."""

    def __init__(self, options: dict[str, str]):
        self.key = options["key"]
        self.system, self.base = fs.FileSystem.from_uri(options["path"])

    def plan(self, keys: Sequence[Any] | None) -> list[tuple[str, list | None]]:
        pieces = []
        for folder in self._folders(self.base):  # one, named after the number of ranges
            ranges = int(folder.rpartition("=")[2])
            wanted = None if keys is None else {}
            for key in keys or ():
                wanted.setdefault(range_of(key, ranges), []).append(key)
            for split in self._folders(folder):
                number = int(split.rpartition("=")[2])
                if wanted is None or number in wanted:
                    of = None if wanted is None else wanted[number]
                    pieces += [(path, of) for path in self._files(split)]
        return pieces

    def read(self, piece: tuple[str, list | None], columns: Sequence[str]) -> Iterator[pa.RecordBatch]:
        path, keys = piece
        file = ds.dataset(path, filesystem=self.system, format="parquet")
        yield from file.to_batches(columns=list(columns), filter=None if keys is None else ds.field(self.key).isin(keys))

    def _listed(self, folder: str) -> list[fs.FileInfo]:
        found = self.system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        return sorted(found, key=lambda f: f.path)

    def _folders(self, folder: str) -> list[str]:
        return [f.path for f in self._listed(folder) if f.type == fs.FileType.Directory and "=" in f.base_name]

    def _files(self, folder: str) -> list[str]:
        return [f.path for f in self._listed(folder) if f.type == fs.FileType.File and f.base_name[0] not in "_."]


def range_of(key: Any, ranges: int) -> int:
    """The range that ``shard_of`` gives a key that is text or a whole number."""
    return int(hashlib.md5(str(key).encode()).hexdigest()[:8], 16) * ranges >> 32


class Piece(InputPartition):
    def __init__(self, work: Any):
        super().__init__(0)
        self.work = work


class StoreReader(DataSourceReader):
    """One task per piece of the client's plan.

    Options: ``client``, its class as ``module:name``, and ``keys``, a JSON list, for a lookup.
    """

    def __init__(self, schema: T.StructType, options: dict[str, str]):
        self.schema, self.options = schema, dict(options)

    def client(self) -> Client:
        module, _, name = self.options["client"].partition(":")
        return getattr(import_module(module), name)(self.options)

    def partitions(self) -> list[Piece]:
        keys = json.loads(self.options["keys"]) if "keys" in self.options else None
        return [Piece(work) for work in self.client().plan(keys)]

    def read(self, partition: Piece | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # what Spark reads where no piece is planned
            return
        target = to_arrow_schema(self.schema)
        for batch in self.client().read(partition.work, self.schema.names):
            yield from pa.Table.from_batches([batch]).select(self.schema.names).cast(target).to_batches()


class StoreSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def reader(self, schema: T.StructType) -> StoreReader:
        return StoreReader(schema, self.options)


def scan_store(
    spark: SparkSession, schema: T.StructType, client: str, keys: Sequence[str | int] | None = None, **options: str
) -> DataFrame:
    """The store's columns named in ``schema``, of all rows or of those with one of ``keys``.

    ``client`` is ``module:name`` of a class that workers can import; the other options are its own.
    A null is no key of a lookup, and a key named twice is looked up once.
    """
    spark.dataSource.register(StoreSource)
    reader = spark.read.format(FORMAT).schema(schema).options(client=client, **options)
    if keys is not None:
        reader = reader.option("keys", json.dumps(sorted({k for k in keys if k is not None})))
    return reader.load()


def export(rows: DataFrame, path: str, key: str, ranges: int = RANGES) -> None:
    """Write rows for ``FileClient``, by range of the hash of ``key``, a column of text or whole numbers.

    Every task writes its own file of a range, so rows do not move, and a range with a hot key has as
    many files as there were tasks.  A null key is in the first range.
    """
    split = shard_of(F.col(f"`{key}`").cast("string"), ranges)
    placed = rows.withColumns({"_ranges": F.lit(ranges), "_range": split}).sortWithinPartitions("_range", f"`{key}`")
    placed.write.mode("errorifexists").partitionBy("_ranges", "_range").parquet(path)


def scan_files(spark: SparkSession, path: str, schema: T.StructType, key: str, keys: Sequence[str | int] | None = None) -> DataFrame:
    """What ``export`` wrote, or its rows with one of ``keys``."""
    return scan_store(spark, schema, f"{__name__}:{FileClient.__name__}", keys, path=path, key=key)
