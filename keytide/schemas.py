"""Record schemas and the declaration of a keyed table."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import types as T

# Field names, types and defaults of the two records.
EVENT_RECORD = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("cmpkey", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
        T.StructField("event", T.StringType()),
        T.StructField("num", T.IntegerType()),
    ]
)
DEFAULT_EVENT = {"key": "", "cmpkey": "", "ts_ms": 0, "event": "0", "num": 0}
PAIR_RECORD = T.StructType(
    [T.StructField("key", T.IntegerType()), T.StructField("value", T.StringType())]
)

# A record as a stream carries it: partition key, payload and the position the
# stream gave it, which orders the writes to one key.
STREAM_RECORD = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("seq", T.LongType()),
    ]
)


@dataclass(frozen=True)
class TableSpec:
    """A keyed table: its columns, partition key and clustering columns.

    The primary key is the partition key followed by the clustering columns.
    Clustering columns order the rows of one partition key, newest first.
    """

    name: str
    schema: T.StructType
    partition_key: tuple[str, ...]
    clustering: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        # The catalog's names are in lower case.
        object.__setattr__(self, "name", self.name.lower())
        names = [*self.name.split("."), *self.schema.names]
        if not all(re.fullmatch(r"[A-Za-z_]\w*", n, re.ASCII) for n in names):
            raise ValueError(f"{self.name}: names are letters, digits and underscores, {names}")
        reserved = {"epoch", "batch_id", "seq"} & {c.lower() for c in self.schema.names}
        if reserved:
            raise ValueError(f"{self.name}: the table keeps its own columns {sorted(reserved)}")
        unknown = [c for c in self.primary_key if c not in self.schema.names]
        if unknown or not self.partition_key:
            raise ValueError(f"{self.name}: bad primary key, unknown columns {unknown}")
        if "." not in self.name:
            raise ValueError(f"{self.name}: give the table as namespace.table")

    @property
    def primary_key(self) -> tuple[str, ...]:
        return self.partition_key + self.clustering

    @property
    def namespace(self) -> str:
        return self.name.rsplit(".", 1)[0]

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    @property
    def log(self) -> str:
        """Every accepted write, one partition per batch."""
        return f"{self.name}_log"

    @property
    def quarantine(self) -> str:
        """Lines a stream set aside, one partition per batch."""
        return f"{self.name}_quarantine"


def pair_table(namespace: str, table: str = "kv", key_type: T.DataType | None = None) -> TableSpec:
    schema = T.StructType(
        [
            T.StructField("key", key_type or T.IntegerType()),
            T.StructField("value", T.StringType()),
        ]
    )
    return TableSpec(f"{namespace}.{table}", schema, ("key",))


def reading_table(namespace: str, table: str = "kv2") -> TableSpec:
    schema = T.StructType(
        [
            T.StructField("key", T.IntegerType()),
            T.StructField("ts", T.TimestampType()),
            T.StructField("value", T.StringType()),
        ]
    )
    return TableSpec(f"{namespace}.{table}", schema, ("key",), ("ts",))


def event_table(namespace: str, table: str = "eventrecord") -> TableSpec:
    schema = T.StructType(
        [
            T.StructField("key", T.StringType()),
            T.StructField("cmpkey", T.StringType()),
            T.StructField("ts", T.TimestampType()),
            T.StructField("event", T.StringType()),
            T.StructField("num", T.IntegerType()),
        ]
    )
    return TableSpec(f"{namespace}.{table}", schema, ("key", "cmpkey"), ("ts",))
