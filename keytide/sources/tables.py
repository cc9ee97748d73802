"""Namespaces, keyed tables, scans and literal rows.

A keyed table ``ns.t`` is three ordinary catalog objects:

* ``ns.t_log``: all writes, one partition per ``(epoch, batch_id)``;
* a bucketed snapshot of the rows up to some batch, once it has been compacted;
* the view ``ns.t``: the current row of each key, which is what readers scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from keytide.operators.align import to_records
from keytide.operators.current import greatest_write
from keytide.schemas import TableSpec

# Where a write stands among the writes to its key, oldest first.  Within a
# writer's epoch its own order counts before the batches it was cut into.
ARRIVAL = ("epoch", "seq", "batch_id")


def create_namespace(
    spark: SparkSession, name: str, if_not_exists: bool = False, location: str | None = None
) -> None:
    guard = "IF NOT EXISTS " if if_not_exists else ""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE {guard}{name}{where}")


def drop_namespace(spark: SparkSession, name: str) -> None:
    """Drop the namespace and its tables; no error if there is none."""
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def use_namespace(spark: SparkSession, name: str) -> None:
    spark.sql(f"USE {name}")


def create_table(spark: SparkSession, spec: TableSpec, if_not_exists: bool = False, fmt: str = "parquet") -> None:
    guard = "IF NOT EXISTS " if if_not_exists else ""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in spec.schema)
    clustering = ", ".join(f"{c} DESC" for c in spec.clustering)
    properties = (
        f"TBLPROPERTIES ('partition_key'='{', '.join(spec.partition_key)}', 'clustering'='{clustering}')"
    )
    spark.sql(
        f"CREATE TABLE {guard}{spec.log} ({columns}, seq BIGINT, epoch BIGINT, batch_id BIGINT) "
        f"USING {fmt} PARTITIONED BY (epoch, batch_id) {properties}"
    )
    if not (if_not_exists and spark.catalog.tableExists(spec.name)):
        spark.sql(f"CREATE VIEW {spec.name} AS {current_sql(spec)}")


def after(epoch: int, batch_id: int) -> str:
    """The condition on a write that came after a batch."""
    return f"epoch > {epoch} OR (epoch = {epoch} AND batch_id > {batch_id})"


def current_sql(
    spec: TableSpec, snapshot: str | None = None, mark: tuple[int, int] | None = None
) -> str:
    """SQL of the view: the last write of each key.

    With a snapshot, the writes after ``mark`` replace its rows.  The anti join
    shuffles those writes only, as the snapshot is bucketed by the primary key;
    Spark turns it into a broadcast when they are small enough for that.
    """
    columns = ", ".join(spec.columns)
    key = ", ".join(spec.primary_key)
    last = greatest_write(spec.columns, spec.primary_key, ARRIVAL)
    values = ", ".join(c if c in spec.primary_key else f"_last.{c} AS {c}" for c in spec.columns)
    where = f" WHERE {after(*mark)}" if mark is not None else ""
    written = (
        f"SELECT {values} FROM (SELECT {key}, {last} AS _last FROM {spec.log}{where} GROUP BY {key})"
    )
    if snapshot is None:
        return written
    same = " AND ".join(f"s.{c} = w.{c}" for c in spec.primary_key)
    return (
        f"SELECT {columns} FROM {snapshot} s LEFT ANTI JOIN "
        f"(SELECT DISTINCT {key} FROM {spec.log}{where}) w ON {same} UNION ALL {written}"
    )


def scan(
    spark: SparkSession,
    name: str,
    columns: Sequence[str] | None = None,
    fmt: str | None = None,
    **options: str,
) -> DataFrame:
    """Rows of a table or, with ``fmt``, of whatever that connector calls ``name``.

    A table's file list is read anew, as another session may have added a batch.
    """
    if fmt is None:
        spark.catalog.refreshTable(name)
        rows = spark.table(name)
    else:
        rows = spark.read.format(fmt).options(**options).load(name)
    return rows.select(*columns) if columns else rows


def scan_keyed(spark: SparkSession, spec: TableSpec) -> DataFrame:
    """Current rows of a keyed table."""
    spark.catalog.refreshTable(spec.log)
    return scan(spark, spec.name)


def scan_records(spark: SparkSession, spec: TableSpec) -> DataFrame:
    """Current rows of a keyed table as typed records."""
    return to_records(scan_keyed(spark, spec), spec)


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A few rows given in the program, such as a fixture."""
    return spark.createDataFrame(list(rows), schema)
