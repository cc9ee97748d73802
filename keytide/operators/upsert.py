"""Writes to a keyed table, and its compaction."""

from __future__ import annotations

import hashlib
import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from keytide.operators.align import to_rows
from keytide.operators.current import latest_per_key
from keytide.schemas import TableSpec
from keytide.session import setting
from keytide.sources.tables import ARRIVAL, after, current_sql

SEQ = T.StructType([T.StructField("seq", T.LongType())])
BUCKET_BYTES = 512 * 1024 * 1024
WRITER = "writer."  # prefix of the properties that hold writers' epochs


def append_batch(
    records: DataFrame,
    spec: TableSpec,
    epoch: int | None = None,
    batch_id: int = 0,
    replay: bool = False,
) -> None:
    """Write one batch: afterwards each key it names has its last row of the batch.

    The batch is the table partition ``(epoch, batch_id)``, so writing it again
    replaces it.  The order of rows within the batch is the column ``seq``, if
    there is one.  The write does not shuffle.

    Without an ``epoch`` the write claims one of its own, after all others.  A
    batch at or below the last compacted one would never show, so it raises;
    ``replay`` says that it was written before, and then it changes nothing.
    """
    spark = records.sparkSession
    if epoch is None:
        epoch = claim_epoch(spark, spec, uuid.uuid4().hex)
    state = snapshot_state(spark, spec)
    if state and (epoch, batch_id) <= state["mark"]:
        if replay:
            return
        raise ValueError(f"{spec.name}: batch {(epoch, batch_id)} is at or below the compacted {state['mark']}")
    if "seq" not in records.columns:
        records = records.selectExpr("*", "0L as seq")
    no_key = " or ".join(f"{c} is null" for c in spec.primary_key)
    message = f"{spec.name}: NULL in the primary key"
    rows = to_rows(records, spec, extra=SEQ).where(
        f"if({no_key}, cast(raise_error('{message}') as boolean), true)"
    )
    write_partition(rows, spec.log, epoch, batch_id)
    spark.catalog.refreshTable(spec.log)


def write_partition(rows: DataFrame, table: str, epoch: int, batch_id: int) -> None:
    columns = ", ".join(f"{c}" for c in rows.columns)
    rows.sparkSession.sql(
        f"INSERT OVERWRITE TABLE {table} PARTITION (epoch = {int(epoch)}, batch_id = {int(batch_id)}) "
        f"SELECT {columns} FROM {{rows}}",
        rows=rows,
    )


def last_batch(spark: SparkSession, spec: TableSpec) -> tuple[int, int] | None:
    """The newest batch of the log, read from its partition list."""
    return max(_partitions(spark, spec), default=None)


def next_batch(spark: SparkSession, spec: TableSpec, epoch: int = 0) -> int:
    """The batch id for a further batch write under ``epoch``, above the compacted ones."""
    used = [b for e, b in _partitions(spark, spec) if e == epoch]
    state = snapshot_state(spark, spec)
    if state and state["mark"][0] > epoch:
        raise ValueError(f"{spec.name}: epoch {epoch} ended with the compaction of {state['mark']}")
    if state and state["mark"][0] == epoch:
        used.append(state["mark"][1])
    return max(used, default=-1) + 1


def claim_epoch(spark: SparkSession, spec: TableSpec, writer: str, epoch: int | None = None) -> int:
    """The epoch that belongs to ``writer``, kept in the view's properties.

    A new writer gets the one after all that were claimed, written or compacted,
    or the free one it asks for.
    """
    properties = _properties(spark, spec)
    name = f"{WRITER}{hashlib.sha256(writer.encode()).hexdigest()[:32]}"
    if name in properties:
        own = int(properties[name])
        if epoch not in (None, own):
            raise ValueError(f"{spec.name}: {writer} writes epoch {own}, not {epoch}")
        return own
    state = snapshot_state(spark, spec)
    used = {int(v) for k, v in properties.items() if k.startswith(WRITER)} | {e for e, _ in _partitions(spark, spec)}
    low = state["mark"][0] if state else -1
    if epoch is None:
        epoch = max(used | {low}) + 1
    elif epoch in used or epoch <= low:
        raise ValueError(f"{spec.name}: epoch {epoch} belongs to another writer or is compacted")
    spark.sql(f"ALTER VIEW {spec.name} SET TBLPROPERTIES ('{name}'='{epoch}')")
    return epoch


def compact(spark: SparkSession, spec: TableSpec, buckets: int | None = None) -> str | None:
    """Write the current rows as a new snapshot and switch the view to it.

    The old snapshot stays where it is until ``drop_compacted``, so running
    reads finish.
    """
    mark = last_batch(spark, spec)
    state = snapshot_state(spark, spec)
    if mark is None or (state and state["mark"] >= mark):
        return None
    if buckets is None:
        old = table_bytes(spark, state["snapshot"]) if state else 0
        buckets = max(buckets_for(table_bytes(spark, spec.log) + old), state["buckets"] if state else 0)
    spark.catalog.refreshTable(spec.log)
    key = list(spec.primary_key)
    snapshot = f"{spec.name}_snapshot_{mark[0]}_{mark[1]}_{uuid.uuid4().hex[:8]}"
    # Without an old snapshot, the shuffle that finds the last writes makes the buckets.
    with setting(spark, "spark.sql.shuffle.partitions", None if state else str(buckets)):
        rows = snapshot_rows(spark, spec, mark, buckets, state)
        rows.write.format("parquet").bucketBy(buckets, *key).sortBy(*key).saveAsTable(snapshot)
    replaced = [*_replaced(spark, spec), *([state["snapshot"]] if state else [])]
    writers = {k: v for k, v in _properties(spark, spec).items() if k.startswith(WRITER)}
    properties = {
        "snapshot": snapshot, "epoch": mark[0], "batch_id": mark[1], "buckets": buckets,
        "replaced": ",".join(replaced), **writers,
    }
    listed = ", ".join(f"'{k}'='{v}'" for k, v in properties.items())
    spark.sql(
        f"CREATE OR REPLACE VIEW {spec.name} TBLPROPERTIES ({listed}) AS {current_sql(spec, snapshot, mark)}"
    )
    return snapshot


def snapshot_rows(
    spark: SparkSession, spec: TableSpec, mark: tuple[int, int], buckets: int, state: dict | None
) -> DataFrame:
    """Rows up to ``mark``, hashed by the primary key into ``buckets`` partitions.

    An old snapshot is in these buckets already: only later writes move.
    """
    key = list(spec.primary_key)
    writes = spark.table(spec.log).where(f"not ({after(*mark)})")
    if state:
        writes = writes.where(after(*state["mark"]))
    latest = latest_per_key(writes, key, ARRIVAL).select(*spec.columns).repartition(buckets, *key)
    if not state:
        return latest
    kept = spark.table(state["snapshot"]).join(latest.select(*key).hint("merge"), key, "left_anti")
    return kept.select(*spec.columns).unionByName(latest).repartition(buckets, *key)


def drop_compacted(spark: SparkSession, spec: TableSpec) -> None:
    """Drop the batches and older snapshots that the current snapshot replaces.

    Snapshots are dropped by the names that compaction noted, and nothing else.
    Only for when no reader still uses the view as it was before.
    """
    state = snapshot_state(spark, spec)
    if not state:
        return
    old = [p for p in _partitions(spark, spec) if p <= state["mark"]]
    if old:
        specs = ", ".join(f"PARTITION (epoch = {e}, batch_id = {b})" for e, b in old)
        spark.sql(f"ALTER TABLE {spec.log} DROP IF EXISTS {specs}")
    for name in _replaced(spark, spec):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"ALTER VIEW {spec.name} SET TBLPROPERTIES ('replaced'='')")


def buckets_for(size: int) -> int:
    """A power of two, so that a bucket holds about ``BUCKET_BYTES``."""
    wanted = max(1, math.ceil(size / BUCKET_BYTES))
    return max(8, 1 << (wanted - 1).bit_length())


def table_bytes(spark: SparkSession, table: str) -> int:
    """Bytes of a table's files, by listing them."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS NOSCAN")
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Statistics'").first()
    return int(described["data_type"].split()[0]) if described else 0


def _partitions(spark: SparkSession, spec: TableSpec) -> list[tuple[int, int]]:
    """Batches of the log, from the catalog: one entry per batch not yet dropped."""
    listed = spark.sql(f"SHOW PARTITIONS {spec.log}").collect()
    found = [dict(part.split("=") for part in row["partition"].split("/")) for row in listed]
    return [(int(p["epoch"]), int(p["batch_id"])) for p in found]


def _properties(spark: SparkSession, spec: TableSpec) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {spec.name}").collect()}


def _replaced(spark: SparkSession, spec: TableSpec) -> list[str]:
    """Snapshots that a later one replaced and that are not dropped yet."""
    return [name for name in _properties(spark, spec).get("replaced", "").split(",") if name]


def snapshot_state(spark: SparkSession, spec: TableSpec) -> dict | None:
    """Snapshot, last batch in it and bucket count, as the view's properties hold them."""
    found = _properties(spark, spec)
    if "snapshot" not in found:
        return None
    mark = (int(found["epoch"]), int(found["batch_id"]))
    return {"snapshot": found["snapshot"], "mark": mark, "buckets": int(found["buckets"])}
