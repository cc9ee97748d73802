"""Streams that remember: the greatest write per key, and records seen before."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from keytide.operators.current import latest_per_key
from keytide.operators.upsert import append_batch, claim_epoch, write_partition
from keytide.operators.wire import accept, check_policies, parse_lines
from keytide.schemas import TableSpec
from keytide.session import setting
from keytide.streaming.ingest import BATCH_INTERVAL, to_lines

# The state lies on the executors' disks and in the checkpoint instead of their memory.
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
EVENT_KEY = ("key", "cmpkey", "ts_ms")


def ingest_latest(
    stream: DataFrame,
    spec: TableSpec,
    checkpoint: str,
    epoch: int | None = None,
    on_bad_shape: str = "drop",
    on_bad_field: str = "drop",
    available_now: bool = False,
    interval: str = BATCH_INTERVAL,
) -> StreamingQuery:
    """Upsert the greatest write of each key, whatever batches the stream is cut into.

    A streaming aggregate keeps the write with the greatest ``seq`` of every key
    and hands on the keys that a batch changed, so a lesser one that comes later
    changes nothing.  ``ingest`` needs no state; this one keeps an entry per
    key of the table and shuffles each batch, combined before, by key.  The
    aggregate has no malformed lines to set aside: quarantine them with ``ingest``.
    """
    check_policies(on_bad_shape, on_bad_field)
    if "quarantine" in (on_bad_shape, on_bad_field):
        raise ValueError("quarantine: malformed lines do not reach the aggregate's batches")
    epoch = claim_epoch(stream.sparkSession, spec, checkpoint, epoch)
    events = accept(parse_lines(to_lines(stream), keep=["seq"]), on_bad_shape, on_bad_field, keep=["seq"])
    latest = latest_per_key(events, EVENT_KEY, ["seq"])

    def upsert(batch: DataFrame, batch_id: int) -> None:
        append_batch(batch, spec, epoch, batch_id, True)

    writer = latest.writeStream.outputMode("update").foreachBatch(upsert).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    with setting(stream.sparkSession, STATE_STORE, ROCKSDB):
        return writer.start()


def once_each(records: DataFrame, position: Sequence[str], arrived: str, delay: str) -> DataFrame:
    """A stream's records without those delivered again, told by their place in the source.

    ``arrived`` is when the source first took a record and the same at each
    delivery.  Places are remembered until the watermark, ``delay`` behind the
    latest arrival, has passed them; what is delivered after that is late and
    dropped, as every record's first delivery has to be at most ``delay`` late.
    """
    return records.withWatermark(arrived, delay).dropDuplicatesWithinWatermark(list(position))


def write_once(records: DataFrame, table: str, checkpoint: str, epoch: int = 0) -> StreamingQuery:
    """Start to write a stream into a table partitioned by ``(epoch, batch_id)``, as far as it goes now."""
    writer = records.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    writer = writer.foreachBatch(lambda batch, batch_id: write_partition(batch, table, epoch, batch_id))
    with setting(records.sparkSession, STATE_STORE, ROCKSDB):
        return writer.start()
