"""Stream to table: frame, parse, upsert each micro-batch."""

from __future__ import annotations

import signal
import time
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from keytide.operators.upsert import append_batch, claim_epoch, compact, write_partition
from keytide.operators.wire import accept, check_policies, frame, parse_lines, set_aside
from keytide.schemas import TableSpec

# Batch interval and number of rows in a preview.
BATCH_INTERVAL = "10 seconds"
PREVIEW_ROWS = 10

Preview = Callable[[DataFrame, int], None]


def create_quarantine(spark: SparkSession, spec: TableSpec) -> None:
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {spec.quarantine} (seq BIGINT, status STRING, line STRING, "
        "epoch BIGINT, batch_id BIGINT) USING parquet PARTITIONED BY (epoch, batch_id)"
    )


def to_lines(stream: DataFrame) -> DataFrame:
    """Records or lines, as ``seq, line``."""
    if "line" in stream.columns:
        return stream.select("seq", "line")
    return frame(stream, keep=["seq"])


def ingest(
    stream: DataFrame,
    spec: TableSpec,
    checkpoint: str,
    epoch: int | None = None,
    on_bad_shape: str = "quarantine",
    on_bad_field: str = "quarantine",
    preview: Preview | None = None,
    available_now: bool = False,
    interval: str = BATCH_INTERVAL,
    compact_every: int = 0,
) -> StreamingQuery:
    """Start the upsert of a stream into ``spec``.

    ``checkpoint`` lies in the shared folder and belongs to this query.  It owns
    an epoch of the table, claimed when the query first starts; a query with
    another checkpoint gets the next one, so it rewrites nobody's batches.
    The source position is saved after a batch is written, and a batch that runs
    again replaces what it wrote before.  ``compact_every`` compacts the table
    after each so many batches, which keeps the log's files few.
    """
    check_policies(on_bad_shape, on_bad_field)
    quarantines = "quarantine" in (on_bad_shape, on_bad_field)
    if quarantines:
        create_quarantine(stream.sparkSession, spec)
    epoch = claim_epoch(stream.sparkSession, spec, checkpoint, epoch)
    parsed = parse_lines(to_lines(stream), keep=["seq"])

    def upsert(batch: DataFrame, batch_id: int) -> None:
        shared = quarantines or preview is not None
        if shared:
            batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            events = accept(batch, on_bad_shape, on_bad_field, keep=["seq"])
            if preview is not None:
                preview(events.orderBy("seq").limit(PREVIEW_ROWS), batch_id)
            if quarantines:
                aside = set_aside(batch, on_bad_shape, on_bad_field, keep=["seq"])
                write_partition(aside, spec.quarantine, epoch, batch_id)
            append_batch(events, spec, epoch, batch_id, True)
            if compact_every and (batch_id + 1) % compact_every == 0:
                compact(batch.sparkSession, spec)
        finally:
            if shared:
                batch.unpersist()

    writer = parsed.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()


def print_preview(rows: DataFrame, batch_id: int) -> None:
    print(f"batch {batch_id}")
    rows.show(PREVIEW_ROWS, truncate=False)


def drain(query: StreamingQuery) -> None:
    """Let the batch that runs or starts just now finish, then stop.

    What arrives meanwhile waits for the next start, so this ends on a source
    that never pauses.
    """
    try:
        before = query.lastProgress["batchId"] if query.lastProgress else -1
        while query.isActive:
            progress, status = query.lastProgress, query.status
            done = progress is not None and progress["batchId"] > before
            idle = not status["isTriggerActive"] and status["message"].startswith("Waiting")
            if done or idle:
                break
            time.sleep(0.05)
    finally:
        query.stop()


def run_until_stopped(query: StreamingQuery) -> None:
    """Block until the query ends; an interrupt or SIGTERM drains it first."""

    def stop(signum, frame):
        raise KeyboardInterrupt

    before = signal.signal(signal.SIGTERM, stop)
    try:
        query.awaitTermination()
    except KeyboardInterrupt:
        drain(query)
    finally:
        signal.signal(signal.SIGTERM, before)
