"""One callable ``(spark, sf_dir) -> DataFrame`` per query, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from keytide.functions import wire
from keytide.operators.align import event_lines, pair_lines, to_records, to_rows
from keytide.operators.current import clustered, latest_per_key, newest_per_partition
from keytide.operators.ranges import compare_ranges
from keytide.operators.report import compare_copies, count_rows, first_rows
from keytide.operators.upsert import append_batch, compact, write_partition
from keytide.operators.wire import accept, encode_events, frame, parse_lines, set_aside
from keytide.plans import inputs
from keytide.schemas import EVENT_RECORD, STREAM_RECORD, TableSpec, event_table, pair_table
from keytide.session import namespace_dir, scratch_namespace
from keytide.sources.ordered import lookup, page_starts, write_ordered
from keytide.sources.shards import Log, read_shards, send, send_stream, stream_shards
from keytide.sources.store import export, scan_files
from keytide.sources.streams import as_records, read_stream
from keytide.sources.tables import (
    create_namespace,
    create_table,
    drop_namespace,
    scan,
    scan_keyed,
    scan_records,
    use_namespace,
)
from keytide.streaming.ingest import create_quarantine, ingest
from keytide.streaming.state import ingest_latest, once_each, write_once

EVENT_KEY = ["key", "cmpkey", "ts_ms"]
SEED_TIME_MS = 1412684408000
SLICES = 3
PAGE = 1000  # rows
LOOKED_UP = 37  # a customer
FILES = 64  # of a micro-batch
REMEMBERED = "1 hour"  # how long a record's position is kept


# Keyed tables


def kv_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = scan(spark, f"{sf_dir}/customer.parquet", fmt="parquet")
    return customer.selectExpr("c_custkey as key", "c_name as value")


def kv_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_rows(inputs.table(spark, sf_dir, "lineitem"))


def _order_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = inputs.table(spark, sf_dir, "orders")
    return orders.selectExpr("o_orderkey as key", "o_orderpriority as value")


def kv_take(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_rows(_order_pairs(spark, sf_dir), ["key"], 9)


def _fresh_pairs(spark: SparkSession, label: str):
    """A dropped, created and current namespace with an empty pair table."""
    before = spark.catalog.currentDatabase()
    namespace = scratch_namespace(spark, label)
    location = namespace_dir(spark, namespace)
    drop_namespace(spark, namespace)
    create_namespace(spark, namespace, location=location)
    create_namespace(spark, namespace, if_not_exists=True)
    spec = pair_table(namespace, key_type=T.LongType())
    try:
        use_namespace(spark, namespace)
        create_table(spark, spec)
        create_table(spark, spec, if_not_exists=True)
    finally:
        use_namespace(spark, before)
    return spec


def kv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = _fresh_pairs(spark, "kv_roundtrip")
    append_batch(_order_pairs(spark, sf_dir), spec, epoch=0, batch_id=0)
    return scan_keyed(spark, spec).select("key", "value")


def kv_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders, then a second batch that gives open orders their status."""
    spec = _fresh_pairs(spark, "kv_overwrite")
    orders = inputs.table(spark, sf_dir, "orders")
    changed = orders.where("o_orderstatus = 'O'").selectExpr("o_orderkey as key", "o_orderstatus as value")
    append_batch(_order_pairs(spark, sf_dir), spec, epoch=0, batch_id=0)
    append_batch(changed, spec, epoch=0, batch_id=1)
    return scan_keyed(spark, spec).select("key", "value")


def _ordered_copy(spark: SparkSession, rows: DataFrame, label: str, key: list[str]) -> DataFrame:
    return write_ordered(rows, f"{namespace_dir(spark, scratch_namespace(spark, label))}/ordered", key)


def kv_store_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders through a store's client."""
    pairs = _order_pairs(spark, sf_dir)
    path = f"{namespace_dir(spark, scratch_namespace(spark, 'kv_store_scan'))}/store"
    export(pairs, path, "key")
    return scan_files(spark, path, pairs.schema, "key")


def kv_store_get(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders of one customer through a store's client, which gets the key."""
    orders = inputs.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderpriority")
    path = f"{namespace_dir(spark, scratch_namespace(spark, 'kv_store_get'))}/store"
    export(orders, path, "o_custkey")
    return scan_files(spark, path, orders.schema, "o_custkey", [LOOKED_UP])


def kv_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders of one customer, from a copy in order of customers."""
    orders = inputs.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderpriority")
    return lookup(_ordered_copy(spark, orders, "kv_lookup", ["o_custkey", "o_orderkey"]), o_custkey=LOOKED_UP)


def kv_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages in which all orders can be read in key order: first and last key, number of rows."""
    return page_starts(_ordered_copy(spark, _order_pairs(spark, sf_dir), "kv_pages", ["key"]), ["key"], PAGE)


# Events


def event_key_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events of one partition key, from a copy in clustering order."""
    records = inputs.event_records(spark, sf_dir).select("key", "cmpkey", "ts_ms", "event_id", "num")
    return lookup(_ordered_copy(spark, records, "event_key_lookup", ["key", "cmpkey", "ts_ms", "event_id"]), key="purchase", cmpkey="3")


def event_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four start-up events per customer, one millisecond apart."""
    customer = inputs.table(spark, sf_dir, "customer")
    return customer.selectExpr("c_custkey", "explode(sequence(0, 3)) as i").selectExpr(
        "'bootstrap' as key",
        "cast(c_custkey as string) as cmpkey",
        f"{SEED_TIME_MS}L + i as ts_ms",
        "'test' as event",
        "i + 1 as num",
    )


def event_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = inputs.event_records(spark, sf_dir)
    sent = encode_events(records, keep=["event_id"])
    return sent.selectExpr(
        "event_id",
        "key as partition_key",
        f"{wire.utf8_text('value')} as data",
        "octet_length(value) as n_bytes",
    )


def event_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.damaged_lines(inputs.event_records(spark, sf_dir))


def _parsed(spark: SparkSession, sf_dir: str, unit_ms: int = wire.SECOND_MS) -> DataFrame:
    lines = inputs.damaged_lines(inputs.event_records(spark, sf_dir, unit_ms))
    return parse_lines(lines, keep=["event_id"])


def event_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, sf_dir).drop("line")


def event_parse_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = inputs.variant_lines(inputs.event_records(spark, sf_dir))
    return parse_lines(lines, keep=["event_id"]).drop("line")


def event_parse_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accept(_parsed(spark, sf_dir), "default", "drop", keep=["event_id"])


def event_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return set_aside(_parsed(spark, sf_dir), "quarantine", "quarantine", keep=["event_id"])


def _current(spark: SparkSession, sf_dir: str, unit_ms: int) -> DataFrame:
    events = accept(_parsed(spark, sf_dir, unit_ms), "default", "drop", keep=["event_id"])
    return latest_per_key(events, EVENT_KEY, ["event_id"]).select(*EVENT_RECORD.names)


def event_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events to lines, lines to events, last write per key; times to the second."""
    return _current(spark, sf_dir, wire.SECOND_MS)


def event_upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with times cut to the day, so that keys recur."""
    return _current(spark, sf_dir, wire.DAY_MS)


def event_clustered_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = event_table("default")
    rows = to_rows(_current(spark, sf_dir, wire.DAY_MS), spec)
    newest = newest_per_partition(rows, spec, 3)
    return newest.selectExpr("key", "cmpkey", "unix_millis(ts) as ts_ms", "event", "num", "pos")


def event_clustered_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = event_table("default")
    rows = to_rows(_current(spark, sf_dir, wire.SECOND_MS), spec)
    return to_records(clustered(rows, spec), spec)


def event_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with other column order and case, to rows and back."""
    spec = event_table("default")
    records = inputs.event_records(spark, sf_dir)
    other = records.selectExpr("num", "event", "ts_ms as TS_MS", "cmpkey as CmpKey", "event_id", "key")
    return to_records(to_rows(other, spec), spec)


def record_text_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_lines(inputs.event_records(spark, sf_dir), keep=["event_id"])


def record_text_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_lines(_order_pairs(spark, sf_dir), keep=["key"])


# Tables of events, by batches and by streams


def _fresh_events(spark: SparkSession, label: str):
    spec = event_table(scratch_namespace(spark, label))
    create_table(spark, spec)
    return spec


def _slices(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    events = inputs.table(spark, sf_dir, "events")
    return [events.where(part) for part in inputs.id_slices(events, "event_id", SLICES)]


def _write_slice(events: DataFrame, spec: TableSpec, epoch: int | None, batch_id: int, replay: bool = False) -> None:
    lines = inputs.damaged_lines(inputs.to_event_records(events, wire.DAY_MS))
    batch = accept(parse_lines(lines, keep=["event_id"]), "default", "drop", keep=["event_id"])
    append_batch(batch.withColumnRenamed("event_id", "seq"), spec, epoch, batch_id, replay)


def _arrive(events: DataFrame, base: str) -> None:
    arriving = inputs.damaged_records(inputs.to_event_records(events, wire.DAY_MS))
    arriving.write.mode("append").parquet(f"{base}/arrivals")


def _ingest_arrivals(spark: SparkSession, spec: TableSpec, base: str, checkpoint: str) -> None:
    stream = as_records(read_stream(spark, "parquet", f"{base}/arrivals", start="earliest", limit=FILES), "parquet")
    ingest(
        stream,
        spec,
        checkpoint=f"{base}/{checkpoint}",
        on_bad_shape="default",
        on_bad_field="drop",
        available_now=True,
    ).awaitTermination()


def event_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches 0 and 1, compaction, batch 2: snapshot and later writes together."""
    spec = _fresh_events(spark, "event_compact")
    slices = _slices(spark, sf_dir)
    for batch_id, events in enumerate(slices):
        if batch_id == len(slices) - 1:
            compact(spark, spec)
        _write_slice(events, spec, epoch=0, batch_id=batch_id)
    return scan_records(spark, spec)


def event_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each batch is delivered twice, the first one a third time when it is compacted already."""
    spec = _fresh_events(spark, "event_replay")
    slices = _slices(spark, sf_dir)
    for batch_id, events in enumerate(slices):
        for replay in (False, True):
            _write_slice(events, spec, 0, batch_id, replay)
        if batch_id == 0:
            compact(spark, spec)
    if slices:
        _write_slice(slices[0], spec, 0, 0, True)
    return scan_records(spark, spec)


def event_batch_then_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first part is written as a batch, the rest arrives by stream: both writers own an epoch."""
    spec = _fresh_events(spark, "event_batch_then_stream")
    base = namespace_dir(spark, spec.namespace)
    for part, events in enumerate(_slices(spark, sf_dir)):
        if part == 0:
            _write_slice(events, spec, None, 0)
        else:
            _arrive(events, base)
            _ingest_arrivals(spark, spec, base, "checkpoint")
    return scan_records(spark, spec)


def event_stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After compaction a new checkpoint reads the same records and new ones."""
    spec = _fresh_events(spark, "event_stream_restart")
    base = namespace_dir(spark, spec.namespace)
    for part, events in enumerate(_slices(spark, sf_dir)):
        _arrive(events, base)
        if part > 0:
            _ingest_arrivals(spark, spec, base, f"checkpoint_{part}")
            compact(spark, spec)
    return scan_records(spark, spec)


def event_stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records arrive in three parts; the stream stops and resumes after each."""
    spec = _fresh_events(spark, "event_stream_upsert")
    base = namespace_dir(spark, spec.namespace)
    for events in _slices(spark, sf_dir):
        _arrive(events, base)
        _ingest_arrivals(spark, spec, base, "checkpoint")
    return scan_records(spark, spec)


def event_stream_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records arrive in falling order, one file a micro-batch; the state keeps the greatest write of each key."""
    spec = _fresh_events(spark, "event_stream_state")
    base = namespace_dir(spark, spec.namespace)
    for events in reversed(_slices(spark, sf_dir)):
        _arrive(events, base)
        stream = as_records(read_stream(spark, "parquet", f"{base}/arrivals", start="earliest", limit=1), "parquet")
        ingest_latest(stream, spec, f"{base}/checkpoint", on_bad_shape="default", available_now=True).awaitTermination()
    return scan_records(spark, spec)


def event_stream_redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record is delivered twice, the second time with the next part."""
    namespace = scratch_namespace(spark, "event_stream_redelivered")
    base, table = namespace_dir(spark, namespace), f"{namespace}.delivered"
    spark.sql(f"CREATE TABLE {table} (seq BIGINT, line STRING, epoch BIGINT, batch_id BIGINT) USING parquet PARTITIONED BY (epoch, batch_id)")
    schema = T.StructType([*STREAM_RECORD, T.StructField("arrived", T.TimestampType())])
    before = None
    for events in [*_slices(spark, sf_dir), None]:
        for part in (before, events):
            if part is not None:
                records = inputs.damaged_records(inputs.to_event_records(part, wire.SECOND_MS))
                records.selectExpr("*", f"timestamp_millis({SEED_TIME_MS}L + 1000 * seq) as arrived").write.mode("append").parquet(f"{base}/arrivals")
        if before is None and events is None:
            break
        before = events
        stream = read_stream(spark, "parquet", f"{base}/arrivals", start="earliest", schema=schema)
        delivered = frame(once_each(stream, ["seq"], "arrived", REMEMBERED), keep=["seq"])
        write_once(delivered, table, f"{base}/checkpoint").awaitTermination()
    return scan(spark, table, ["seq", "line"])


def _shard_log(spark: SparkSession, label: str) -> tuple[str, str]:
    """A folder of its own, and a sharded stream in it."""
    base = namespace_dir(spark, scratch_namespace(spark, label))
    return base, f"{base}/shards"


def _send(events: DataFrame, log: str) -> None:
    send(inputs.damaged_records(inputs.to_event_records(events, wire.SECOND_MS)), log)


def _consume(spark: SparkSession, base: str, log: str, start: str, limit: int | None = None) -> bool:
    """Append to ``base/lines`` what one start reads; whether there was anything."""
    records = stream_shards(spark, log, start, limit, f"{base}/positions")
    lines = frame(records, keep=["shard", "position"])
    writer = lines.writeStream.format("parquet").option("checkpointLocation", f"{base}/checkpoint")
    query = writer.trigger(availableNow=True).start(f"{base}/lines")
    query.awaitTermination()
    return query.lastProgress is not None and query.lastProgress["numInputRows"] > 0


def _consumed(spark: SparkSession, base: str) -> DataFrame:
    lines = spark.read.schema("shard int, position long, line string").parquet(f"{base}/lines")
    return lines.select("shard", "line")


def event_source_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sharded stream read to its end, with a limit per shard and a restart after each batch."""
    base, log = _shard_log(spark, "event_source_shards")
    for part, events in enumerate(_slices(spark, sf_dir)):
        _send(events, log)
        if part > 0:
            # Half of what is there, so that any stream takes a few starts.
            limit = max(Log(log).ends().values(), default=0) // 2 + 1
            while _consume(spark, base, log, "earliest", limit):
                pass
    return _consumed(spark, base)


def event_source_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A consumer that starts at the latest position after the first part: it gets the others."""
    base, log = _shard_log(spark, "event_source_latest")
    for events in _slices(spark, sf_dir):
        _send(events, log)
        _consume(spark, base, log, "latest")
    return _consumed(spark, base)


def event_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records sent by a stream whose last record fails at first; how often each is there after the restart."""
    base, log = _shard_log(spark, "event_sink")
    events = inputs.table(spark, sf_dir, "events")
    last = events.selectExpr("max(event_id)").first()[0]
    stream = read_stream(spark, "parquet", f"{sf_dir}/events.parque[t]", start="earliest", schema=events.schema)
    records = encode_events(inputs.to_event_records(stream), keep=["event_id"])
    broken = records.where(f"if(event_id = {last}, cast(raise_error('not yet') as boolean), true)")
    for sent in (broken, records) if last is not None else ():
        try:
            send_stream(sent.drop("event_id"), log, f"{base}/checkpoint").awaitTermination()
        except StreamingQueryException as error:
            if "not yet" not in str(error):
                raise
    found = read_shards(spark, log)
    return found.groupBy("shard", "key", "value").count().selectExpr(
        "shard", "key as partition_key", f"{wire.utf8_text('value')} as data", "count as n"
    )


def event_stream_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is set aside of records that arrive in several files, one file a micro-batch, in one start."""
    spec = _fresh_events(spark, "event_stream_limited")
    base = namespace_dir(spark, spec.namespace)
    create_quarantine(spark, spec)
    slices = _slices(spark, sf_dir)
    for events in slices:
        _arrive(events, base)
    if slices:
        stream = as_records(read_stream(spark, "parquet", f"{base}/arrivals", start="earliest", limit=1), "parquet")
        ingest(stream, spec, f"{base}/checkpoint", available_now=True).awaitTermination()
    return scan(spark, spec.quarantine, ["seq", "status", "line"])


def _arriving(spark: SparkSession, sf_dir: str, limit: int | None = FILES) -> DataFrame:
    """The events table itself as a stream of records."""
    schema = inputs.table(spark, sf_dir, "events").schema
    # As a pattern, the path may be one file or a folder of files.
    path = f"{sf_dir}/events.parque[t]"
    events = read_stream(spark, "parquet", path, start="earliest", limit=limit, schema=schema)
    return inputs.damaged_records(inputs.to_event_records(events, wire.SECOND_MS))


def event_stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the default policy of a stream sets aside."""
    spec = _fresh_events(spark, "event_stream_quarantine")
    checkpoint = f"{namespace_dir(spark, spec.namespace)}/checkpoint"
    ingest(_arriving(spark, sf_dir), spec, checkpoint, available_now=True).awaitTermination()
    return scan(spark, spec.quarantine, ["seq", "status", "line"])


def stream_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First rows of each batch, kept in a table instead of printed; the table arrives as one batch."""
    spec = _fresh_events(spark, "stream_preview")
    shown = f"{spec.namespace}.preview"
    spark.sql(
        f"CREATE TABLE {shown} (seq BIGINT, key STRING, cmpkey STRING, ts_ms BIGINT, event STRING, "
        "num INT, epoch BIGINT, batch_id BIGINT) USING parquet PARTITIONED BY (epoch, batch_id)"
    )
    ingest(
        _arriving(spark, sf_dir, limit=None),
        spec,
        checkpoint=f"{namespace_dir(spark, spec.namespace)}/checkpoint",
        on_bad_shape="default",
        on_bad_field="drop",
        preview=lambda rows, batch_id: write_partition(rows, shown, 0, batch_id),
        available_now=True,
    ).awaitTermination()
    return scan(spark, shown, ["batch_id", "seq", *EVENT_RECORD.names])


# Checks


def _customer_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = inputs.table(spark, sf_dir, "customer")
    return customer.selectExpr("c_custkey as key", "c_name as value", "c_acctbal", "c_mktsegment")


def _customer_copies(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The customers, and a copy that lost one segment and changed those in debt."""
    expected = _customer_pairs(spark, sf_dir)
    actual = expected.where("c_mktsegment <> 'MACHINERY'").selectExpr(
        "key", "if(c_acctbal < 0, upper(value), value) as value"
    )
    return expected.select("key", "value"), actual


def canary_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_copies(*_customer_copies(spark, sf_dir))


def canary_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same comparison by key ranges; as the copies differ everywhere, one reading settles no range."""
    return compare_ranges(*_customer_copies(spark, sf_dir), key="key")


def canary_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose copy differs in one stretch of a hundred keys, found by key ranges."""
    expected = _order_pairs(spark, sf_dir)
    actual = expected.selectExpr("key", "if(key between 500 and 599, lower(value), value) as value")
    return compare_ranges(expected, actual, key="key")


def canary_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all orders to a new keyed table and check what it returns."""
    expected = _order_pairs(spark, sf_dir)
    return compare_copies(expected, kv_roundtrip(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        kv_select,
        kv_count,
        kv_take,
        kv_roundtrip,
        kv_overwrite,
        kv_store_scan,
        kv_store_get,
        kv_lookup,
        kv_pages,
        event_key_lookup,
        event_seed,
        event_encode,
        event_frame,
        event_parse,
        event_parse_variants,
        event_parse_default,
        event_quarantine,
        event_ingest,
        event_upsert_latest,
        event_clustered_slice,
        event_clustered_scan,
        event_align,
        record_text_event,
        record_text_pair,
        event_compact,
        event_replay,
        event_batch_then_stream,
        event_stream_restart,
        event_stream_upsert,
        event_stream_limited,
        event_stream_state,
        event_stream_redelivered,
        event_source_shards,
        event_source_latest,
        event_sink,
        event_stream_quarantine,
        stream_preview,
        canary_report,
        canary_ranges,
        canary_orders,
        canary_roundtrip,
    )
}
