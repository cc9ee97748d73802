"""Streaming ingest: batches, restarts, replays, quarantine."""

from __future__ import annotations

import os
from collections import Counter

import pytest

from keytide.operators.upsert import drop_compacted, snapshot_state
from keytide.operators.wire import encode_events
from keytide.plans import inputs
from keytide.schemas import event_table
from keytide.session import namespace_dir
from keytide.sources.streams import as_lines, as_records, read_stream
from keytide.sources.tables import create_table, scan, scan_records
from keytide.streaming.ingest import BATCH_INTERVAL, drain, ingest, print_preview, run_until_stopped

T0 = 1412684408000


@pytest.fixture
def spec(spark, namespace):
    made = event_table(namespace)
    create_table(spark, made)
    return made


def rows_of(df) -> Counter:
    return Counter(map(tuple, df.collect()))


def put_lines(folder: str, name: str, lines: list[str]) -> None:
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/.{name}", "w", encoding="utf-8") as out:
        out.write("\n".join(lines) + "\n")
    os.rename(f"{folder}/.{name}", f"{folder}/{name}")


@pytest.fixture
def lines(spark, namespace):
    """A text source, and a function that starts a query on it."""
    base = namespace_dir(spark, namespace).removeprefix("file:")
    folder = f"{base}/lines"

    def start(spec, name="q", **options):
        stream = as_lines(read_stream(spark, "text", folder, start="earliest", limit=1))
        return ingest(stream, spec, f"{base}/checkpoint-{name}", available_now=True, **options)

    return folder, start


def test_batches_restart_and_new_epoch(spark, spec, lines):
    folder, start = lines
    put_lines(folder, "1.txt", ["a:1|2014-10-07T12:20:08Z;foo;1", "b:1|2014-10-07T12:20:08Z;foo;2"])
    start(spec).awaitTermination()
    put_lines(folder, "2.txt", ["a:1|2014-10-07T12:20:08Z;bar;3"])
    query = start(spec)
    query.awaitTermination()
    expected = Counter([("a", "1", T0, "bar", 3), ("b", "1", T0, "foo", 2)])
    assert rows_of(scan_records(spark, spec)) == expected
    start(spec).awaitTermination()
    assert rows_of(scan(spark, spec.log).selectExpr("batch_id")) == Counter([(0,), (0,), (1,)])
    # A query with a new checkpoint reads all files again, under the next epoch.
    start(spec, name="again", epoch=1).awaitTermination()
    assert scan(spark, spec.log).count() == 6
    assert rows_of(scan_records(spark, spec)) == expected


def test_replayed_batch_changes_nothing(spark, spec, lines, monkeypatch):
    """The query dies after the write, before Spark notes the batch as done."""
    from keytide.streaming import ingest as module

    folder, start = lines
    put_lines(folder, "1.txt", ["a:1|2014-10-07T12:20:08Z;foo;1", "bad"])
    real = module.append_batch

    def write_then_die(*args):
        real(*args)
        raise RuntimeError("executor lost")

    monkeypatch.setattr(module, "append_batch", write_then_die)
    with pytest.raises(Exception, match="executor lost"):
        start(spec).awaitTermination()
    assert scan(spark, spec.log).count() == 1
    monkeypatch.setattr(module, "append_batch", real)
    start(spec).awaitTermination()
    assert scan(spark, spec.log).count() == 1
    assert rows_of(scan(spark, spec.quarantine, ["status", "line"])) == Counter([("bad_shape", "bad")])
    assert rows_of(scan_records(spark, spec)) == Counter([("a", "1", T0, "foo", 1)])


def test_compaction_in_the_stream(spark, spec, lines):
    folder, start = lines
    for i in range(5):
        put_lines(folder, f"{i}.txt", [f"a:{i % 3}|2014-10-07T12:20:08Z;foo;{i}"])
    start(spec, compact_every=2).awaitTermination()
    assert snapshot_state(spark, spec)["mark"] == (0, 3)
    expected = Counter([("a", "0", T0, "foo", 3), ("a", "1", T0, "foo", 4), ("a", "2", T0, "foo", 2)])
    assert rows_of(scan_records(spark, spec)) == expected
    drop_compacted(spark, spec)
    assert scan(spark, spec.log).count() == 1
    assert rows_of(scan_records(spark, spec)) == expected


def test_default_and_fail_policies(spark, spec, lines):
    """Shapeless lines collapse into one default row; a bad field stops the query."""
    folder, start = lines
    put_lines(folder, "1.txt", ["bad", "a|b|c", "a:1|2014-10-07T12:20:08Z;foo;1"])
    start(spec, on_bad_shape="default", on_bad_field="fail").awaitTermination()
    assert rows_of(scan_records(spark, spec)) == Counter([("", "", 0, "0", 0), ("a", "1", T0, "foo", 1)])
    put_lines(folder, "2.txt", ["a:1|2014-10-07T12:20:08Z;foo;one"])
    with pytest.raises(Exception, match="bad_field: a:1"):
        start(spec, on_bad_shape="default", on_bad_field="fail").awaitTermination()


def test_stream_equals_batch_in_any_split(spark, spec, sf_dir, namespace):
    """Records of whole events, four parts in arrival order, replayed once over."""
    base = namespace_dir(spark, namespace)
    events = inputs.table(spark, sf_dir, "events")
    for part in inputs.id_slices(events, "event_id", 4):
        records = inputs.to_event_records(events.where(part), 86_400_000)
        sent = encode_events(records, keep=["event_id"]).withColumnRenamed("event_id", "seq")
        sent.repartition(3).write.mode("append").parquet(f"{base}/arrivals")
        stream = as_records(read_stream(spark, "parquet", f"{base}/arrivals", start="earliest"), "parquet")
        ingest(stream, spec, f"{base}/checkpoint", available_now=True).awaitTermination()
    assert scan(spark, spec.log).select("batch_id").distinct().count() == 4
    last: dict[tuple, tuple] = {}
    for row in inputs.event_records(spark, sf_dir, 86_400_000).orderBy("event_id").collect():
        last[(row["key"], row["cmpkey"], row["ts_ms"])] = (row["event"], row["num"])
    assert rows_of(scan_records(spark, spec)) == Counter((*k, *v) for k, v in last.items())


def test_drain_preview_and_interval(spark, spec, namespace, lines, capsys):
    folder, _ = lines
    put_lines(folder, "1.txt", [f"a:{i}|2014-10-07T12:20:08Z;foo;{i}" for i in range(30)])
    stream = as_lines(read_stream(spark, "text", folder, start="earliest"))
    seen = []

    def preview(rows, batch_id):
        seen.append((batch_id, rows.count()))
        print_preview(rows, batch_id)

    base = namespace_dir(spark, namespace)
    query = ingest(stream, spec, f"{base}/checkpoint-d", preview=preview, interval="100 milliseconds")
    drain(query)
    assert not query.isActive
    run_until_stopped(query)
    assert seen == [(0, 10)]
    assert "batch 0" in capsys.readouterr().out
    assert scan_records(spark, spec).count() == 30
    assert BATCH_INTERVAL == "10 seconds"


def test_source_options(spark, namespace):
    with pytest.raises(ValueError, match="starts at 'earliest'"):
        read_stream(spark, "parquet", "/nowhere")
    with pytest.raises(ValueError, match="'latest' or 'earliest'"):
        read_stream(spark, "parquet", "/nowhere", start="now")
    with pytest.raises(ValueError, match="start position"):
        read_stream(spark, "some.connector", start="latest")
    with pytest.raises(ValueError, match="limits a micro-batch"):
        read_stream(spark, "some.connector", start="latest", start_option="from", limit=10)
    rate = read_stream(
        spark, "rate-micro-batch", start="latest", start_option="startTimestampIgnored", rowsPerBatch="5"
    )
    records = as_records(rate, "rate", {"key": "'k:1'", "value": "'x'", "seq": "value"})
    assert [f.dataType.simpleString() for f in records.schema] == ["string", "binary", "bigint"]
    assert as_records(rate, "rate", {"key": "'k'", "value": "'x'"}).columns == ["key", "value", "seq"]
