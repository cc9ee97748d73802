"""Streams with state: independent of the cut into batches, and bounded where a watermark bounds it."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import types as T

from keytide.schemas import STREAM_RECORD, event_table
from keytide.session import namespace_dir
from keytide.sources.streams import as_records, read_stream
from keytide.sources.tables import create_table, scan, scan_records
from keytide.streaming.ingest import ingest
from keytide.streaming.state import ingest_latest, once_each, write_once

T0 = "2014-10-07T12:20:08Z"


@pytest.fixture
def spec(spark, namespace):
    made = event_table(namespace)
    create_table(spark, made)
    return made


def put(spark, folder, rows):
    """One file of ``(cmpkey, event, seq)``."""
    records = [("k:" + c, bytes(f"{T0};{event};{seq % 10}", "utf8"), seq) for c, event, seq in rows]
    spark.createDataFrame(records, STREAM_RECORD).coalesce(1).write.mode("append").parquet(folder)


def arrivals(spark, base, limit):
    return as_records(read_stream(spark, "parquet", f"{base}/in", start="earliest", limit=limit), "parquet")


@pytest.mark.parametrize("start", [ingest, ingest_latest])
def test_any_cut_gives_the_greatest_seq(spark, spec, namespace, start):
    """Seventy files in any order, three a batch, with a restart."""
    base = namespace_dir(spark, namespace)
    rng = random.Random(6)
    seqs = list(range(140))
    rng.shuffle(seqs)
    rows = [(str(rng.randrange(9)), f"e{s}", s) for s in seqs]
    for part in (rows[:80], rows[80:]):
        for i in range(0, len(part), 20):
            put(spark, f"{base}/in", part[i : i + 20])
        start(arrivals(spark, base, 1), spec, f"{base}/checkpoint", on_bad_shape="drop", on_bad_field="drop", available_now=True).awaitTermination()
    best = {}
    for c, event, s in rows:
        best[c] = max(best.get(c, (-1, "")), (s, event))
    got = {r["cmpkey"]: (r["num"], r["event"]) for r in scan_records(spark, spec).collect()}
    assert got == {c: (s % 10, event) for c, (s, event) in best.items()}
    assert scan(spark, spec.log).select("batch_id").distinct().count() == 7


def test_only_changed_keys_are_written(spark, spec, namespace):
    base = namespace_dir(spark, namespace)
    start = lambda: ingest_latest(arrivals(spark, base, 1), spec, f"{base}/checkpoint", available_now=True).awaitTermination()
    put(spark, f"{base}/in", [(str(i), "old", 100 + i) for i in range(10)])
    start()
    put(spark, f"{base}/in", [("3", "late", 5), ("4", "new", 500)])
    start()
    # The lesser write of key 3 shows its kept greatest again, not itself.
    written = scan(spark, spec.log).where("batch_id = 1").select("cmpkey", "event").collect()
    assert {tuple(r) for r in written} <= {("3", "old"), ("4", "new")}
    with pytest.raises(ValueError, match="quarantine"):
        ingest_latest(arrivals(spark, base, 1), spec, f"{base}/other", on_bad_field="quarantine")


def test_redelivered_records_and_bounded_state(spark, namespace):
    base = namespace_dir(spark, namespace)
    spark.sql(f"CREATE TABLE {namespace}.once (seq BIGINT, epoch BIGINT, batch_id BIGINT) USING parquet PARTITIONED BY (epoch, batch_id)")
    schema = T.StructType([T.StructField("seq", T.LongType()), T.StructField("arrived", T.TimestampType())])
    kept = []
    for part in range(12):
        # Each part comes together with the part before, a second time.
        low, high = max(part - 1, 0) * 100, (part + 1) * 100
        rows = spark.range(low, high).selectExpr("id as seq", "timestamp_seconds(1412684408 + id) as arrived")
        rows.coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = read_stream(spark, "parquet", f"{base}/in", start="earliest", schema=schema)
        query = write_once(once_each(stream, ["seq"], "arrived", "250 seconds").select("seq"), f"{namespace}.once", f"{base}/checkpoint")
        query.awaitTermination()
        kept.append(query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"])
    got = Counter(r["seq"] for r in scan(spark, f"{namespace}.once").collect())
    assert got == Counter(range(1200))
    assert max(kept) <= 700 and kept[-1] <= kept[5] + 100  # it stays with the delay, not with the stream
