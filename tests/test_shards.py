"""Sharded streams: places, restarts, limits, failed writes, row groups."""

from __future__ import annotations

import json
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from keytide.session import namespace_dir
from keytide.sources import shards
from keytide.sources.shards import Log, read_shards, send, send_stream, shard_of, stream_shards


@pytest.fixture
def base(spark, namespace):
    return namespace_dir(spark, namespace).removeprefix("file:")


def records(spark, low, high):
    rows = [(f"k{i % 7}" if i % 11 else None, bytes(str(i), "utf8")) for i in range(low, high)]
    return spark.createDataFrame(rows, "key string, value binary")


def values(rows) -> Counter:
    return Counter(int(r["value"]) for r in rows.collect())


def places(rows) -> list:
    return sorted((r["shard"], r["position"]) for r in rows.collect())


def consume(spark, base, name="q", **options) -> list[int]:
    stream = stream_shards(spark, f"{base}/log", positions=f"{base}/positions-{name}", **options)
    query = stream.writeStream.format("parquet").option("checkpointLocation", f"{base}/checkpoint-{name}")
    query = query.trigger(availableNow=True).start(f"{base}/out-{name}")
    query.awaitTermination()
    return [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]


def test_shards_are_ranges_of_the_keys_hash(spark):
    rows = spark.range(2000).select(F.col("id").cast("string").alias("k")).select("k", shard_of(F.col("k"), 5).alias("s"))
    import hashlib

    for r in rows.collect():
        assert r["s"] == (int(hashlib.md5(r["k"].encode()).hexdigest()[:8], 16) * 5) >> 32
    assert spark.createDataFrame([(None,)], "k string").select(shard_of(F.col("k"), 5)).first()[0] == 0


def test_batches_add_up_without_gaps(spark, base):
    assert read_shards(spark, f"{base}/log").count() == 0
    for low in (0, 300, 600):
        send(records(spark, low, low + 300).repartition(3), f"{base}/log", shards=4)
    got = read_shards(spark, f"{base}/log")
    assert values(got) == Counter(range(900))
    ends = Log(f"{base}/log").ends()
    assert places(got) == sorted((int(s), i) for s, end in ends.items() for i in range(end))
    with pytest.raises(Exception, match="only added"):
        shards.for_shards(records(spark, 0, 1)).write.format(shards.FORMAT).mode("overwrite").save(f"{base}/log")


def test_restarts_and_limit_take_each_record_once(spark, base):
    send(records(spark, 0, 500).repartition(2), f"{base}/log")
    taken = consume(spark, base, start="earliest", limit=20)
    assert len(taken) == 1 and taken[0] <= 20 * shards.SHARDS
    send(records(spark, 500, 700), f"{base}/log")
    while more := consume(spark, base, start="earliest", limit=20):
        assert more[0] <= 20 * shards.SHARDS
        taken += more
    assert sum(taken) == 700 and len(taken) == 5
    got = spark.read.parquet(f"{base}/out-q")
    assert values(got) == Counter(range(700)) and len(set(places(got))) == 700
    # Another consumer has positions of its own.
    assert sum(consume(spark, base, "other", start="earliest")) == 700


def test_latest_starts_after_what_is_there(spark, base):
    send(records(spark, 0, 100), f"{base}/log")
    assert consume(spark, base, start="latest") == []
    send(records(spark, 100, 150), f"{base}/log")
    assert consume(spark, base, start="latest") == [50]
    # What was planned counts, not the option.
    assert consume(spark, base, start="earliest") == []
    assert values(spark.read.parquet(f"{base}/out-q")) == Counter(range(100, 150))
    with pytest.raises(Exception, match="'latest' or 'earliest'"):
        consume(spark, base, "bad", start="now")
    with pytest.raises(Exception, match="positions"):
        stream_shards(spark, f"{base}/log", limit=5).writeStream.format("noop").option("checkpointLocation", f"{base}/c").trigger(availableNow=True).start().awaitTermination()


def test_a_batch_that_runs_again_is_not_added_again(spark, base):
    log = Log(f"{base}/log")
    assert log.commit(0, [("a", [(0, 3), (2, 1)])]) and log.commit(1, [("b", [(2, 4)]), ("c", [])])
    assert not log.commit(1, [("other", [(2, 4)])])
    with pytest.raises(ValueError, match="comes after"):
        log.commit(-1, [])
    assert log.ends() == {"0": 3, "2": 5}
    assert [vars(s) for s in log.segments({"0": 3, "2": 2}, {"0": 3, "2": 4})] == [
        {"shard": 2, "first": 2, "file": "b", "row": 1, "count": 2}
    ]


def test_only_needed_manifests_are_read(base, monkeypatch):
    log = Log(f"{base}/log")
    for number in range(20):
        log.commit(number, [(f"f{number}", [(0, 10)])])
    read = []
    monkeypatch.setattr(Log, "manifest", lambda self, n, real=Log.manifest: read.append(n) or real(self, n))
    found = list(log.segments({"0": 175}, {"0": 200}))
    assert [(s.first, s.count) for s in found] == [(190, 10), (180, 10), (175, 5)] and read == [19, 18, 17]


def test_failed_write_leaves_nothing(spark, base):
    """One task fails after others wrote: no file and no record stays, and the restart sends all once."""
    source = f"{base}/source"
    records(spark, 0, 200).repartition(4).write.parquet(source)
    schema = spark.read.parquet(source).schema

    def start(condition):
        stream = spark.readStream.schema(schema).parquet(source).where(condition)
        return send_stream(stream, f"{base}/log", f"{base}/checkpoint")

    with pytest.raises(Exception, match="not yet"):
        start("if(cast(value as string) = '199', cast(raise_error('not yet') as boolean), true)").awaitTermination()
    assert read_shards(spark, f"{base}/log").count() == 0
    for _ in range(2):
        start("true").awaitTermination()
    assert values(read_shards(spark, f"{base}/log")) == Counter(range(200))
    # Files of attempts that were cut off may stay, but no manifest names them.
    named = {s[2] for f in os.listdir(f"{base}/log/batches") if f.endswith(".json") for s in json.load(open(f"{base}/log/batches/{f}"))["segments"]}
    assert named <= {f.removesuffix(".parquet") for f in os.listdir(f"{base}/log/data")}


def test_tasks_cut_long_segments(spark, base):
    send(records(spark, 0, 1000).coalesce(1), f"{base}/log", shards=1)
    cut = spark.read.format(shards.FORMAT).option("partitionRows", 64).load(f"{base}/log")
    assert cut.rdd.getNumPartitions() == 16
    assert values(cut) == Counter(range(1000)) and len(set(places(cut))) == 1000
