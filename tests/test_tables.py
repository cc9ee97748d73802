"""Keyed tables: definition, last write wins, compaction."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter

import pytest
from conftest import PAIRS, READINGS
from pyspark.sql import functions as F

from keytide.operators.current import clustered, latest_per_key, newest_per_partition
from keytide.operators.upsert import (
    append_batch,
    buckets_for,
    claim_epoch,
    compact,
    drop_compacted,
    last_batch,
    next_batch,
    table_bytes,
)
from keytide.schemas import EVENT_RECORD, PAIR_RECORD, event_table, pair_table, reading_table
from keytide.session import namespace_dir
from keytide.sources.tables import (
    create_namespace,
    create_table,
    drop_namespace,
    literal_rows,
    scan,
    scan_keyed,
    scan_records,
    use_namespace,
)


def rows_of(df) -> Counter:
    return Counter(map(tuple, df.collect()))


def test_namespace_and_table_definition(spark, namespace):
    spec = pair_table(namespace)
    create_table(spark, spec)
    create_table(spark, spec, if_not_exists=True)
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        create_table(spark, spec)
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        create_namespace(spark, namespace)
    create_namespace(spark, namespace, if_not_exists=True)
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {spec.log}").collect()}
    assert properties["partition_key"] == "key"
    before = spark.catalog.currentDatabase()
    use_namespace(spark, namespace)
    assert spark.table("kv").columns == ["key", "value"]
    use_namespace(spark, before)
    drop_namespace(spark, namespace)
    drop_namespace(spark, namespace)
    assert not spark.catalog.databaseExists(namespace)


def test_pairs_round_trip(spark, namespace):
    spec = pair_table(namespace, "simple_pair")
    create_table(spark, spec)
    append_batch(literal_rows(spark, PAIRS, PAIR_RECORD), spec, epoch=0, batch_id=0)
    assert rows_of(scan(spark, spec.name, ["key", "value"])) == Counter(PAIRS)


def test_readings_newest_first(spark, namespace, zone):
    spec = reading_table(namespace)
    create_table(spark, spec)
    # Keys 500 to 520 have one reading each, key 650 has all of them.
    readings = [(key, dt.datetime.fromisoformat(f"{time}Z"), value) for i, (time, value) in enumerate(READINGS) for key in (500 + i, 650)]
    append_batch(literal_rows(spark, readings, spec.schema), spec, epoch=0, batch_id=0)
    current = scan_keyed(spark, spec)
    assert current.count() == 42
    newest = newest_per_partition(current, spec, 2).where("key = 650").orderBy("pos").collect()
    assert [r["value"] for r in newest] == ["89.7 F", "89.7 F"]
    assert newest[0]["ts"] > newest[1]["ts"]
    ordered = [tuple(r) for r in clustered(current, spec).selectExpr("key", "unix_millis(ts)").collect()]
    assert ordered == sorted(ordered, key=lambda r: (r[0], -r[1]))


def test_typed_write_and_read(spark, namespace, zone):
    spec = event_table(namespace)
    create_table(spark, spec, if_not_exists=True)
    seed = [("bootstrap", "600", 1412684408000 + i, "test", i + 1) for i in range(4)]
    append_batch(literal_rows(spark, seed, EVENT_RECORD), spec, epoch=0, batch_id=0)
    assert rows_of(scan_records(spark, spec)) == Counter(seed)


def test_key_must_not_be_null(spark, namespace):
    spec = pair_table(namespace)
    create_table(spark, spec)
    with pytest.raises(Exception, match="NULL in the primary key"):
        append_batch(literal_rows(spark, [(1, "a"), (None, "b")], PAIR_RECORD), spec, 0, 0)
    assert scan_keyed(spark, spec).count() == 0


def test_other_formats_and_connectors(spark, namespace):
    path = f"{namespace_dir(spark, namespace)}/pairs"
    literal_rows(spark, PAIRS, PAIR_RECORD).write.json(path)
    found = scan(spark, path, ["key", "value"], fmt="json", primitivesAsString="false")
    assert rows_of(found) == Counter(PAIRS)
    spec = pair_table(namespace, "kv_orc")
    create_table(spark, spec, fmt="orc")
    append_batch(literal_rows(spark, PAIRS, PAIR_RECORD), spec, 0, 0)
    assert rows_of(scan_keyed(spark, spec)) == Counter(PAIRS)


@pytest.mark.parametrize("seed", range(3))
def test_last_write_wins_like_a_dict(spark, namespace, seed):
    """Random batches, replays, compactions and clean-ups against a Python dict."""
    rng = random.Random(seed)
    spec = event_table(namespace)
    create_table(spark, spec)
    model: dict[tuple, tuple] = {}
    seq = 0
    batches: list[list[tuple]] = []
    for batch_id in range(4):
        batch = []
        for _ in range(rng.randrange(30)):
            hot = rng.random() < 0.4
            key = ("", "", 0) if hot else (rng.choice("ab"), rng.choice("12"), rng.randrange(3) * 1000)
            batch.append((*key, rng.choice(["x", "y"]), rng.randrange(5), seq))
            seq += 1
        batches.append(batch)
        model.update({row[:3]: row[3:5] for row in batch})
        shuffled = rng.sample(batch, len(batch))
        schema = "key string, cmpkey string, ts_ms bigint, event string, num int, seq bigint"
        for _ in range(rng.choice([1, 2])):
            append_batch(spark.createDataFrame(shuffled, schema), spec, 0, batch_id)
        if rng.random() < 0.5:
            compact(spark, spec, buckets=4)
        if rng.random() < 0.5:
            drop_compacted(spark, spec)
        expected = Counter((*k, *v) for k, v in model.items())
        assert rows_of(scan_records(spark, spec)) == expected


def test_epochs_and_batch_numbers(spark, namespace):
    spec = pair_table(namespace)
    create_table(spark, spec)
    assert last_batch(spark, spec) is None and next_batch(spark, spec) == 0
    assert compact(spark, spec) is None
    put = lambda value, epoch, batch: append_batch(literal_rows(spark, [(1, value)], PAIR_RECORD), spec, epoch, batch)
    put("a", 0, 7)
    put("b", 1, 0)
    assert rows_of(scan_keyed(spark, spec)) == Counter([(1, "b")])
    assert last_batch(spark, spec) == (1, 0)
    assert compact(spark, spec) is not None
    assert compact(spark, spec) is None
    drop_compacted(spark, spec)
    assert last_batch(spark, spec) is None
    assert next_batch(spark, spec, epoch=1) == 1
    put("c", 1, 1)
    assert rows_of(scan_keyed(spark, spec)) == Counter([(1, "c")])
    names = [t.name for t in spark.catalog.listTables(namespace)]
    assert len([n for n in names if "_snapshot_" in n]) == 1


def test_writes_below_the_mark_raise_and_claims_rise(spark, namespace):
    spec = pair_table(namespace)
    create_table(spark, spec)
    row = lambda key, value: literal_rows(spark, [(key, value)], PAIR_RECORD)
    append_batch(row(1, "a"), spec)
    append_batch(row(2, "b"), spec)
    assert claim_epoch(spark, spec, "stream") == 2
    append_batch(row(3, "c"), spec, 2, 0)
    compact(spark, spec)
    assert claim_epoch(spark, spec, "stream") == 2 and claim_epoch(spark, spec, "other") == 3
    with pytest.raises(ValueError, match="compacted"):
        append_batch(row(4, "lost"), spec, 1, 5)
    append_batch(row(3, "c"), spec, 2, 0, True)
    with pytest.raises(ValueError, match="ended"):
        next_batch(spark, spec)
    with pytest.raises(ValueError, match="another writer"):
        claim_epoch(spark, spec, "third", 3)
    append_batch(row(1, "z"), spec)
    assert rows_of(scan_keyed(spark, spec)) == Counter([(1, "z"), (2, "b"), (3, "c")])


def test_clean_up_drops_its_own_snapshots_only(spark, namespace):
    spec = pair_table(namespace, "Kv")
    create_table(spark, spec)
    for name in ("kv_snapshot_2024", "kv_snapshot_old"):
        create_table(spark, pair_table(namespace, name))
    for value in ("a", "b"):
        append_batch(literal_rows(spark, [(1, value)], PAIR_RECORD), spec)
        compact(spark, spec)
    drop_compacted(spark, spec)
    drop_compacted(spark, spec)
    assert rows_of(scan_keyed(spark, spec)) == Counter([(1, "b")])
    names = {t.name for t in spark.catalog.listTables(namespace)}
    assert {"kv_snapshot_2024", "kv_snapshot_old"} <= names
    assert len([n for n in names if n.startswith("kv_snapshot_3") or n.startswith("kv_snapshot_0") or n.startswith("kv_snapshot_1_")]) == 1


def test_bucket_count_follows_size(spark, namespace):
    assert buckets_for(0) == 8
    assert buckets_for(100 * 2**30) == 256
    assert buckets_for(100 * 2**40) == 262_144
    spec = pair_table(namespace)
    create_table(spark, spec)
    append_batch(literal_rows(spark, PAIRS, PAIR_RECORD), spec, 0, 0)
    assert table_bytes(spark, spec.log) > 0


def test_hot_key_and_ties_in_arrival(spark):
    """A third of all writes share one key, and arrival does not settle them."""
    writes = spark.range(3000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("key"),
        F.lit(0).alias("seq"),
        F.col("id").alias("value"),
    )
    found = {r["key"]: r["value"] for r in latest_per_key(writes, ["key"], ["seq"]).collect()}
    assert len(found) == 2001
    assert found[-1] == 2997
