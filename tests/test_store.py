"""A plugged-in store: pieces of a scan, pushed keys, other filters, odd keys."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from keytide.session import namespace_dir
from keytide.sources.shards import shard_of
from keytide.sources.store import FileClient, StoreReader, export, range_of, scan_files


@pytest.fixture
def path(spark, namespace):
    return f"{namespace_dir(spark, namespace)}/store"


def rows_of(spark):
    return spark.range(0, 3000, numPartitions=3).selectExpr("if(id % 50 = 7, null, id % 40) as k", "id as c", "array(cast(id as string)) as v")


def text(rows) -> list[str]:
    return sorted(map(str, rows.collect()))


def test_scan_and_lookup(spark, path):
    rows = rows_of(spark)
    export(rows, path, "k")
    store = scan_files(spark, path, rows.schema, "k")
    assert text(store) == text(rows)
    for keys in ([33], [3, 4, 99], [5, 5, None], []):
        found = scan_files(spark, path, rows.schema, "k", keys)
        assert text(found) == text(rows.where(rows["k"].isin(keys))), keys
        assert text(found.where("c > 1000")) == text(rows.where(rows["k"].isin(keys) & (rows["c"] > 1000))), keys
    for test in ("k = 33", "k is null", "k > 37", "k <=> 5"):
        assert text(store.where(test)) == text(rows.where(test)), test
    some = rows.select("c", "k").schema
    assert text(scan_files(spark, path, some, "k", [7])) == text(rows.where("k = 7").select("c", "k"))


def test_one_scan_read_with_and_without_filters(spark, path):
    rows = rows_of(spark)
    export(rows, path, "k")
    store = scan_files(spark, path, rows.schema, "k")
    assert store.where("k = 33").union(store.where("k = 4")).count() == rows.where("k in (33, 4)").count()
    assert store.groupBy("k").count().count() == 41
    assert store.where("k = 7").join(store.select("c"), "c").count() == rows.where("k = 7").count()


def test_keys_read_their_ranges_only(spark, path):
    rows = rows_of(spark)
    export(rows, path, "k")

    def ranges(**keys):
        options = {"client": "keytide.sources.store:FileClient", "path": path, "key": "k", **keys}
        parts = StoreReader(rows.schema, options).partitions()
        return {int(p.work[0].split("_range=")[1].split("/")[0]) for p in parts}

    assert len(ranges()) > 10
    assert ranges(keys="[33]") == {range_of(33, 16)}
    assert ranges(keys="[33, 4]") == {range_of(33, 16), range_of(4, 16)}
    assert ranges(keys="[]") == set()


def test_a_hot_range_has_a_piece_per_writing_task(spark, path):
    export(spark.range(0, 600, numPartitions=4).selectExpr("'hot' as k", "id as c"), path, "k")
    assert len(FileClient({"path": path, "key": "k"}).plan(["hot"])) == 4


def test_ranges_are_those_of_the_records(spark):
    keys = ["", "a", "é", "k1", "-5", "77"]
    found = spark.createDataFrame([(k,) for k in keys], "k string").select("k", shard_of(F.col("k"), 16).alias("r"))
    assert {r["k"]: r["r"] for r in found.collect()} == {k: range_of(k, 16) for k in keys}


def test_empty_store(spark, path):
    rows = rows_of(spark).where("k > 99")
    export(rows, path, "k")
    store = scan_files(spark, path, rows.schema, "k")
    assert store.count() == 0 and store.columns == ["k", "c", "v"]
    assert scan_files(spark, path, rows.schema, "k", [1]).count() == 0
