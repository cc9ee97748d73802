"""Physical plans: what is pruned, pushed down, shuffled and kept off Python."""

from __future__ import annotations

import re

import pytest

from __spark_entry__ import queries
from keytide.operators.upsert import append_batch, compact, snapshot_rows, snapshot_state
from keytide.plans import inputs
from keytide.schemas import event_table
from keytide.session import scratch_namespace, setting
from keytide.sources.tables import create_table, scan_keyed

NARROW = (
    "kv_select event_seed event_encode event_frame event_parse event_parse_variants "
    "event_parse_default event_quarantine event_align record_text_event record_text_pair"
).split()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [*NARROW, "event_ingest", "event_clustered_slice", "canary_report", "kv_take"])
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    text = plan(queries()[name](spark, sf_dir))
    for node in ("Python", "CartesianProduct", "NestedLoopJoin"):
        assert node not in text


@pytest.mark.parametrize("name", NARROW)
def test_narrow_queries_do_not_shuffle(spark, sf_dir, name):
    assert "Exchange" not in plan(queries()[name](spark, sf_dir))


def test_scans_read_only_the_columns_they_need(spark, sf_dir):
    assert "ReadSchema: struct<>" in plan(queries()["kv_count"](spark, sf_dir))
    ingest = plan(queries()["event_ingest"](spark, sf_dir))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in ingest


def test_filter_on_status_parses_once(spark, sf_dir):
    text = queries()["event_parse_default"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("substring_index") == 2
    assert "PushedFilters" not in text


def test_latest_is_combined_before_its_only_shuffle(spark, sf_dir):
    text = plan(queries()["event_ingest"](spark, sf_dir))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("partial_max(struct(event_id") == 1
    keys = re.search(r"Exchange hashpartitioning\(([^)]*)\)", text).group(1)
    assert [k.split("#")[0].strip() for k in keys.split(",")][:3] == ["key", "cmpkey", "ts_ms"]
    assert "Window" not in text


def test_newest_is_limited_before_its_shuffle(spark, sf_dir):
    text = plan(queries()["event_clustered_slice"](spark, sf_dir))
    assert re.search(r"row_number\(\), 3, Partial", text)


def test_take_is_a_top_k(spark, sf_dir):
    assert "TakeOrderedAndProject(limit=9" in plan(queries()["kv_take"](spark, sf_dir))


def test_comparison_combines_before_its_only_wide_shuffle(spark, sf_dir):
    text = plan(queries()["canary_report"](spark, sf_dir))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("partial_sum(_e") == 2


@pytest.fixture(scope="module")
def compacted(spark, sf_dir):
    """A table with a snapshot of eight buckets and one later batch."""
    spec = event_table(scratch_namespace(spark, "test_plans"))
    create_table(spark, spec)
    records = inputs.event_records(spark, sf_dir)
    append_batch(records, spec, 0, 0)
    compact(spark, spec, buckets=8)
    append_batch(records.where("event_id < 100"), spec, 0, 1)
    return spec


def test_key_filter_reaches_snapshot_and_log(spark, compacted):
    text = plan(scan_keyed(spark, compacted).where("key = 'view'"))
    scans = [line for line in text.splitlines() if "FileScan" in line]
    assert len(scans) >= 2
    assert all("EqualTo(key,view)" in line for line in scans)
    logs = [line for line in scans if "_log" in line]
    assert logs and all("PartitionFilters: [((epoch" in line for line in logs)


def test_read_shuffles_only_later_writes(spark, compacted):
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        text = plan(scan_keyed(spark, compacted))
    assert not exchanges_over_snapshot(text)


def exchanges_over_snapshot(text: str) -> list[str]:
    """Exchanges between the snapshot's scan and the union at the top of a plan."""
    lines = text.splitlines()
    at = next(i for i, line in enumerate(lines) if "FileScan" in line and "_snapshot_" in line)
    assert "Bucketed: true" in lines[at]
    assert any("SortMergeJoin" in line for line in lines[:at])
    return [line for line in lines[:at] if "Exchange" in line]


def test_compaction_moves_only_later_writes(spark, compacted):
    state = snapshot_state(spark, compacted)
    rows = snapshot_rows(spark, compacted, (0, 1), state["buckets"], state)
    assert not exchanges_over_snapshot(plan(rows))


def test_first_compaction_shuffles_once(spark, compacted):
    with setting(spark, "spark.sql.shuffle.partitions", "8"):
        text = plan(snapshot_rows(spark, compacted, (0, 1), 8, None))
    assert text.count("Exchange") == 1
    assert "partial_max" in text


def test_compaction_writes_one_file_per_bucket(spark, compacted):
    snapshot = compact(spark, compacted)
    assert len(spark.table(snapshot).inputFiles()) == 8
    assert spark.table(snapshot).count() == scan_keyed(spark, compacted).count()
