"""Copies in key order: what a lookup opens, and pages that join to the whole table."""

from __future__ import annotations

import pyarrow.parquet as pq
import pytest

from keytide.sources.ordered import lookup, next_page, page_starts, write_ordered


@pytest.fixture(scope="module")
def copy(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("ordered") / "copy")
    rows = spark.range(0, 20_000).selectExpr("id % 97 * 2 as k", "id as c", "repeat(uuid(), 4) as v")
    return path, write_ordered(rows.repartition(5), path, ["k", "c"], group_bytes=64 << 10)


def scanned(rows) -> int:
    """Rows that the scan gave on, those of skipped row groups left out."""
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if plan.getClass().getSimpleName().startswith("Adaptive") else plan
    leaves, found = plan.collectLeaves(), 0
    for i in range(leaves.size()):
        found += leaves.apply(i).metrics().apply("numOutputRows").value()
    return found


def test_lookup_reads_few_row_groups(spark, copy):
    path, rows = copy
    found = lookup(rows, k=42)
    assert found.count() == len(range(21, 20_000, 97)) and {r["c"] % 97 for r in found.collect()} == {21}
    assert "EqualTo(k,42)" in found._jdf.queryExecution().executedPlan().toString()
    assert scanned(lookup(rows, k=42)) < 20_000 / 4
    # Odd keys lie inside the statistics of every range; only the dictionary or a Bloom filter rules them out.
    assert scanned(lookup(rows, k=43)) == 0


def test_files_have_filters_and_ranges(copy):
    import glob

    path, _ = copy
    spans = []
    for file in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        spans += [(meta.row_group(g).column(0).statistics.min, meta.row_group(g).column(0).statistics.max) for g in range(meta.num_row_groups)]
    spans.sort()
    assert len(spans) > 4 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_pages_join_to_the_whole(copy):
    _, rows = copy
    starts = sorted(page_starts(rows, ["k", "c"], 6000).collect(), key=lambda r: r["page"])
    assert [r["n"] for r in starts] == [6000, 6000, 6000, 2000]
    last, met = None, []
    for start in starts:
        page = [(r["k"], r["c"]) for r in next_page(rows, ["k", "c"], 6000, last).collect()]
        assert (page[0], page[-1]) == ((start["low_k"], start["low_c"]), (start["high_k"], start["high_c"]))
        last, met = page[-1], met + page
    assert met == sorted((i % 97 * 2, i) for i in range(20_000))
    assert next_page(rows, ["k", "c"], 6000, last).count() == 0


def test_a_page_is_a_pushed_range(copy):
    _, rows = copy
    plan = next_page(rows, ["k", "c"], 10, (180, 5))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(k,180)" in plan and "TakeOrderedAndProject(limit=10" in plan


def test_null_and_empty(spark, tmp_path):
    rows = spark.createDataFrame([(None, 1), (None, 2), (3, 3)], "k long, c long")
    copy = write_ordered(rows, str(tmp_path / "some"), ["k", "c"])
    assert lookup(copy, k=None).count() == 2 and lookup(copy, k=4).count() == 0
    empty = write_ordered(rows.limit(0), str(tmp_path / "none"), ["k", "c"])
    assert page_starts(empty, ["k", "c"], 5).count() == 0
