"""Comparison by key ranges against the comparison of all rows."""

from __future__ import annotations

import random

import pytest

from keytide.operators.ranges import Span, compare_ranges, differing, joined, within
from keytide.operators.report import compare_copies
from keytide.sources.tables import literal_rows
from keytide.schemas import PAIR_RECORD


def pairs(spark, rows):
    return literal_rows(spark, rows, PAIR_RECORD)


@pytest.mark.parametrize("seed", range(5))
def test_equals_the_comparison_of_all_rows(spark, seed):
    rng = random.Random(seed)
    left = [(rng.choice([None, rng.randrange(-500, 500)]), rng.choice([None, "a", "b"])) for _ in range(300)]
    right = [r for r in left if rng.random() > 0.02] + [left[0]] * rng.randrange(3)
    rng.shuffle(right)
    a, b = pairs(spark, left), pairs(spark, right)
    assert compare_ranges(a, b, "key", cells=16, most=3).collect() == compare_copies(a, b).collect()


@pytest.mark.parametrize("rows", [[], [(None, None)], [(7, "x")], [(-(2**31), "x"), (2**31 - 1, "y")]])
def test_small_and_far_keys(spark, rows):
    some, none = pairs(spark, rows), pairs(spark, [])
    for a, b in ((some, some), (some, none), (none, some)):
        assert compare_ranges(a, b, "key").collect() == compare_copies(a, b).collect()


def test_null_and_place_are_told_apart(spark):
    a = spark.createDataFrame([(1, None, "x")], "key int, u string, v string")
    b = spark.createDataFrame([(1, "x", None)], "key int, u string, v string")
    assert not compare_ranges(a, b, "key").first()["passed"]


def test_only_ranges_that_differ_are_read_again(spark, tmp_path):
    rows = spark.range(100_000).selectExpr("id as key", "cast(id * 7 as string) as value")
    rows.repartitionByRange(8, "key").sortWithinPartitions("key").write.parquet(str(tmp_path / "a"))
    a = spark.read.parquet(str(tmp_path / "a"))
    b = a.selectExpr("key", "if(key in (40001, 90000), 'other', value) as value")
    found = differing(a, b, "key", cells=64)
    assert found.spans == [Span(40001, 40001), Span(90000, 90000)] and not found.null_keys
    # Cells of 1563, 49, 2 and 1 keys.
    assert (found.expected_n, found.actual_n) == (100_000, 100_000) and found.readings == 4
    left = a.where(within("key", found.spans, found.null_keys))
    assert left.count() == 2
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(EqualTo(key,40001),EqualTo(key,90000))]" in plan
    assert tuple(compare_ranges(a, b, "key", cells=64).first()) == (100_000, 100_000, 2, 2, False)


def test_equal_copies_move_no_rows(spark):
    a = spark.range(5000).selectExpr("id as key", "id as value")
    assert differing(a, a, "key").spans == [] and differing(a, a, "key").readings == 1
    assert compare_ranges(a, a, "key").first()["passed"]
    plan = compare_ranges(a, a, "key")._jdf.queryExecution().optimizedPlan().toString()
    assert "Range (0, 5000" not in plan


def test_spans_are_bounded():
    spans = [Span(i * i, i * i) for i in range(100)]
    for most in (1, 2, 5, 100):
        found = joined(spans, most)
        assert len(found) <= most and all(any(f.low <= s.low <= f.high for f in found) for s in spans)
