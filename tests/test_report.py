"""Counts, first rows and comparisons against brute force."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from conftest import PAIRS

from keytide.operators.report import collect_all, compare_copies, count_rows, first_rows, print_report
from keytide.schemas import PAIR_RECORD
from keytide.sources.tables import literal_rows


def test_count_and_first_rows(spark):
    pairs = literal_rows(spark, PAIRS, PAIR_RECORD)
    assert count_rows(pairs).first()["n"] == 9
    assert [tuple(r) for r in first_rows(pairs, ["key"], 3).collect()] == PAIRS[:3]


def test_collect_all_is_whole_or_fails(spark):
    pairs = literal_rows(spark, PAIRS, PAIR_RECORD)
    assert Counter(map(tuple, collect_all(pairs, 9))) == Counter(PAIRS)
    with pytest.raises(ValueError, match="more than 8"):
        collect_all(pairs, 8)


def test_print_report(spark, capsys):
    pairs = literal_rows(spark, PAIRS, PAIR_RECORD)
    report = print_report(pairs, ["key"], 9)
    assert report.startswith("Count: 9\n[Row(key=1, value='One'), Row(key=5")
    assert capsys.readouterr().out == report + "\n"


@pytest.mark.parametrize("seed", range(4))
def test_compare_copies_is_bag_difference(spark, seed):
    rng = random.Random(seed)
    draw = lambda n: [(rng.choice([None, 1, 2, 3]), rng.choice([None, "a", "b"])) for _ in range(n)]
    left, right = draw(rng.randrange(40)), draw(rng.randrange(40))
    row = compare_copies(literal_rows(spark, left, PAIR_RECORD), literal_rows(spark, right, PAIR_RECORD)).first()
    missing, unexpected = Counter(left) - Counter(right), Counter(right) - Counter(left)
    expected = (len(left), len(right), missing.total(), unexpected.total(), not missing and not unexpected)
    assert tuple(row) == expected


def test_compare_empty_copies(spark):
    none = literal_rows(spark, [], PAIR_RECORD)
    assert tuple(compare_copies(none, none).first()) == (0, 0, 0, 0, True)
