"""Counts, first rows and the comparison of two copies of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F


def count_rows(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("n"))


def first_rows(rows: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows in key order; each partition passes on ``n`` at most."""
    return rows.orderBy(*order).limit(n)


def collect_all(rows: DataFrame, max_rows: int = 1000) -> list[Row]:
    """All rows on the driver, or an error if there are more than ``max_rows``."""
    found = rows.take(max_rows + 1)
    if len(found) > max_rows:
        raise ValueError(f"more than {max_rows} rows: write them to a table, or raise max_rows")
    return found


def print_report(rows: DataFrame, order: Sequence[str], n: int) -> str:
    """``Count: …`` and the first ``n`` rows, printed and returned."""
    count = count_rows(rows).first()["n"]
    report = f"Count: {count}\n{first_rows(rows, order, n).collect()}"
    print(report)
    return report


def compare_copies(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Counts of both copies and of the rows each has that the other lacks.

    Rows count as often as they occur and NULLs are equal.  Both copies go
    through one aggregation, which combines before its only shuffle.
    """
    columns = expected.columns
    sides = expected.selectExpr(*columns, "1 as _e", "0 as _a").unionByName(
        actual.selectExpr(*columns, "0 as _e", "1 as _a")
    )
    per_row = sides.groupBy(*columns).agg(F.expr("sum(_e) as _e"), F.expr("sum(_a) as _a"))
    totals = {
        "expected_n": "_e",
        "actual_n": "_a",
        "missing_n": "greatest(_e - _a, 0)",
        "unexpected_n": "greatest(_a - _e, 0)",
    }
    counts = per_row.selectExpr(*[f"coalesce(sum({value}), 0L) as {name}" for name, value in totals.items()])
    return counts.selectExpr("*", "missing_n = 0 and unexpected_n = 0 as passed")
