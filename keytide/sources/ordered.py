"""Copies of a table in key order, for lookups and for reading it page by page.

The files hold disjoint ranges of the key, sorted, with a Bloom filter of each lookup
column (Parquet leaves it out where a dictionary of all values does the same), so a filter
on the key opens few files and in them few row groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GROUP_BYTES = 16 << 20  # a row group, the least that a lookup reads
NDV = 100_000  # distinct keys a row group's Bloom filter is made for


def write_ordered(
    rows: DataFrame, path: str, key: Sequence[str], lookups: Sequence[str] | None = None, group_bytes: int = GROUP_BYTES
) -> DataFrame:
    """Write ``rows`` to ``path`` in order of ``key``, nulls first, and return the copy.

    Ranges are of the whole key, so that many rows with one leading value are cut by the
    columns after it.  ``lookups`` are the columns with Bloom filters: the key's first if
    not given.
    """
    writer = rows.repartitionByRange(*key).sortWithinPartitions(*key).write.option("parquet.block.size", group_bytes)
    for column in lookups if lookups is not None else key[:1]:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{column}", NDV)
    writer.mode("errorifexists").parquet(path)
    return rows.sparkSession.read.parquet(path)


def lookup(rows: DataFrame, **equal: object) -> DataFrame:
    """The rows whose columns have the given values; every test reaches the files."""
    for column, value in equal.items():
        rows = rows.where(F.col(column).isNull() if value is None else F.col(column) == F.lit(value))
    return rows


def page_starts(rows: DataFrame, key: Sequence[str], size: int) -> DataFrame:
    """``page, n`` and the first and last key of each page of ``size`` rows in key order.

    ``rows`` is a copy that ``write_ordered`` returned and ``key`` its unique key, never
    null; the pages are those that ``next_page`` gives one after another.  Rows are numbered within the files' ranges, and a range starts at the sum of
    those before it; the only rows that meet in one task are the ranges' sizes, one a file.
    """
    parts = rows.select(F.struct(*key).alias("key"), F.input_file_name().alias("file"))
    sizes = parts.groupBy("file").agg(F.count(F.lit(1)).alias("size"), F.min("key").alias("least"))
    before = F.coalesce(F.sum("size").over(Window.orderBy("least", "file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("file", before.alias("start"))
    within = F.row_number().over(Window.partitionBy("file").orderBy("key"))
    numbered = parts.withColumn("within", within).join(starts, "file")
    page = F.floor((F.col("start") + F.col("within") - 1) / size).cast("long")
    found = numbered.groupBy(page.alias("page")).agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("low"), F.max("key").alias("high"))
    ends = [F.col(f"{end}.{c}").alias(f"{end}_{c}") for end in ("low", "high") for c in key]
    return found.select("page", "n", *ends)


def after(key: Sequence[str], values: Sequence[object]) -> Column:
    """The rows behind a place in key order.

    The first column's bound stands alone as well: that is what files are chosen by.
    """
    found, equal = F.lit(False), F.lit(True)
    for column, value in zip(key, values, strict=True):
        found |= equal & (F.col(column) > F.lit(value))
        equal &= F.col(column) == F.lit(value)
    return (F.col(key[0]) >= F.lit(values[0])) & found


def next_page(rows: DataFrame, key: Sequence[str], size: int, last: Sequence[object] | None = None) -> DataFrame:
    """The first ``size`` rows in order of the unique, never null ``key``, or those behind the key ``last``.

    Each task passes on ``size`` rows at most.
    """
    return (rows if last is None else rows.where(after(key, last))).orderBy(*key).limit(size)
