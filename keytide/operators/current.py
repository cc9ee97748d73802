"""Last write per key and newest rows per partition key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keytide.schemas import TableSpec


def latest_per_key(writes: DataFrame, key: Sequence[str], arrival: Sequence[str]) -> DataFrame:
    """One row per ``key``: the one with the greatest ``arrival`` columns.

    A maximum combines before the shuffle, so a key that holds a large share of
    all writes sends one row per input partition.  Ties in ``arrival`` are
    settled by the remaining columns, for the same result on every run.
    """
    last = writes.groupBy(*key).agg(F.expr(f"{greatest_write(writes.columns, key, arrival)} as _last"))
    values = {c: c if c in key else f"_last.{c} as {c}" for c in writes.columns}
    return last.selectExpr(*values.values())


def greatest_write(columns: Sequence[str], key: Sequence[str], arrival: Sequence[str]) -> str:
    """The aggregate over a key's writes that holds all columns of the last one."""
    rest = [c for c in columns if c not in key and c not in arrival]
    return f"max(struct({', '.join([*arrival, *rest])}))"


def newest_per_partition(rows: DataFrame, spec: TableSpec, n: int) -> DataFrame:
    """The first ``n`` rows of each partition key in clustering order, with ``pos``.

    ``rows`` holds one row per primary key, so the order has no ties.
    """
    if not spec.clustering:
        raise ValueError(f"{spec.name} has no clustering columns")
    group, newest = ", ".join(spec.partition_key), ", ".join(f"{c} desc" for c in spec.clustering)
    position = f"row_number() over (partition by {group} order by {newest}) as pos"
    return rows.selectExpr("*", position).where(f"pos <= {int(n)}")


def clustered(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """All rows laid out in clustering order.

    Ranges of the full primary key, not the partition key alone, make up the
    partitions: a hot partition key is cut by its clustering columns.
    """
    order = [F.col(c).asc() for c in spec.partition_key] + [F.col(c).desc() for c in spec.clustering]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)
