"""Records to table rows and back, column by column name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from keytide.functions import text
from keytide.schemas import TableSpec


def _is_instant(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.TimestampType)


def to_rows(records: DataFrame, spec: TableSpec, extra: T.StructType | None = None) -> DataFrame:
    """Records as rows of ``spec``: order and case of columns do not matter.

    A timestamp column ``ts`` comes from the record's ``ts_ms``.  Columns the
    table does not have are dropped, a missing one is an error.  ``extra`` names
    further columns to carry along.
    """
    have = {c.lower() for c in records.columns}
    instants = [
        f"timestamp_millis({f.name}_ms) as {f.name}"
        for f in spec.schema
        if _is_instant(f) and f.name.lower() not in have and f"{f.name}_ms".lower() in have
    ]
    if instants:
        records = records.selectExpr("*", *instants)
    target = T.StructType(list(spec.schema) + list(extra or []))
    have = {c.lower() for c in records.columns}
    missing = [c for c in target.names if c.lower() not in have]
    if missing:
        raise ValueError(f"{spec.name}: the records have no column for {missing}")
    return records.to(target)


def to_records(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows of ``spec`` as records: timestamps become epoch milliseconds."""
    return rows.selectExpr(
        *[
            f"unix_millis({f.name}) as {f.name}_ms" if _is_instant(f) else f"{f.name}"
            for f in spec.schema
        ]
    )


def event_lines(records: DataFrame, keep: list[str]) -> DataFrame:
    return records.selectExpr(*keep, f"{text.event_text('key', 'cmpkey', 'ts_ms', 'event', 'num')} as text")


def pair_lines(pairs: DataFrame, keep: list[str]) -> DataFrame:
    return pairs.selectExpr(*keep, f"{text.pair_text('key', 'value')} as text")
