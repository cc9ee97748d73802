"""Records and lines derived from the given tables.

An event row becomes the record ``key = event_type``, ``cmpkey`` = last digit of
the user, ``event = event_type``, ``num`` = last digit of the event, and the
event's id is its position in the stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from keytide.functions import wire
from keytide.operators.wire import encode_events, frame


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def instant_ms(rows: DataFrame, column: str) -> str:
    """Epoch ms of a timestamp column; one without a zone holds UTC time."""
    if isinstance(rows.schema[column].dataType, T.TimestampNTZType):
        return wire.wall_clock_to_ms(column)
    return f"unix_millis({column})"


def to_event_records(events: DataFrame, unit_ms: int = 1) -> DataFrame:
    ts_ms = instant_ms(events, "ts")
    return events.selectExpr(
        "event_id",
        "event_type as key",
        "cast(user_id % 10 as string) as cmpkey",
        f"{wire.truncate_ms(ts_ms, unit_ms) if unit_ms > 1 else ts_ms} as ts_ms",
        "event_type as event",
        "cast(event_id % 10 as int) as num",
    )


def event_records(spark: SparkSession, sf_dir: str, unit_ms: int = 1) -> DataFrame:
    return to_event_records(table(spark, sf_dir, "events"), unit_ms)


def damaged_records(records: DataFrame) -> DataFrame:
    """Stream records, some of them malformed.

    The key of every 50th event has a separator too many, and the number of the
    event after it is none.
    """
    return encode_events(records, keep=["event_id"]).selectExpr(
        "if(event_id % 50 = 0, concat(key, '|'), key) as key",
        f"if(event_id % 50 = 1, concat(value, {wire.utf8_bytes("'x'")}), value) as value",
        "event_id as seq",
    )


def damaged_lines(records: DataFrame) -> DataFrame:
    """The same as framed lines, with the event's id."""
    return frame(damaged_records(records), keep=["seq"]).withColumnRenamed("seq", "event_id")


def variant_lines(records: DataFrame) -> DataFrame:
    """Each event as one of sixteen forms of a line, by its id."""
    forms = [
        "key, ':', cmpkey, '|', iso, ';', event, ';', num",
        "key, ':', cmpkey, '|', substring(iso, 1, 19), '.123+02:00;', event, ';+', num",
        "key, ':', cmpkey, ':z|', iso, ';', event, ';', num, ';x;y'",
        "key, ':', cmpkey, '|', iso, ';', event, ';', num, '|'",
        "':', cmpkey, '|', iso, ';;-', num",
        "key, ':', cmpkey",
        "''",
        "'|'",
        "key, ':', cmpkey, '|', iso, '|', event, ';', num",
        "key, '|', iso, ';', event, ';', num",
        "key, ':|', iso, ';', event, ';', num",
        "key, ':', cmpkey, '|', iso, ';', event, ';'",
        "key, ':', cmpkey, '|', iso, ';', event, ';', num, '.7'",
        "key, ':', cmpkey, '|', iso, ';', event, '; ', num",
        "key, ':', cmpkey, '|', iso, ';', event, ';99999999999'",
        "key, ':', cmpkey, '|', substring(iso, 1, 10), ';', event, ';', num",
    ]
    cases = " ".join(f"when {i} then concat({form})" for i, form in enumerate(forms))
    texts = records.selectExpr(
        "event_id", "key", "cmpkey", f"{wire.ms_to_iso('ts_ms')} as iso", "event", "cast(num as string) as num"
    )
    return texts.selectExpr("event_id", f"case event_id % {len(forms)} {cases} end as line")


def id_slices(rows: DataFrame, column: str, n: int) -> list[str]:
    """Conditions that cut a table into ``n`` consecutive ranges of an id."""
    low, high = rows.selectExpr(f"min({column})", f"max({column})").first()
    if low is None:
        return []
    cuts = [low + (high - low + 1) * i // n for i in range(n + 1)]
    return [f"{column} >= {a} and {column} < {b}" for a, b in zip(cuts, cuts[1:])]
