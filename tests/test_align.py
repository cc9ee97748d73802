"""Records to rows and back, and records as text."""

from __future__ import annotations

import pytest

from keytide.operators.align import event_lines, pair_lines, to_records, to_rows
from keytide.schemas import EVENT_RECORD, PAIR_RECORD, STREAM_RECORD, TableSpec, event_table
from keytide.sources.tables import literal_rows

SPEC = event_table("ns")
SEED = [("bootstrap", "600", 1412684408000 + i, "test", i + 1) for i in range(4)]


def test_round_trip_by_name(spark, zone):
    records = literal_rows(spark, SEED, EVENT_RECORD)
    other = records.selectExpr("NUM", "event", "ts_ms as TS_MS", "1 as more", "cmpkey", "key")
    rows = to_rows(other, SPEC)
    assert rows.schema.simpleString() == SPEC.schema.simpleString()
    back = to_records(rows, SPEC)
    assert back.columns == EVENT_RECORD.names
    assert sorted(map(tuple, back.collect())) == SEED


def test_missing_column(spark):
    records = literal_rows(spark, SEED, EVENT_RECORD).drop("event", "ts_ms")
    with pytest.raises(ValueError, match=r"\['ts', 'event'\]"):
        to_rows(records, SPEC)


def test_spec_checks_its_key():
    with pytest.raises(ValueError, match="unknown columns"):
        TableSpec("ns.t", PAIR_RECORD, ("id",))
    with pytest.raises(ValueError, match="namespace.table"):
        TableSpec("t", PAIR_RECORD, ("key",))
    with pytest.raises(ValueError, match="its own columns"):
        TableSpec("ns.t", STREAM_RECORD, ("key",))
    with pytest.raises(ValueError, match="letters, digits"):
        TableSpec("ns.t; x", PAIR_RECORD, ("key",))
    assert SPEC.primary_key == ("key", "cmpkey", "ts")


def test_record_text(spark):
    events = literal_rows(spark, [*SEED[:1], (None, "1", 0, "0", None)], EVENT_RECORD)
    assert {r["text"] for r in event_lines(events, keep=[]).collect()} == {
        "EventRecord(bootstrap, 600, 1412684408000, test, 1)",
        "EventRecord(null, 1, 0, 0, null)",
    }
    pairs = literal_rows(spark, [(1, "One"), (1234567, "x"), (-1000, None), (None, "y")], PAIR_RECORD)
    assert {r["text"] for r in pair_lines(pairs, keep=[]).collect()} == {
        "(key: 1, val: One)",
        "(key: 1,234,567, val: x)",
        "(key: -1,000, val: null)",
        "(key: null, val: y)",
    }
