"""Encoding, framing and parsing, case by case."""

from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import strategies as st

from keytide.functions import wire
from keytide.operators.wire import accept, encode_events, frame, parse_lines, set_aside
from keytide.schemas import DEFAULT_EVENT, EVENT_RECORD

SECOND = 1412684408000

CASES = [
    ("test:650|2014-10-07T12:20:08Z;foo;1", "ok", ("test", "650", SECOND, "foo", 1)),
    ("test:650|2014-10-07T12:20:08.123+02:00;foo;+7", "ok", ("test", "650", 1412677208123, "foo", 7)),
    ("test:650|2014-10-07T12:20:08.123456789Z;foo;1", "ok", ("test", "650", SECOND + 123, "foo", 1)),
    ("a:b:c|2014-10-07T12:20:08Z;foo;1;x;y", "ok", ("a", "b", SECOND, "foo", 1)),
    ("a:b|2014-10-07T12:20:08Z;foo;1|", "ok", ("a", "b", SECOND, "foo", 1)),
    ("a:b::|2014-10-07T12:20:08Z;foo;-1;;||", "ok", ("a", "b", SECOND, "foo", -1)),
    (":b|2014-10-07T12:20:08Z;;1", "ok", ("", "b", SECOND, "", 1)),
    ("ключ:值|2014-10-07T12:20:08Z;événement;1", "ok", ("ключ", "值", SECOND, "événement", 1)),
    ("test:650", "bad_shape", None),
    ("", "bad_shape", None),
    ("|", "bad_shape", None),
    ("|||", "bad_shape", None),
    ("a:b|x|y", "bad_shape", None),
    ("a:b||2014-10-07T12:20:08Z;foo;1", "bad_shape", None),
    (None, "bad_shape", None),
    ("|x", "bad_field", None),
    ("nokey|2014-10-07T12:20:08Z;foo;1", "bad_field", None),
    ("a:|2014-10-07T12:20:08Z;foo;1", "bad_field", None),
    (":|2014-10-07T12:20:08Z;foo;1", "bad_field", None),
    ("a:b|2014-10-07T12:20:08Z;foo;", "bad_field", None),
    ("a:b|2014-10-07T12:20:08Z;foo", "bad_field", None),
    ("a:b|;;", "bad_field", None),
    ("a:b|2014-10-07T12:20:08Z;foo;3.7", "bad_field", None),
    ("a:b|2014-10-07T12:20:08Z;foo; 3", "bad_field", None),
    ("a:b|2014-10-07T12:20:08Z;foo;3 ", "bad_field", None),
    ("a:b|2014-10-07T12:20:08Z;foo;99999999999", "bad_field", None),
    ("a:b|2014-10-07T12:20:08Z;foo;0x1", "bad_field", None),
    ("a:b|notadate;foo;1", "bad_field", None),
    ("a:b|2014-10-07;foo;1", "bad_field", None),
    ("a:b|2014-10-07 12:20:08Z;foo;1", "bad_field", None),
    ("a:b| 2014-10-07T12:20:08Z;foo;1", "bad_field", None),
    ("a:b|2014-13-07T12:20:08Z;foo;1", "bad_field", None),
    ("a:b|2014-10-07T12:20:8.Z;foo;1", "bad_field", None),
]


@pytest.fixture
def parsed(spark):
    rows = [(i, line) for i, (line, _, _) in enumerate(CASES)]
    return parse_lines(spark.createDataFrame(rows, "i int, line string"), keep=["i"])


def test_parse_cases(parsed, zone):
    found = {r["i"]: r for r in parsed.collect()}
    assert len(found) == len(CASES)
    for i, (line, status, values) in enumerate(CASES):
        row = found[i]
        assert row["status"] == status, line
        assert tuple(row[c] for c in EVENT_RECORD.names) == (values or (None,) * 5), line


def test_time_without_zone_is_in_the_session_zone(spark, zone):
    lines = spark.createDataFrame([("a:b|2014-10-07T12:20:08;foo;1",)], "line string")
    offset = 7 * 3_600_000 if zone == "America/Los_Angeles" else 0
    assert parse_lines(lines).first()["ts_ms"] == SECOND + offset


def test_default_takes_the_place_of_a_shapeless_line(parsed):
    rows = accept(parsed, "default", "drop", keep=["i"]).collect()
    default = tuple(DEFAULT_EVENT[c] for c in EVENT_RECORD.names)
    expected = {
        i: values or default for i, (_, status, values) in enumerate(CASES) if status != "bad_field"
    }
    assert {r["i"]: tuple(r)[1:] for r in rows} == expected


@pytest.mark.parametrize("policy", ["drop", "quarantine"])
def test_dropped_lines(parsed, policy):
    rows = accept(parsed, policy, policy, keep=["i"]).collect()
    assert {r["i"] for r in rows} == {i for i, c in enumerate(CASES) if c[1] == "ok"}
    aside = set_aside(parsed, policy, policy, keep=["i"]).collect()
    bad = {(i, c[1], c[0]) for i, c in enumerate(CASES) if c[1] != "ok"}
    assert {tuple(r) for r in aside} == (bad if policy == "quarantine" else set())


@pytest.mark.parametrize("shape,field,message", [("fail", "drop", "bad_shape: "), ("drop", "fail", "bad_field: ")])
def test_fail_stops_even_a_bare_count(parsed, shape, field, message):
    with pytest.raises(Exception, match=message):
        accept(parsed, shape, field).count()


def test_unknown_policy(parsed):
    with pytest.raises(ValueError, match="on_bad_shape"):
        accept(parsed, "ignore", "drop")
    with pytest.raises(ValueError, match="on_bad_field"):
        accept(parsed, "drop", "default")


def test_malformed_bytes_do_not_stop_the_stream(spark):
    records = spark.createDataFrame([("a:b", bytearray(b"2014-10-07T12:20:08Z;f\xff;1"))], "key string, value binary")
    row = parse_lines(frame(records)).first()
    assert (row["status"], row["event"]) == ("ok", "f�")


# Any text that cannot be taken for a separator; the last part must not be empty.
_text = st.text(st.characters(exclude_characters="|:;", exclude_categories=["Cs"]), max_size=12)
_event = st.tuples(
    _text,
    _text.filter(bool),
    st.integers(-10**12, 4 * 10**12),
    _text,
    st.integers(-(2**31), 2**31 - 1),
)


def test_encode_then_parse_is_identity_to_the_second(spark, zone):
    import random

    from hypothesis import HealthCheck, Phase, given, settings

    drawn: list[tuple] = []

    @settings(max_examples=300, database=None, phases=[Phase.generate], suppress_health_check=list(HealthCheck))
    @given(_event)
    def draw(event):
        drawn.append(event)

    draw()
    assert len(drawn) > 100
    random.shuffle(drawn)
    rows = [(i, *event) for i, event in enumerate(drawn)]
    events = spark.createDataFrame(rows, "i int, key string, cmpkey string, ts_ms bigint, event string, num int")
    back = parse_lines(frame(encode_events(events, keep=["i"]), keep=["i"]), keep=["i"])
    found = {r["i"]: r for r in back.collect()}
    for i, key, cmpkey, ts_ms, event, num in rows:
        row = found[i]
        assert row["status"] == "ok", rows[i]
        assert tuple(row[c] for c in EVENT_RECORD.names) == (key, cmpkey, ts_ms // 1000 * 1000, event, num)


def test_wall_clock_is_read_as_utc(spark, zone):
    times = [
        dt.datetime(2024, 3, 10, 2, 30, 0, 123456),
        dt.datetime(2024, 11, 3, 1, 30, 0, 999999),
        dt.datetime(1969, 12, 31, 23, 59, 59, 500000),
        dt.datetime(2024, 2, 29, 0, 0),
    ]
    rows = spark.createDataFrame([(t,) for t in times], "ts timestamp_ntz")
    found = rows.selectExpr("ts", f"{wire.wall_clock_to_ms('ts')} as ms").collect()
    epoch = dt.datetime(1970, 1, 1)
    for row in found:
        micros = (row["ts"] - epoch) // dt.timedelta(microseconds=1)
        assert row["ms"] == micros // 1000


def test_iso_text_is_utc(spark, zone):
    ms = [SECOND, 1710037800000, -1500, 0, 4102444800999]
    rows = spark.createDataFrame([(m,) for m in ms], "ts_ms bigint")
    found = [r[0] for r in rows.selectExpr(wire.ms_to_iso("ts_ms")).collect()]
    expected = [
        dt.datetime.fromtimestamp(m // 1000, dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ") for m in ms
    ]
    assert sorted(found) == sorted(expected)


def test_now_is_the_current_time(spark):
    before = dt.datetime.now().timestamp() * 1000
    now = spark.range(1).selectExpr(wire.now_ms()).first()[0]
    assert before - 1000 <= now <= dt.datetime.now().timestamp() * 1000 + 1000


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_a_line_end_after_a_field_is_no_part_of_it(spark, end):
    rows = [(f"a:b|2014-10-07T12:20:08Z;foo;1{end}",), (f"a:b|2014-10-07T12:20:08Z{end};foo;1",)]
    found = parse_lines(spark.createDataFrame(rows, "line string")).select("status").collect()
    assert [r["status"] for r in found] == ["bad_field", "bad_field"]
