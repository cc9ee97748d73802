"""DuckDB SQL for each query, written from the tables and not from the parser."""

from __future__ import annotations

_MS = "epoch_us(ts) // 1000"
_SECOND = "(epoch_us(ts) // 1000000) * 1000"
_DAY = "(epoch_us(ts) // 86400000000) * 86400000"
_ISO = "strftime(ts, '%Y-%m-%dT%H:%M:%SZ')"
_CMPKEY = "cast(user_id % 10 as varchar)"
_NUM = "cast(event_id % 10 as integer)"
_DATA = f"{_ISO} || ';' || event_type || ';' || cast(event_id % 10 as varchar)"
_VALUES = "key, cmpkey, ts_ms, event, num"


def _accepted(ts_ms: str) -> str:
    """Events under the policies (default, drop)."""
    return f"""
      select event_id,
        case when event_id % 50 = 0 then '' else event_type end as key,
        case when event_id % 50 = 0 then '' else {_CMPKEY} end as cmpkey,
        case when event_id % 50 = 0 then 0 else {ts_ms} end as ts_ms,
        case when event_id % 50 = 0 then '0' else event_type end as event,
        case when event_id % 50 = 0 then 0 else {_NUM} end as num
      from events where event_id % 50 <> 1"""


def _current(ts_ms: str) -> str:
    return f"""
      select {_VALUES} from (
        select *, row_number() over (partition by key, cmpkey, ts_ms order by event_id desc) as r
        from ({_accepted(ts_ms)})) where r = 1"""


_LINE = f"""
  event_type || ':' || {_CMPKEY} || case when event_id % 50 = 0 then '||' else '|' end
  || {_DATA.replace(_ISO, "strftime(date_trunc('UNIT', ts), '%Y-%m-%dT%H:%M:%SZ')")}
  || case when event_id % 50 = 1 then 'x' else '' end"""
_SECOND_LINE, _DAY_LINE = _LINE.replace("UNIT", "second"), _LINE.replace("UNIT", "day")


def _set_aside(line: str) -> str:
    return f"""
      select event_id as seq, case event_id % 50 when 0 then 'bad_shape' else 'bad_field' end as status,
        {line} as line
      from events where event_id % 50 < 2"""


_DAY_CURRENT = _current(_DAY)
_ORDER_PAIRS = "select o_orderkey as key, o_orderpriority as value from orders"

_VARIANT_OK = "event_id % 16 < 5"
_EVENT_TEXT = (
    f"'EventRecord(' || event_type || ', ' || {_CMPKEY} || ', ' || cast({_MS} as varchar) || ', ' "
    f"|| event_type || ', ' || cast({_NUM} as varchar) || ')'"
)


def _shard(key: str) -> str:
    return f"cast((cast('0x' || substr(md5({key}), 1, 8) as bigint) * 8) // 4294967296 as integer)"


_SENT_KEY = f"event_type || ':' || {_CMPKEY}"
_DAMAGED_KEY = f"{_SENT_KEY} || case when event_id % 50 = 0 then '|' else '' end"
_FIRST_CUT = "(select min(event_id) + (max(event_id) - min(event_id) + 1) // 3 from events)"

ORACLE: dict[str, str] = {
    "kv_select": "select c_custkey as key, c_name as value from customer",
    "kv_count": "select count(*) as n from lineitem",
    "kv_take": f"{_ORDER_PAIRS} order by 1 limit 9",
    "kv_roundtrip": _ORDER_PAIRS,
    "kv_overwrite": """
      select o_orderkey as key,
        case when o_orderstatus = 'O' then o_orderstatus else o_orderpriority end as value
      from orders""",
    "event_seed": """
      select 'bootstrap' as key, cast(c_custkey as varchar) as cmpkey, 1412684408000 + i as ts_ms,
        'test' as event, cast(i + 1 as integer) as num
      from customer, range(0, 4) t(i)""",
    "event_encode": f"""
      select event_id, event_type || ':' || {_CMPKEY} as partition_key, {_DATA} as data,
        cast(octet_length(encode({_DATA})) as integer) as n_bytes
      from events""",
    "event_frame": f"select event_id, {_SECOND_LINE} as line from events",
    "event_parse": f"""
      select event_id,
        case event_id % 50 when 0 then 'bad_shape' when 1 then 'bad_field' else 'ok' end as status,
        case when event_id % 50 > 1 then event_type end as key,
        case when event_id % 50 > 1 then {_CMPKEY} end as cmpkey,
        case when event_id % 50 > 1 then {_SECOND} end as ts_ms,
        case when event_id % 50 > 1 then event_type end as event,
        case when event_id % 50 > 1 then {_NUM} end as num
      from events""",
    "event_parse_variants": f"""
      select event_id,
        case when {_VARIANT_OK} then 'ok' when event_id % 16 < 9 then 'bad_shape'
          else 'bad_field' end as status,
        case when event_id % 16 = 4 then '' when {_VARIANT_OK} then event_type end as key,
        case when {_VARIANT_OK} then {_CMPKEY} end as cmpkey,
        case when event_id % 16 = 1 then {_SECOND} - 7200000 + 123
          when {_VARIANT_OK} then {_SECOND} end as ts_ms,
        case when event_id % 16 = 4 then '' when {_VARIANT_OK} then event_type end as event,
        case when event_id % 16 = 4 then -{_NUM} when {_VARIANT_OK} then {_NUM} end as num
      from events""",
    "event_parse_default": f"select event_id, {_VALUES} from ({_accepted(_SECOND)})",
    "event_quarantine": f"""
      select event_id, case event_id % 50 when 0 then 'bad_shape' else 'bad_field' end as status,
        {_SECOND_LINE} as line
      from events where event_id % 50 < 2""",
    "event_ingest": _current(_SECOND),
    "event_upsert_latest": _DAY_CURRENT,
    "event_clustered_slice": f"""
      select * from (
        select {_VALUES},
          cast(row_number() over (partition by key, cmpkey order by ts_ms desc) as integer) as pos
        from ({_DAY_CURRENT})) where pos <= 3""",
    "event_clustered_scan": _current(_SECOND),
    "event_align": f"""
      select event_type as key, {_CMPKEY} as cmpkey, {_MS} as ts_ms, event_type as event, {_NUM} as num
      from events""",
    "record_text_event": f"select event_id, {_EVENT_TEXT} as text from events",
    "record_text_pair": """
      select o_orderkey as key,
        format('(key: {:,}, val: {})', o_orderkey, o_orderpriority) as text
      from orders""",
    "event_compact": _DAY_CURRENT,
    "event_replay": _DAY_CURRENT,
    "event_batch_then_stream": _DAY_CURRENT,
    "event_stream_restart": _DAY_CURRENT,
    "event_stream_upsert": _DAY_CURRENT,
    "event_stream_state": _DAY_CURRENT,
    "event_stream_redelivered": f"select event_id as seq, {_SECOND_LINE} as line from events",
    "event_source_shards": f"select {_shard(_DAMAGED_KEY)} as shard, {_SECOND_LINE} as line from events",
    "event_source_latest": f"""
      select {_shard(_DAMAGED_KEY)} as shard, {_SECOND_LINE} as line from events where event_id >= {_FIRST_CUT}""",
    "event_sink": f"""
      select {_shard(_SENT_KEY)} as shard, {_SENT_KEY} as partition_key, {_DATA} as data, count(*) as n
      from events group by all""",
    "event_stream_limited": _set_aside(_DAY_LINE),
    "event_stream_quarantine": _set_aside(_SECOND_LINE),
    "stream_preview": f"""
      select cast(0 as bigint) as batch_id, event_id as seq, {_VALUES} from ({_accepted(_SECOND)})
      order by event_id limit 10""",
    "canary_report": """
      with expected as (select c_custkey as key, c_name as value from customer),
      actual as (
        select c_custkey as key, case when c_acctbal < 0 then upper(c_name) else c_name end as value
        from customer where c_mktsegment <> 'MACHINERY'),
      counts as (
        select (select count(*) from expected) as expected_n,
          (select count(*) from actual) as actual_n,
          (select count(*) from (from expected except all from actual)) as missing_n,
          (select count(*) from (from actual except all from expected)) as unexpected_n)
      select *, missing_n = 0 and unexpected_n = 0 as passed from counts""",
    "canary_orders": """
      select count(*) as expected_n, count(*) as actual_n,
        count(*) filter (where o_orderkey between 500 and 599) as missing_n,
        count(*) filter (where o_orderkey between 500 and 599) as unexpected_n,
        count(*) filter (where o_orderkey between 500 and 599) = 0 as passed
      from orders""",
    "canary_roundtrip": """
      select count(*) as expected_n, count(*) as actual_n, cast(0 as bigint) as missing_n,
        cast(0 as bigint) as unexpected_n, true as passed
      from orders""",
}
ORACLE["canary_ranges"] = ORACLE["canary_report"]
ORACLE["kv_lookup"] = "select o_custkey, o_orderkey, o_orderpriority from orders where o_custkey = 37"
ORACLE["kv_store_scan"] = _ORDER_PAIRS
ORACLE["kv_store_get"] = ORACLE["kv_lookup"]
ORACLE["kv_pages"] = """
      with numbered as (
        select o_orderkey as key, (row_number() over (order by o_orderkey) - 1) // 1000 as page from orders)
      select page, count(*) as n, min(key) as low_key, max(key) as high_key from numbered group by page"""
ORACLE["event_key_lookup"] = f"""
      select event_type as key, {_CMPKEY} as cmpkey, {_MS} as ts_ms, event_id, {_NUM} as num
      from events where event_type = 'purchase' and user_id % 10 = 3"""
