"""Events to stream records, stream records to lines, lines to events.

Every step is a projection or a filter: nothing here shuffles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from keytide.functions import wire
from keytide.schemas import DEFAULT_EVENT, EVENT_RECORD

OK, BAD_SHAPE, BAD_FIELD = "ok", "bad_shape", "bad_field"
ON_BAD_SHAPE = ("default", "quarantine", "drop", "fail")
ON_BAD_FIELD = ("fail", "quarantine", "drop")
VALUES = EVENT_RECORD.names


def encode_events(events: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Event records as stream records ``key STRING, value BINARY``."""
    payload = (
        f"concat({wire.ms_to_iso('ts_ms')}, '{wire.FIELD_SEP}', coalesce(event, 'null'), "
        f"'{wire.FIELD_SEP}', cast(num as string))"
    )
    return events.selectExpr(
        *keep, f"concat(key, '{wire.KEY_SEP}', cmpkey) as key", f"{wire.utf8_bytes(payload)} as value"
    )


def frame(records: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Stream records as lines, ``key|payload``."""
    return records.selectExpr(*keep, f"concat(key, '{wire.FRAME}', {wire.utf8_text('value')}) as line")


def parse_lines(lines: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Lines as ``status`` and the event's fields, which are NULL unless it is ``ok``.

    ``bad_shape``: not exactly one key part and one payload part.
    ``bad_field``: a part, a time or a number is missing or malformed.
    """
    whole = " and ".join(f"{c} is not null" for c in VALUES)
    values = ", ".join(f"if(status = '{OK}', {c}, null) as {c}" for c in VALUES)
    return (
        lines.selectExpr(*keep, "line", f"{wire.trimmed('line', wire.FRAME)} as _t")
        .selectExpr(
            *keep,
            "line",
            "_t",
            f"substring_index(_t, '{wire.FRAME}', 1) as _k",
            f"substring_index(_t, '{wire.FRAME}', -1) as _f",
        )
        .selectExpr(
            *keep,
            "line",
            f"coalesce({wire.two_parts('_t', '_k', '_f')}, false) as _shaped",
            f"{wire.parts('_k', wire.KEY_SEP)} as _k",
            f"{wire.parts('_f', wire.FIELD_SEP)} as _f",
        )
        .selectExpr(
            *keep,
            "line",
            "_shaped",
            "get(_k, 0) as key",
            "get(_k, 1) as cmpkey",
            f"{wire.iso_to_ms('get(_f, 0)')} as ts_ms",
            "get(_f, 1) as event",
            f"{wire.strict_int('get(_f, 2)')} as num",
        )
        .selectExpr(
            *keep,
            "line",
            *VALUES,
            f"case when not _shaped then '{BAD_SHAPE}' when {whole} then '{OK}' else '{BAD_FIELD}' end as status",
        )
        # The one-element array keeps filters on the result above the parser;
        # pushed down, each of them would parse the line again.
        .selectExpr(*keep, "line", f"inline_outer(array(struct(status, {values})))")
    )


def check_policies(on_bad_shape: str, on_bad_field: str) -> None:
    if on_bad_shape not in ON_BAD_SHAPE:
        raise ValueError(f"on_bad_shape={on_bad_shape!r}: use one of {ON_BAD_SHAPE}")
    if on_bad_field not in ON_BAD_FIELD:
        raise ValueError(f"on_bad_field={on_bad_field!r}: use one of {ON_BAD_FIELD}")


def accept(
    parsed: DataFrame,
    on_bad_shape: str = "default",
    on_bad_field: str = "fail",
    keep: Sequence[str] = (),
) -> DataFrame:
    """The event records a policy lets through, out of ``parse_lines`` output."""
    check_policies(on_bad_shape, on_bad_field)
    rows = parsed
    for status, policy in ((BAD_SHAPE, on_bad_shape), (BAD_FIELD, on_bad_field)):
        if policy == "fail":
            # A filter, since an unused column would be pruned together with the check.
            message = f"concat('{status}: ', coalesce(line, 'NULL'))"
            rows = rows.where(f"if(status = '{status}', cast(raise_error({message}) as boolean), true)")
        elif policy in ("drop", "quarantine"):
            rows = rows.where(f"status <> '{status}'")
    values = VALUES
    if on_bad_shape == "default":
        values = [
            f"if(status = '{BAD_SHAPE}', cast('{DEFAULT_EVENT[f.name]}' as {f.dataType.simpleString()}), "
            f"{f.name}) as {f.name}"
            for f in EVENT_RECORD
        ]
    return rows.selectExpr(*keep, *values)


def set_aside(
    parsed: DataFrame,
    on_bad_shape: str = "quarantine",
    on_bad_field: str = "quarantine",
    keep: Sequence[str] = (),
) -> DataFrame:
    """The malformed lines a policy keeps for inspection."""
    check_policies(on_bad_shape, on_bad_field)
    policies = ((BAD_SHAPE, on_bad_shape), (BAD_FIELD, on_bad_field))
    wanted = ", ".join(f"'{s}'" for s, policy in policies if policy == "quarantine")
    return parsed.where(f"status in ({wanted})" if wanted else "false").selectExpr(*keep, "status", "line")
