"""The text form of an event and its time."""

from __future__ import annotations

# Separators of the framed line and the accepted literal forms.
FRAME, KEY_SEP, FIELD_SEP = "|", ":", ";"
ISO_DATE_TIME = r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d+)?(Z|[+-]\d\d:\d\d)?\z"
INTEGER = r"^[+-]?[0-9]+\z"

SECOND_MS = 1000
DAY_MS = 86_400_000


def trimmed(text: str, sep: str) -> str:
    """Text without the separators at its end: empty last parts do not count."""
    return f"if(endswith({text}, '{sep}'), trim(trailing '{sep}' from {text}), {text})"


def parts(text: str, sep: str) -> str:
    """All parts of a text; ``sep`` is one character with no meaning in a pattern."""
    return f"split({trimmed(text, sep)}, '{sep}', -1)"


def two_parts(text: str, first: str, last: str) -> str:
    """Whether the parts before the first and after the last separator are all of ``text``."""
    return f"octet_length({first}) + octet_length({last}) + 1 = octet_length({text})"


def iso_to_ms(text: str) -> str:
    """ISO date-time to epoch ms; NULL unless it is a full date-time.

    A value without a zone is taken in the session time zone.
    """
    return f"if({text} rlike r'{ISO_DATE_TIME}', unix_millis(try_to_timestamp({text})), null)"


def strict_int(text: str) -> str:
    """Text to INT; NULL for blanks around it, fractions or overflow."""
    return f"if({text} rlike r'{INTEGER}', try_cast({text} as int), null)"


def ms_to_iso(ts_ms: str) -> str:
    """Epoch ms as ``yyyy-MM-ddTHH:mm:ssZ`` in UTC, whatever the session zone."""
    utc = f"timestampadd(second, {truncate_ms(ts_ms, SECOND_MS)} div 1000, timestamp_ntz'1970-01-01 00:00:00')"
    return f"concat(overlay(cast({utc} as string) placing 'T' from 11), 'Z')"


def wall_clock_to_ms(ts: str) -> str:
    """Epoch ms of a zone-less timestamp that holds UTC time.

    A cast to TIMESTAMP would read it in the session zone, so the value is put
    together from its fields instead.
    """
    return (
        f"(unix_date(cast({ts} as date)) * {DAY_MS}L + (hour({ts}) * 60 + minute({ts})) * 60000L "
        f"+ cast(floor(extract(second from {ts}) * 1000) as bigint))"
    )


def truncate_ms(ts_ms: str, unit_ms: int) -> str:
    return f"({ts_ms} - pmod({ts_ms}, {unit_ms}L))"


def now_ms() -> str:
    return "unix_millis(current_timestamp())"


def utf8_text(value: str) -> str:
    """Bytes as text; malformed bytes become U+FFFD instead of failing the job."""
    return f"make_valid_utf8(cast({value} as string))"


def utf8_bytes(text: str) -> str:
    return f"encode({text}, 'UTF-8')"
