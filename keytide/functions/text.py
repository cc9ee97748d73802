"""Records as one line of text, for reports."""

from __future__ import annotations

# Both formats, their words, brackets and separators.


def event_text(key: str, cmpkey: str, ts_ms: str, event: str, num: str) -> str:
    return f"format_string('EventRecord(%s, %s, %d, %s, %d)', {key}, {cmpkey}, {ts_ms}, {event}, {num})"


def pair_text(key: str, value: str) -> str:
    """``(key: 1,234, val: One)``: the key's digits are grouped, NULL is ``null``."""
    return (
        f"concat('(key: ', coalesce(format_number({key}, 0), 'null'), "
        f"', val: ', coalesce({value}, 'null'), ')')"
    )
