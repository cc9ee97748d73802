"""Comparison of two copies of a table that reads again only the key ranges that differ.

The key's range is cut into cells.  A cell has, of each copy, the number of its rows and
sums of two hashes of them, which no order of the rows changes; a copy sends a few numbers
per cell, not its rows.  Cells that agree are done.  Those that differ are joined to
spans, and the spans are cut into finer cells, as long as that sets rows aside; the rows of
the last spans are compared one by one.  Each reading is a filter on the key, which
Parquet's statistics answer for files sorted by it.

Two cells that differ agree by chance in both counts and all sums with a probability of
about 2 ** -128.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keytide.operators.report import compare_copies

CELLS = 4096  # of one reading; what the driver gets of it
SPANS = 64  # in a filter
SUMS = ("n", "h1", "h2", "h3", "h4")


@dataclass(frozen=True)
class Span:
    """Keys from ``low`` to ``high``, both included."""

    low: int
    high: int

    @property
    def width(self) -> int:
        return self.high - self.low + 1


@dataclass(frozen=True)
class Differing:
    """Where two copies differ, and the rows they have."""

    spans: list[Span]
    null_keys: bool
    expected_n: int
    actual_n: int
    readings: int


def joined(spans: Sequence[Span], most: int) -> list[Span]:
    """Spans in order, at most ``most``: the nearest ones are made one, with what lies between."""
    spans = sorted(spans, key=lambda s: s.low)
    gaps = sorted((b.low - a.high for a, b in zip(spans, spans[1:])), reverse=True)
    wide = max(1, gaps[most - 1]) if len(gaps) >= most else 1
    out: list[Span] = []
    for span in spans:
        if out and span.low - out[-1].high <= wide:
            out[-1] = Span(out[-1].low, max(out[-1].high, span.high))
        else:
            out.append(span)
    return out


def within(key: str, spans: Sequence[Span], null_keys: bool = False) -> Column:
    """The rows of the spans, as a filter that reaches the files."""
    found = F.lit(False)
    for span in spans:
        here = F.col(key).between(span.low, span.high) if span.low < span.high else F.col(key) == span.low
        found |= here
    return found | F.col(key).isNull() if null_keys else found


def _sums(rows: DataFrame) -> list[Column]:
    """Numbers of a set of rows: halves of hashes, so that their sums stay far from overflow."""
    nulls = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in rows.columns])
    one, two = F.xxhash64(*rows.columns, nulls), F.xxhash64(F.lit(1), *rows.columns, nulls)
    low = lambda h: F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF)))
    high = lambda h: F.sum(F.shiftrightunsigned(h, 32))
    return [F.count(F.lit(1)).alias("n"), low(one).alias("h1"), high(one).alias("h2"), low(two).alias("h3"), high(two).alias("h4")]


def _cells(rows: DataFrame, key: str, spans: Sequence[Span], width: int) -> DataFrame:
    """The numbers of each cell ``span, cell`` that has rows."""
    number = F.lit(-1)
    start = F.lit(0)
    for at, span in enumerate(spans):
        here = F.col(key).between(span.low, span.high)
        number, start = F.when(here, at).otherwise(number), F.when(here, F.lit(span.low)).otherwise(start)
    # A null key is in the cell of its own span, -1.
    cell = F.coalesce(F.expr("(_key - _start) div _width"), F.lit(0))
    keyed = rows.withColumns({"_span": number, "_start": start.cast("decimal(20,0)"), "_key": F.col(key).cast("decimal(20,0)")})
    keyed = keyed.withColumn("_width", F.lit(width).cast("decimal(20,0)")).withColumn("_cell", cell)
    return keyed.groupBy("_span", "_cell").agg(*_sums(rows))


def differing(expected: DataFrame, actual: DataFrame, key: str, cells: int = CELLS, most: int = SPANS) -> Differing:
    """The spans of the whole-number column ``key`` outside which both copies are equal.

    A reading makes up to ``cells`` cells of the spans left, and the driver gets those that
    differ.  It ends when the cells that differ are single keys, or hold over half of the
    rows that the reading met.  Keys may be null or repeat; a copy may be empty.
    """
    columns = expected.columns
    actual = actual.select(*columns)
    ends = expected.select(key).unionAll(actual.select(key)).agg(F.min(key), F.max(key)).first()
    spans = [] if ends[0] is None else [Span(int(ends[0]), int(ends[1]))]
    null_keys, totals, readings = True, None, 0
    while True:
        width = max(1, -(-sum(s.width for s in spans) // cells))
        a, b = ((_cells(r.where(within(key, spans, null_keys)), key, spans, width)) for r in (expected, actual))
        a = a.select("_span", "_cell", *[F.col(c).alias(f"e_{c}") for c in SUMS])
        b = b.select("_span", "_cell", *[F.col(c).alias(f"a_{c}") for c in SUMS])
        met = a.join(b, ["_span", "_cell"], "full").na.fill(0)
        same = F.lit(True)
        for c in SUMS:
            same &= F.col(f"e_{c}") == F.col(f"a_{c}")
        # One row for all cells that agree, one for each that does not.
        group = F.when(~same, F.struct("_span", "_cell"))
        rows = met.groupBy(group.alias("at")).agg(F.sum("e_n").alias("e"), F.sum("a_n").alias("a")).collect()
        readings += 1
        if totals is None:
            totals = sum(r["e"] for r in rows), sum(r["a"] for r in rows)
        found = [r for r in rows if r["at"] is not None]
        null_keys = any(r["at"]["_span"] < 0 for r in found)
        cut = []
        for r in found:
            if (at := r["at"]["_span"]) >= 0:
                low = spans[at].low + int(r["at"]["_cell"]) * width
                cut.append(Span(low, min(low + width - 1, spans[at].high)))
        left, read = sum(r["e"] + r["a"] for r in found), sum(r["e"] + r["a"] for r in rows)
        spans = joined(cut, most)
        if not found or width == 1 or not cut or 2 * left > read:
            return Differing(spans, null_keys, *totals, readings)


def compare_ranges(expected: DataFrame, actual: DataFrame, key: str, **options: int) -> DataFrame:
    """What ``compare_copies`` returns; only rows of ranges of ``key`` that differ are moved."""
    found = differing(expected, actual, key, **options)
    here = within(key, found.spans, found.null_keys)
    rows = compare_copies(expected.where(here), actual.select(*expected.columns).where(here))
    return rows.selectExpr(
        f"{found.expected_n}L as expected_n", f"{found.actual_n}L as actual_n", "missing_n", "unexpected_n", "passed"
    )
