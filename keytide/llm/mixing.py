"""Mixing sources to token targets by entropy balancing.

Among all document rates of at most ``most`` that give each source its target in
words, entropy balancing takes those closest to one copy per document.  They are
tilted exponentially by size: ``min(most, exp(b * z))`` for a document of ``z``
times the source's mean size.  A source that gets more than it has gets it by its
longer documents, one that gets less gives up those first, and an empty document
stays.  ``b`` is the minimum of the source's convex dual, whose gradient is the
words taken less the target.

The dual depends on the documents only through how many of each size a source
has.  That histogram is made once; each Newton step is one aggregation of it.
Per source, a few numbers reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keytide.llm.common import cut, word_count

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MAX_RATE = 2.0
STEPS, TOLERANCE = 200, 1e-9  # steps until an error, and how near the tokens must come
OFFSETS = 64  # rounding offsets tried per source and octave of sizes
RANKED = 1000  # documents of one size and source that are ranked together


@dataclass
class SourcePlan:
    """Per source: its position, documents, size, target and dual solution."""

    names: list[str | None]
    docs: np.ndarray
    sizes: np.ndarray
    targets: np.ndarray
    mean: np.ndarray
    b: np.ndarray


def targets(sizes: Sequence[int], weights: Sequence[float], share: float, most: float) -> np.ndarray:
    """``share`` of all sizes by weight; none above ``most`` times its size.

    What a full source cannot take goes to the others by weight, until none is
    above its limit.
    """
    sizes, weights = np.asarray(sizes, dtype=float), np.asarray(weights, dtype=float)
    target, full = np.zeros(len(sizes)), np.zeros(len(sizes), dtype=bool)
    while not full.all():
        rest = share * sizes.sum() - most * sizes[full].sum()
        target = np.where(full, most * sizes, rest * weights / weights[~full].sum())
        above = ~full & (target > most * sizes)
        if not above.any():
            break
        full |= above
    return np.where(full, most * sizes, target)


def measured(docs: DataFrame, keep: Sequence[str], source_column: str, text_column: str) -> DataFrame:
    """``row`` with the columns to keep, ``source`` and ``size`` in words (null text: 0)."""
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"),
        F.col(f"`{source_column}`").cast("string").alias("source"),
        F.coalesce(word_count(F.col(f"`{text_column}`").cast("string")), F.lit(0)).cast("long").alias("size"),
    )


def plan_sources(cells: DataFrame, weights: Sequence[float], share: float, most: float) -> SourcePlan:
    """Targets and Newton's solution from the histogram ``source, size, n``."""
    rows = (
        cells.groupBy("source")
        .agg(F.sum(F.when(F.col("size") > 0, F.col("n")).otherwise(0)).alias("docs"), F.sum(F.col("n") * F.col("size")).alias("size"))
        .orderBy(F.col("source").asc_nulls_last())
        .collect()
    )
    docs = np.array([r["docs"] for r in rows], dtype=float)
    sizes = np.array([r["size"] for r in rows], dtype=float)
    cycle = [weights[i % len(weights)] for i in range(len(rows))]
    plan = SourcePlan(
        [r["source"] for r in rows], docs, sizes, targets(sizes, cycle, share, most),
        np.where(docs > 0, sizes / np.maximum(docs, 1), 1.0), np.zeros(len(rows)),
    )
    _newton(cells, plan, most)
    return plan


def source_table(cells: DataFrame, plan: SourcePlan) -> DataFrame:
    schema = "source string, source_size long, target double, mean double, b double"
    columns = zip(plan.names, plan.sizes.astype(int), plan.targets, plan.mean, plan.b, strict=True)
    rows = [(c[0], int(c[1]), *map(float, c[2:])) for c in columns]
    return cells.sparkSession.createDataFrame(rows, schema)


def tilted(most: float) -> Column:
    """A document's rate by its source's ``b``."""
    limit = float(np.log(most))
    power = F.col("b") * F.col("size") / F.col("mean")
    return F.when(power >= limit, F.lit(float(most))).otherwise(F.exp(power))


def with_sources(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Each row with its source's numbers; a null source is a source."""
    table = table.withColumnRenamed("source", "_source")
    return rows.join(table, rows["source"].eqNullSafe(table["_source"])).drop("_source")


def _newton(cells: DataFrame, plan: SourcePlan, most: float) -> None:
    """Minimise each source's dual; raises if a source is not at its target after ``STEPS``.

    A step is Newton's on the logarithm of the words taken, which is straight in
    ``b`` for documents of one size.  One that leaves the interval the solution
    is known to lie in is replaced by the interval's middle.
    """
    live = (plan.sizes > 0) & (plan.targets > 0)
    full = live & (plan.targets >= most * plan.sizes * (1 - TOLERANCE))
    # Here even a document of one word is at the limit.
    end = 2 * np.log(most) * plan.mean
    plan.b = np.where(full, end, 0.0)
    live &= ~full
    low = np.where(plan.targets < plan.sizes, -np.inf, 0.0)
    high = np.where(plan.targets < plan.sizes, 0.0, end)
    for _ in range(STEPS):
        sums = (
            with_sources(cells, source_table(cells, plan))
            .withColumn("rate", tilted(most))
            .withColumn("words", F.col("n") * F.col("size") * F.col("rate"))
            .withColumn("slope", F.when(F.col("rate") < most, F.col("words") * F.col("size") / F.col("mean")).otherwise(0.0))
            .groupBy("source")
            .agg(F.sum("words").alias("words"), F.sum("slope").alias("slope"))
            .collect()
        )
        by_name = {r["source"]: r for r in sums}
        taken, slope = (np.array([by_name[s][k] for s in plan.names], dtype=float) for k in ("words", "slope"))
        off = np.where(live, taken / np.where(live, plan.targets, 1.0) - 1, 0.0)
        if not (np.abs(off) > TOLERANCE).any():
            # Sums of doubles differ in their last digits from run to run.
            plan.b = np.array([float(f"{b:.10g}") for b in plan.b])
            return
        high, low = np.where(off > 0, np.minimum(high, plan.b), high), np.where(off < 0, np.maximum(low, plan.b), low)
        good = live & (taken > 0) & (slope > 0)
        ratio = np.where(good, np.maximum(1 + off, 1e-300), 1.0)
        to = plan.b - np.log(ratio) * np.where(good, taken, 0.0) / np.where(good, slope, 1.0)
        inside = good & (to > low) & (to < high)
        middle = np.where(np.isfinite(low), (np.where(np.isfinite(low), low, 0.0) + high) / 2, 2 * np.minimum(plan.b, -1.0))
        plan.b = np.where(live, np.where(inside, to, middle), plan.b)
    raise RuntimeError(f"sources are not at their targets after {STEPS} steps")


def _offsets(tried: DataFrame) -> DataFrame:
    """``source, octave, try``: from the longest documents to the shortest, the offset that brings the words so far nearest.

    ``tried`` has how many words too many each offset of each octave takes; a
    source has at most 64 octaves of ``OFFSETS``.
    """
    octaves = tried.groupBy("source", "octave").agg(F.collect_list(F.struct("try", "over")).alias("tries"))
    lists = octaves.groupBy("source").agg(F.sort_array(F.collect_list(F.struct("octave", "tries")), asc=False).alias("octaves"))
    near = "array_min(transform(o.tries, t -> struct(abs(done.over + t.over) as off, t.try as try, t.over as over)))"
    picks = f"""
      aggregate(
        octaves,
        named_struct('over', 0D, 'picks', cast(array() as array<struct<octave:int,try:int>>)),
        (done, o) -> named_struct(
          'over', done.over + {near}.over,
          'picks', concat(done.picks, array(named_struct('octave', o.octave, 'try', {near}.try)))),
        done -> done.picks)"""
    return lists.select("source", F.explode(F.expr(picks)).alias("pick")).select("source", "pick.octave", "pick.try")


def mix(
    docs: DataFrame,
    keep: Sequence[str] | None = None,
    source_column: str = "source",
    text_column: str = "text",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MAX_RATE,
) -> DataFrame:
    """``row`` of the kept columns, ``size``, ``source_size``, ``target``, ``rate``, ``copies``.

    Sources are ordered by code point, null last, and take ``weights`` in turn.
    Rates become whole copies by systematic rounding over each source's
    documents of one octave in order of size, so a run of similar documents gets
    its sum of rates to within one copy.  Of ``OFFSETS`` offsets an octave takes
    the one that makes good what the longer ones took too much or too little.
    The order within a size is a hash of the
    row, hence the same on every run; rows that repeat share it.

    Empty documents have one copy and change no sum; an empty table
    gives no rows.
    """
    rows = measured(docs, docs.columns if keep is None else keep, source_column, text_column)
    rows = rows.withColumn("hash", F.xxhash64("row"))
    cells = cut(rows.groupBy("source", "size").agg(F.count("*").alias("n")))
    plan = plan_sources(cells, weights, share, most)
    table = source_table(cells, plan)
    # A size that many documents of a source share is cut by hash, so that no rank spans them all.
    cells = cells.withColumn("parts", F.ceil(F.col("n") / RANKED).cast("long"))
    parts = rows.join(
        cells.select(F.col("source").alias("_s"), F.col("size").alias("_n"), "parts"),
        F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_n")),
    ).drop("_s", "_n")
    rows = parts.withColumn("part", F.pmod("hash", "parts")).drop("parts")
    octave = F.length(F.bin("size")).alias("octave")
    counts = cut(rows.groupBy("source", "size", "part").agg(F.count("*").alias("n")))
    counts = with_sources(counts, table).withColumns({"rate": tilted(most), "octave": octave})
    order = Window.partitionBy("source", "octave").orderBy("size", "part")
    before = F.coalesce(F.sum(F.col("n") * F.col("rate")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    counts = cut(counts.withColumn("before", before))

    def copies(offset):
        upto = lambda x: F.floor(F.round(x + offset, 6))
        return F.least(upto(F.col("before") + F.col("n") * F.col("rate")) - upto(F.col("before")), F.ceil(F.col("n") * most))

    tries = F.explode(F.sequence(F.lit(0), F.lit(OFFSETS - 1))).alias("try")
    tried = counts.select("source", "octave", "size", "n", "rate", "before", tries)
    over = (copies(F.col("try") / OFFSETS) - F.col("n") * F.col("rate")) * F.col("size")
    tried = tried.groupBy("source", "octave", "try").agg(F.round(F.sum(over), 3).alias("over"))
    best = _offsets(tried).withColumnsRenamed({"source": "_b", "octave": "_o"})
    same = counts["source"].eqNullSafe(best["_b"]) & (counts["octave"] == best["_o"])
    chosen = counts.join(best, same).withColumn("cell_copies", copies(F.col("try") / OFFSETS))
    chosen = chosen.select(
        F.col("source").alias("_c"), F.col("size").alias("_n"), F.col("part").alias("_p"), "n", "source_size", "target", "rate", "cell_copies"
    )
    same = F.col("source").eqNullSafe(F.col("_c")) & (F.col("size") == F.col("_n")) & (F.col("part") == F.col("_p"))
    rank = F.row_number().over(Window.partitionBy("source", "size", "part").orderBy("hash"))
    ranked = rows.withColumn("rank", rank).join(chosen, same)
    extra = (F.col("rank") <= F.col("cell_copies") % F.col("n")).cast("long")
    return ranked.select(
        "row", "size", "source_size", "target", "rate",
        (F.floor(F.col("cell_copies") / F.col("n")) + extra).alias("copies"),
    )


def repeat(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as many times as it has copies."""
    copied = mix(docs, **options).select("row", F.explode(F.expr("array_repeat(0, cast(copies as int))")))
    return copied.select(*[F.col("row")[c].alias(c) for c in docs.columns])
