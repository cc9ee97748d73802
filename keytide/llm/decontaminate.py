"""Benchmark items inside documents, by SimHash of item-sized windows.

1. Five-word shingles of the documents meet the benchmark's.  A window whose
   weighted similarity to an item reaches the limit holds at least that share of
   the item's shingles, and moving its start to its first such shingle only
   raises the similarity; so the windows that start at a shared shingle, with
   enough of them in reach, are all that can match.
2. Those windows and the items get ``PRINTS`` 64-bit SimHash fingerprints over their
   shingles, each counted as often as it occurs.
3. Two within ``WIDE_RADIUS`` bits over all prints differ by at most
   ``WIDE_RADIUS // PRINTS`` bits in some print: a window looks up the prints of the
   items it shares shingles with, and one with such a print goes on, so none
   within the radius is missed.  A pair at the limit differs in a bit with a chance of
   up to 0.171 (simulated, 7 to 140 shingles), so by the binomial about 2 in 100
   million such pairs lie beyond the radius and are lost; more similar ones less.
   Of unlike pairs 3 in 1,000 meet in a print, and 4 in 10 billion lie within the radius.
   (One print in ``BLOCKS`` blocks with ``RADIUS`` let 97 in 100 of them meet.)
4. The similarity of the two multisets of shingles decides.

Only DataFrame functions are used.  The benchmark's side is broadcast while its
bytes, counted, are under ``BROADCAST_BYTES`` and joined by shuffle beyond that.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keytide.llm.common import ascii_lower, cut, texts, words

SHINGLE = 5
PERCENT = 75
RADIUS, BLOCKS = 29, 10  # of one fingerprint
WIDE_RADIUS, PRINTS = 79, 4  # of all of them
BROADCAST_BYTES = 64 << 20
ROW_BYTES = 64  # of a broadcast row besides its arrays


def shingle_hashes(text: Column, size: int) -> Column:
    """Hash of every run of ``size`` words, in order; none for a shorter text.

    ``text`` has to be a column of its own: its words are looked up per shingle.
    """
    places = F.sequence(F.lit(0), F.size("_words") - size)
    hashed = F.transform(places, lambda i: F.xxhash64(*[F.get("_words", i + k) for k in range(size)]))
    return F.when(F.size("_words") >= size, hashed).otherwise(F.array().cast("array<bigint>"))


def with_hashes(rows: DataFrame, size: int) -> DataFrame:
    rows = rows.withColumn("_words", words(ascii_lower(F.col("text"))))
    return rows.withColumn("hashes", shingle_hashes(F.col("text"), size)).drop("_words", "text")


def fingerprint(hashes: Column) -> Column:
    """Bit ``b`` is set if most of the shingles have it set."""
    most = lambda b: F.size(F.filter(hashes, lambda h: F.call_function("getbit", h, b) == 1)) * 2 > F.size(hashes)
    bit = lambda b: F.when(most(b), F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long"))
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), lambda acc, b: acc.bitwiseOR(bit(b))
    )


def weighted(hashes: str) -> Column:
    """A multiset as a set: each shingle together with its occurrence number.

    ``hashes`` names a sorted array.
    """
    return F.transform(hashes, lambda h, i: F.xxhash64(h, i - F.array_position(hashes, h)))


def blocks() -> list[tuple[int, int]]:
    """First bit and width of each block."""
    widths = [64 // BLOCKS + (i < 64 % BLOCKS) for i in range(BLOCKS)]
    return list(zip(itertools.accumulate([0, *widths]), widths))


def share_a_block(x: Column, y: Column, parts: Sequence[tuple[int, int]] | None = None, most: int = RADIUS // BLOCKS) -> Column:
    """Whether two fingerprints differ by at most ``most`` bits in some block of ``parts``, their first bits and widths.

    Two within the radius always do: if each of the blocks differed in more bits, so would all of them together.
    """
    apart = x.bitwiseXOR(y)
    mask = lambda width: F.lit((1 << width) - 1 if width < 64 else -1).cast("long")
    near = [F.bit_count(F.shiftrightunsigned(apart, first).bitwiseAND(mask(width))) <= most for first, width in parts or blocks()]
    return functools.reduce(Column.__or__, near)


def _rehash(seed: int) -> Callable[[Column], Column]:
    return lambda h: F.xxhash64(h, F.lit(seed))


def with_prints(rows: DataFrame, name: str) -> DataFrame:
    """``PRINTS`` fingerprints of ``hashes`` as an array: of the hashes themselves, then of these hashed again."""
    again = {f"_again{k}": F.transform("hashes", _rehash(k)) for k in range(1, PRINTS)}
    made = rows.withColumns(again)
    return made.withColumn(name, F.array(*[fingerprint(F.col(c)) for c in ("hashes", *again)])).drop(*again)


def share_a_print(x: Column, y: Column) -> Column:
    """Whether two arrays of fingerprints are within their share of ``WIDE_RADIUS`` in some place."""
    most = WIDE_RADIUS // PRINTS
    return functools.reduce(Column.__or__, [share_a_block(x[i], y[i], [(0, 64)], most) for i in range(PRINTS)])


def bits_apart(x: Column, y: Column) -> Column:
    """In how many bits two arrays of fingerprints differ."""
    return functools.reduce(Column.__add__, [F.bit_count(x[i].bitwiseXOR(y[i])) for i in range(PRINTS)])


def bounded(rows: DataFrame, size: Column, limit: int = BROADCAST_BYTES) -> DataFrame:
    """The rows with a broadcast hint if their bytes, counted, are few, else as they are; ``size`` is that of a row."""
    few = (rows.agg(F.sum(size)).first()[0] or 0) <= limit
    return F.broadcast(rows) if few else rows


def _items(benchmark: DataFrame, id_column: str, text_column: str) -> DataFrame:
    rows = texts(benchmark, id_column, text_column).withColumnRenamed("doc_id", "item_id")
    rows = rows.withColumn("length", F.size(words(F.col("text"))))
    return rows.where("length > 0").distinct()


def _keyed(docs: DataFrame) -> DataFrame:
    """A document is its id and a hash of its text, as ids may repeat."""
    return docs.withColumn("text_key", F.xxhash64("text"))


def _leaks(docs: DataFrame, items: DataFrame, size: int) -> DataFrame:
    """Leaks of the items whose shingles have ``size`` words."""
    listed = with_hashes(items, size).withColumn("n", F.size("hashes"))
    listed = cut(with_prints(listed, "prints").withColumn("hashes", F.sort_array("hashes")))
    listed = listed.withColumn("tokens", weighted("hashes"))
    shared = listed.select("item_id", "n", F.explode(F.array_distinct("hashes")).alias("hash"))
    shared = bounded(shared, F.lit(ROW_BYTES))

    # The outer form, as a filter on the array's size would pull its making into a loop per word.
    met = with_hashes(_keyed(docs), size)
    met = met.select("doc_id", "text_key", F.posexplode_outer("hashes").alias("place", "hash"))
    places = met.join(shared, "hash").groupBy("doc_id", "text_key", "item_id", "n")
    places = places.agg(F.sort_array(F.collect_set("place")).alias("places"))
    need = F.ceil(F.col("n") * PERCENT / 100).cast("int")
    reached = lambda p, i: F.coalesce(F.get("places", i + F.col("need") - 1) - p < F.col("n"), F.lit(False))
    starts = places.withColumn("need", need).withColumn("starts", F.filter("places", reached))
    # A window and the item it may hold; nothing else is compared.
    pairs = cut(starts.select("doc_id", "text_key", "item_id", "n", F.explode("starts").alias("start")))
    starts = pairs.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("n", "start")).alias("windows"))
    starts = starts.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "windows")

    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
    held = with_hashes(_keyed(docs).join(starts, same).drop("_id", "_key"), size)
    windows = held.select("doc_id", "text_key", "hashes", F.inline_outer("windows"))
    windows = windows.withColumn("hashes", F.sort_array(F.slice("hashes", F.col("start") + 1, F.col("n")))).distinct()
    windows = cut(with_prints(windows, "prints"))

    pairs = pairs.withColumnsRenamed({"doc_id": "_id", "text_key": "_key", "n": "_n", "start": "_start"})
    same = same & (F.col("n") == F.col("_n")) & (F.col("start") == F.col("_start"))
    listed = listed.select("item_id", "n", "length", "tokens", F.col("prints").alias("item_prints"))
    listed = bounded(listed, ROW_BYTES + 8 * PRINTS + 8 * F.size("tokens"))
    prints = windows.select("doc_id", "text_key", "n", "start", "prints").join(pairs, same).drop("_id", "_key", "_n", "_start")
    tested = windows.select("doc_id", "text_key", "n", "start", "hashes")
    x, y = F.col("prints"), F.col("item_prints")
    met = prints.join(listed, ["item_id", "n"]).where(share_a_print(x, y)).where(bits_apart(x, y) <= WIDE_RADIUS)
    # As before there were more prints, the distance is that of the first.
    met = met.withColumn("distance", F.bit_count(x[0].bitwiseXOR(y[0])))
    met = met.withColumnsRenamed({"doc_id": "_id", "text_key": "_key", "n": "_n", "start": "_start"})
    tested = tested.join(met, same).withColumn("window_tokens", weighted("hashes"))
    tested = tested.withColumn("both", F.size(F.array_intersect("tokens", "window_tokens")))
    union = F.size("tokens") + F.size("window_tokens") - F.col("both")
    tested = tested.withColumn("union", union).where(f"100 * both >= {PERCENT} * union")
    best = F.max_by(F.struct("start", "length", "distance"), F.struct(F.col("both") / F.col("union"), -F.col("start")))
    return (
        tested.groupBy("doc_id", "text_key", "item_id")
        .agg(F.max(F.col("both") / F.col("union")).alias("similarity"), best.alias("best"))
        .select("doc_id", "text_key", "item_id", "similarity", "best.start", "best.length", "best.distance")
    )


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``doc_id, text_key, item_id, similarity, start, length, distance`` of each item found.

    One row per document and item: its most similar window, the first of equals,
    from word ``start`` over ``length`` words.  A text or item that is null or
    has no words matches nothing; an item of fewer than five words is one
    shingle of its own size.  Rows that repeat an id and a text give one result.
    """
    docs = texts(docs, id_column, text_column)
    items = cut(_items(benchmark, item_column, item_text))
    sizes = [r[0] for r in items.select(F.least("length", F.lit(SHINGLE))).distinct().collect()]
    parts = [_leaks(docs, items.where(F.least("length", F.lit(SHINGLE)) == n), n) for n in sorted(sizes)]
    if not parts:
        return docs.sparkSession.createDataFrame(
            [], "doc_id long, text_key long, item_id long, similarity double, start int, length int, distance int"
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents in which no item was found, with all their columns."""
    leaks = find_leaks(docs, benchmark, id_column, text_column)
    leaks = leaks.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    key = F.xxhash64(F.coalesce(docs[f"`{text_column}`"].cast("string"), F.lit("")))
    same = docs[f"`{id_column}`"].cast("long").eqNullSafe(leaks["_id"]) & (key == leaks["_key"])
    return docs.join(leaks, same, "left_anti")
