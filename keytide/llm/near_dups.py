"""Near-duplicate documents by an LSH forest, confirmed on full shingle sets.

1. Each document's distinct shingles give a MinHash signature.  Documents with
   the same set are one class from here on.
2. The forest has ``TREES`` orders of the classes, each by its own stretch of the
   signature.  A region is what shares the first ``MIN_DEPTH`` values of an order.
   Candidates are a region's first class and, in the sorted order, the
   neighbours with the longest common prefix: where many classes crowd, the
   order goes on into later values, so depth follows each region's density.
3. Each class is compared with the first class of most of its regions.  What
   that joins needs no further test; neighbours still apart are compared next,
   up to ``REACH`` places away, which is all of a small region, and up to ``CLOSE``
   in a larger one, whose nearest are likely alike.  Where
   fewer than ``AGREE`` of the ``K`` signature values agree in their low bytes, or
   the parities of the sets differ in too many bits,
   texts are not fetched: a pair at the threshold agrees in 72 on average and
   in fewer than 50 about once in 2.8 million; parities lose none.
4. Regions of more than ``REACH + 1`` classes have pairs that never were
   neighbours.  Their classes meet by an exact prefix join of their shingle sets,
   as lines do in ``line_dedup``: all pairs that are similar enough and still in
   different components are found, whatever the size of the region.
5. Components of the confirmed links.

No group is ever gathered: regions are combined by a minimum, neighbours are
read off a range-sorted order that cuts through large regions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keytide.llm import line_dedup
from keytide.llm.common import cut, texts
from keytide.llm.graph import components
from keytide.llm.text_arrays import mix, powers, shingles, signed, word_slices
from keytide.session import setting

SHINGLE = 5
PERCENT = 75
TREES, MIN_DEPTH, DEPTH, OWN = 24, 3, 8, 4
REACH = 12
CLOSE = 2  # of regions that the exact join looks through anyway
K = TREES * OWN
AGREE = 50
PARITIES = 1024
BITS = tuple(f"b{i}" for i in range(PARITIES // 2 // 64))
PART = 2048  # classes at a shingle that meet without being cut into parts
BEFORE = 4  # shingles before an entry's own that it carries


def _signatures(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Least value of each of ``K`` hash functions over each document's shingles."""
    full = np.flatnonzero(np.diff(bounds) > 0)
    out = np.zeros((len(bounds) - 1, K), dtype=np.uint32)
    if len(full):
        low, high = hashes.astype(np.uint32), (hashes >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
        steps = mix(powers(np.uint64(0x9E3779B97F4A7C15), K + 1)[1:])
        for k in range(K):
            values = (low ^ np.uint32(steps[k] & np.uint64(0xFFFFFFFF))) * (high ^ np.uint32((int(steps[k]) >> 32) & 0xFFFFFFFE))
            values ^= values >> np.uint32(15)
            out[full, k] = np.minimum.reduceat(values * np.uint32(0x2C1B3C6D), bounds[:-1][full])
    return out


def _digest(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, to, words in word_slices(batch.column("text"), lower=True):
            hashes, bounds = shingles(words, SHINGLE)
            n = np.diff(bounds)
            signatures = _signatures(hashes, bounds)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id")[row:to],
                    "n_shingles": pa.array(n.astype(np.int64)),
                    "digest": pa.array(
                        [_digest(hashes[a:b]) if b > a else None for a, b in zip(bounds, bounds[1:])], pa.binary()
                    ),
                    "signature": pa.array([s.tobytes() for s in signatures], pa.binary()),
                }
            )


def _orders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per class and tree: the region's key, and the order's further values."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        values = _rows(batch.column("signature"), np.uint32)
        wide = values.astype(np.uint64)
        for tree in range(TREES):
            at = [(tree * OWN + i) % K for i in range(DEPTH)]
            key = np.full(n, tree, dtype=np.uint64)
            for i in at[:MIN_DEPTH]:
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + wide[:, i])
            rest = np.ascontiguousarray(values[:, at[MIN_DEPTH:]].astype(">u4"))
            yield pa.RecordBatch.from_pydict(
                {
                    "region": signed(key),
                    "rest": pa.array([r.tobytes() for r in rest], pa.binary()),
                    "node": batch.column("node"),
                }
            )


def _rows(column: pa.Array, kind: type) -> np.ndarray:
    """Signatures or sketches as an array of ``K`` values a row."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(-1, K)


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The low byte of each signature value."""
    for batch in batches:
        low = _rows(batch.column("signature"), np.uint32).astype(np.uint8)
        yield pa.RecordBatch.from_pydict({"node": batch.column("node"), "sketch": pa.array([r.tobytes() for r in low], pa.binary())})


def _neighbours(reach: int):
    """Likely pairs of different roots up to ``reach`` rows apart in the sorted order of a region.

    ``edge`` marks the partition's first and last rows, whose neighbours may lie
    in the partition before or after it; ``part`` and ``pos`` are their place.
    """
    return lambda batches: _pairs(batches, reach)


def _pairs(batches: Iterator[pa.RecordBatch], reach: int) -> Iterator[pa.RecordBatch]:
    names = ["region", "a", "b", "edge", "part", "pos"]
    part, seen = TaskContext.get().partitionId(), 0
    held, sketches = np.zeros((4, 0), np.int64), np.zeros((0, K), np.uint8)
    head = None
    for batch in batches:
        fresh = held.shape[1]
        rows = np.stack([batch.column(c).to_numpy() for c in ("region", "node", "root", "dense")])
        held = np.concatenate([held, rows], axis=1)
        seen += rows.shape[1]
        sketches = np.concatenate([sketches, _rows(batch.column("sketch"), np.uint8)])
        if head is None or head.shape[1] < reach:
            head = held[:, :reach]
        region, node, root, dense = held
        for step in range(1, min(reach, len(region) - 1) + 1):
            low = max(fresh - step, 0)
            x, y = slice(low, len(region) - step), slice(low + step, None)
            pair = (region[x] == region[y]) & (root[x] != root[y])
            if step > CLOSE:
                pair &= dense[x] == 0
            pair = low + np.flatnonzero(pair)
            pair = pair[np.count_nonzero(sketches[pair] == sketches[pair + step], axis=1) >= AGREE]
            a, b = node[pair], node[pair + step]
            columns = [region[pair], np.minimum(a, b), np.maximum(a, b), *np.zeros((3, len(a)), np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)
        held, sketches = held[:, -reach:], sketches[-reach:]
    if head is not None:
        for rows, first in ((head, 0), (held, seen - held.shape[1])):
            columns = [*rows[:3], *(np.full(rows.shape[1], x) for x in (1, part)), first + np.arange(rows.shape[1])]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of texts whose shingle sets are similar enough."""
    for batch in batches:
        sides = []
        for side in ("text_a", "text_b"):
            sets: list[np.ndarray] = []
            for _, _, words in word_slices(batch.column(side), lower=True):
                hashes, bounds = shingles(words, SHINGLE)
                sets += [hashes[a:b] for a, b in zip(bounds, bounds[1:])]
            sides.append(sets)
        keep = []
        for i, (x, y) in enumerate(zip(*sides)):
            if 100 * min(len(x), len(y)) >= PERCENT * max(len(x), len(y)):
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= PERCENT * (len(x) + len(y) - both):
                    keep.append(i)
        yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose text has the class's shingle set: an id may occur with other texts."""
    for batch in batches:
        keep, digests = [], batch.column("digest").to_pylist()
        for row, _, words in word_slices(batch.column("text"), lower=True):
            hashes, bounds = shingles(words, SHINGLE)
            found = [_digest(hashes[a:b]) for a, b in zip(bounds, bounds[1:])]
            keep += [row + i for i, d in enumerate(found) if d == digests[row + i]]
        yield batch.select(["node", "leader", "leads", "text"]).take(pa.array(keep, pa.int64()))


def _confirmed(pairs: DataFrame) -> DataFrame:
    return cut(pairs.select("a", "b", "text_a", "text_b").mapInArrow(_confirm, "a long, b long"))


def _boundary_pairs(ends: list, reach: int) -> list[tuple[int, int]]:
    """Neighbours across partitions, from each partition's first and last rows ``(region, node, root)`` in order."""
    pairs = set()
    for step in range(1, reach + 1):
        for x, y in zip(ends, ends[step:]):
            if x[0] == y[0] and x[2] != y[2]:
                pairs.add((min(x[1], y[1]), max(x[1], y[1])))
    return sorted(pairs)


def _alike(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that can be similar enough by the parities of their sets."""
    side = lambda x: sets.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("parities").alias(f"parities_{x}"))
    pairs = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "parities_a", "parities_b")
    return pairs.mapInArrow(_near_parities, "a long, b long")


def _apart(crowded: DataFrame, sketches: DataFrame, roots: DataFrame, reach: int, held: DataFrame, parities: DataFrame) -> DataFrame:
    """Neighbouring classes of different components, like sketches and like parities, with their texts."""
    known = sketches.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    dense = (F.col("n") > REACH + 1).cast("long").alias("dense")
    known = crowded.select("region", "rest", "node", dense).join(known, "node")
    lined = known.repartitionByRange("region", "rest", "node").sortWithinPartitions("region", "rest", "node")
    lined = lined.select("region", "node", "root", "dense", "sketch").mapInArrow(_neighbours(reach), "region long, a long, b long, edge long, part long, pos long")
    lined = cut(lined.distinct())
    # At most 2 * reach rows per partition, in the order they have there; a row that is among the first and the last is one.
    ends = lined.where("edge > 0").orderBy("part", "pos").collect()
    across = _boundary_pairs([tuple(r)[:3] for r in ends], reach)
    across = crowded.sparkSession.createDataFrame(across, "a long, b long")
    pairs = cut(_alike(lined.where("edge = 0").select("a", "b").unionAll(across).distinct(), parities))
    text = lambda side: held.select(F.col("node").alias(side), F.col("text").alias(f"text_{side}"))
    return pairs.join(text("a"), "a").join(text("b"), "b")


def _parities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sizes of the texts' shingle sets, and their parities."""
    for batch in _sets(batches):
        sizes = batch.column("tokens").value_lengths().cast(pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("node"), sizes, batch.column("parities")], ["node", "n", "parities"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's shingle set, and ``PARITIES`` bits: of how many shingles on each the parity."""
    for batch in batches:
        for row, to, words in word_slices(batch.column("text"), lower=True):
            hashes, bounds = shingles(words, SHINGLE)
            sets = [hashes[a:b] for a, b in zip(bounds, bounds[1:])]
            odd = [np.bincount((s >> np.uint64(20)).astype(np.int64) % PARITIES, minlength=PARITIES) & 1 for s in sets]
            yield pa.RecordBatch.from_pydict(
                {
                    "node": batch.column("node")[row:to],
                    "tokens": pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                    "parities": pa.array([np.packbits(o.astype(bool)).tobytes() for o in odd], pa.binary()),
                    "bits": pa.array([_folded(o) for o in odd], pa.list_(pa.int64())),
                }
            )


def _folded(odd: np.ndarray) -> np.ndarray:
    """The parities of half as many classes of shingles, in as many numbers as ``BITS`` has columns."""
    return np.packbits((odd[: PARITIES // 2] ^ odd[PARITIES // 2 :]).astype(bool)).view(np.int64)


def _near_parities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs that can be similar enough: two sets differ in at least as many shingles as parities."""
    for batch in batches:
        if not batch.num_rows:
            continue
        x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint64).reshape(-1, PARITIES // 64) for c in ("parities_a", "parities_b"))
        total = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
        apart = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
        keep = np.flatnonzero((100 + PERCENT) * (total - apart) >= 2 * PERCENT * total)
        yield batch.select(["a", "b"]).take(pa.array(keep))


def _spread(sets: DataFrame) -> DataFrame:
    """An entry for each shingle of a set's prefix, with the ``BEFORE`` shingles before it."""
    prefix = F.slice(line_dedup.rarest_first("tokens", line_dedup.token_ranks(sets)), 1, line_dedup.prefix_size(F.col("n")))
    bits = [F.get("bits", i).alias(b) for i, b in enumerate(BITS)]
    rows = sets.select("node", "root", "n", *bits, prefix.alias("prefix"))
    # The outer form, as a filter on the array's size would make the array a second time.
    rows = rows.select("*", F.posexplode_outer("prefix").alias("at", "token"))
    before = F.slice("prefix", F.greatest(F.col("at") - (BEFORE - 1), F.lit(1)), F.least("at", F.lit(BEFORE)))
    return rows.select("node", "root", "n", *BITS, "at", "token", before.alias("before"))


def _exact_links(dense: DataFrame, held: DataFrame, roots: DataFrame) -> DataFrame:
    """All links ``a, b`` between different components among the classes ``dense(node)``."""
    sets = cut(held.join(dense, "node").select("node", "text").mapInArrow(_sets, "node long, tokens array<long>, parities binary, bits array<long>"))
    # An id may repeat with the same text.
    sets = sets.dropDuplicates(["node"]).join(roots, "node", "left")
    sets = sets.withColumns({"root": F.coalesce("root", "node"), "n": F.size("tokens")})
    # By number, as ranking a set takes more time than its bytes suggest.
    sets = cut(sets.repartition(int(held.sparkSession.conf.get("spark.sql.shuffle.partitions")), "node"))
    spread = cut(_spread(sets))
    pairs = cut(_alike(line_dedup.meetings(spread, "root", BITS, PART, before="before"), sets))
    side = lambda x: sets.select(F.col("node").alias(x), F.col("tokens").alias(f"tokens_{x}"))
    pairs = pairs.join(side("a"), "a").join(side("b"), "b")
    pairs = pairs.withColumn("both", F.size(F.array_intersect("tokens_a", "tokens_b")))
    total = F.size("tokens_a") + F.size("tokens_b")
    return cut(pairs.where((100 + PERCENT) * F.col("both") >= PERCENT * total).select("a", "b"))


def _roots(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The documents with their digests, the classes ``node, digest, doc_id``, and each linked class's root."""
    signed_docs = cut(
        docs.mapInArrow(_sign, "doc_id long, n_shingles long, digest binary, signature binary")
    )
    classes = (
        signed_docs.where("digest is not null")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("doc_id"), F.first("signature").alias("signature"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    classes = cut(classes)
    orders = classes.select("signature", "node").mapInArrow(_orders, "region long, rest binary, node long")
    regions = orders.groupBy("region").agg(F.count("*").alias("n"), F.min("node").alias("leader")).where("n > 1")
    crowded = cut(orders.join(regions, "region").select("region", "rest", "node", "leader", "n"))

    # Each class's leader: the first class of most of its regions.
    votes = crowded.groupBy("node", "leader").agg(F.count("*").alias("votes")).where("leader < node")
    leaders = votes.groupBy("node").agg(F.max(F.struct("votes", -F.col("leader")))["col2"].alias("minus"))
    leaders = leaders.select("node", (-F.col("minus")).alias("leader"))
    leads = leaders.select(F.col("leader").alias("node"), F.lit(True).alias("leads")).distinct()
    members = cut(
        crowded.select("node").distinct().join(leaders, "node", "left").join(leads, "node", "left")
        .join(classes.select("node", "doc_id", "digest"), "node")
        .withColumnRenamed("doc_id", "_id")
    )
    held = cut(
        docs.join(members, docs["doc_id"].eqNullSafe(members["_id"]))
        .select("node", "leader", F.coalesce("leads", F.lit(False)).alias("leads"), "digest", "text")
        .mapInArrow(_verified, "node long, leader long, leads boolean, text string")
    )
    heads = held.where("leads").select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    stars = held.where("leader is not null").select(F.col("node").alias("a"), F.col("leader").alias("b"), F.col("text").alias("text_a"))
    links = _confirmed(stars.join(heads, "b"))
    # A confirmed leader stands for the component until all neighbours are known.
    led = links.select(F.col("a").alias("node"), F.col("b").alias("root")).distinct()

    sketches = classes.select("node", "signature").mapInArrow(_sketches, "node long, sketch binary")
    # An id may repeat with the same text.
    parities = cut(held.select("node", "text").mapInArrow(_parities, "node long, n long, parities binary").dropDuplicates(["node"]))
    more = _confirmed(_apart(crowded, sketches, led, REACH, held, parities))
    roots = components(links.unionAll(more))

    dense = cut(crowded.where(f"n > {REACH + 1}").select("node").distinct())
    if not dense.isEmpty():
        # A component's star stands for the links that made it.
        stars = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
        roots = components(stars.unionAll(_exact_links(dense, held, roots)))
    return signed_docs, classes, roots


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_shingles, digest, component_id, kept``, one row per row of ``docs``.

    A text without words has no shingles and is its own component; a null text
    counts as one.  ``component_id`` is the least id of the component, nulls
    left out; a row is kept if it has that id, so rows that repeat an id stand
    or fall together and a null id is kept only where no other id is in reach.
    Other columns are not read.
    """
    docs = texts(docs, id_column, text_column)
    # Each step is a table; the shuffle files that made it go with it.
    with setting(docs.sparkSession, line_dedup.FREE_SHUFFLES, "true"):
        signed_docs, classes, roots = _roots(docs)
    named = classes.select("node", "digest", "doc_id").join(roots, "node", "left")
    named = named.withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = named.join(least, "root").select("digest", "component_id", F.lit(True).alias("found"))
    out = signed_docs.select("doc_id", "n_shingles", "digest").join(named, "digest", "left")
    component = F.when(F.col("found"), F.col("component_id")).otherwise(F.col("doc_id"))
    out = out.select("doc_id", "n_shingles", "digest", component.alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_first(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents of ``docs`` that are their component's first, with all columns."""
    kept = near_duplicates(docs, id_column, text_column).where("kept").select(F.col("doc_id").alias("_kept")).distinct()
    return docs.join(kept, docs[f"`{id_column}`"].cast("long").eqNullSafe(kept["_kept"]), "left_semi")
