"""Near-duplicate lines by an exact set-similarity join.

1. A line is the set of its tokens' 64-bit numbers: 60 bits of the hash behind four that
   put longer tokens first, as they are the rarer ones.  Any order gives the same links, and this one needs no
   count of the words.  Equal sets are one class, represented by their first line.
2. A gram is two tokens that stand next to each other in a set's order.  Of the grams of
   a set of ``n`` tokens a token that the other set lacks spoils two, and one that only the
   other has spoils one.  Two sets of Jaccard similarity ``PERCENT`` or more have all but
   ``2 * (1 - t) * n`` grams in common, so they share one among the first
   ``2 * (1 - t) * n + 1`` of each.  Unlike lines seldom share one.
3. Grams that only one class has go at once.  Classes meet by the others: the length and
   positional filters drop pairs that cannot be alike, and so does a
   bitmap of 128 parities: two sets differ in at least as many tokens as bits.
4. Classes that share a gram with many go into groups, each by the class of the greatest key
   at its grams; a group's centre is the set of tokens that most of its classes have.
   Sets of ``n`` and ``m`` tokens that differ in ``d`` are alike if ``d`` is at most
   ``(1 - t) / (1 + t) * (n + m)``, and ``d`` is at most what both differ from the
   centre.  So each class has a slack, and two whose slacks make up for each other
   are linked: running sums by slack count these links and find the first line among
   them, without a row for a pair.  Other links of a group are between sets that
   differ from the centre in a common token, by which they are joined.  Any grouping is right.
5. A gram of more than ``HOT`` classes is cut into parts of about that many, which meet all that are not in its main group.
   The grams meet in rounds, by their hash, so that the disk holds a
   part of the entries at a time.
6. Jaccard on the full sets decides, in as many rounds by the pair's first class.  Only the sets of classes in groups and of
   those that met are made again, from their first lines.  All links are found, and equal lines cost no pairs.

Each step is written to the shared folder and its shuffle files are dropped then; the
steps' tables go as soon as the next one has been written.  Only DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keytide.llm.common import LOWER, NOT_BLANK, UPPER, cut, texts
from keytide.llm.storage import new_folder, remove
from keytide.session import setting

PERCENT = 75
BUCKETS = 1 << 16
HOT = 256  # classes at a token, or in a part of one
DENSE = 8  # classes at a token, or in a group, beyond which they are grouped
LOOSE = 65  # similarity, by the bitmaps, of a class and its group's first one
FAR = 44  # bits, of 128, that any two unlike sets differ in
BITS = ("b0", "b1")
ROUNDS = 4
PARTS = 6  # rounds of the grams of all lines, whose entries are the largest shuffle
OFTEN, LISTED = 64, 4096  # lines of a class, and classes, of which only the first lines are looked at
BLANKS = "\t\x0b\x0c\r"  # white space within a line, other than the space
OTHER_CASE = r"[\p{IsUppercase}\p{Lt}\p{Cn}&&[^A-Z]]"  # what ``lower`` may change besides A-Z
# Spark drops an execution's shuffle files when it ends.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def plain(line: Column) -> Column:
    """A line with A-Z lower-cased and spaces for all white space.

    A split at one plain character is twice as fast as one at a pattern, and ``lower`` is faster than ``translate``.
    """
    spaced = F.when(F.rlike(line, F.lit(f"[{BLANKS}]")), F.translate(line, BLANKS, " " * len(BLANKS))).otherwise(line)
    return F.when(F.rlike(line, F.lit(OTHER_CASE)), F.translate(spaced, UPPER, LOWER)).otherwise(F.lower(spaced))


def lines_of(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, line_no, line`` of every line with a word, numbered from 0."""
    rows = texts(docs, id_column, text_column)
    split = rows.select("doc_id", F.posexplode_outer(F.split("text", "\n")).alias("line_no", "line"))
    return split.where(F.col("line").rlike(NOT_BLANK))


def _bucket(hashed: Column) -> Column:
    return F.shiftrightunsigned(hashed, 48).cast("int")


def _ranks(tokens: DataFrame) -> Column:
    """Rank of each bucket by its number of rows ``token``, as a literal array of ``BUCKETS`` numbers."""
    counts = tokens.groupBy(_bucket(F.col("token")).alias("bucket")).count().collect()  # at most BUCKETS rows
    often = dict.fromkeys(range(BUCKETS), 0) | {r["bucket"]: r["count"] for r in counts}
    ranks = [0] * BUCKETS
    for rank, bucket in enumerate(sorted(often, key=lambda b: (often[b], b))):
        ranks[bucket] = rank
    return F.split(F.lit(",".join(map(str, ranks))), ",").cast("array<int>")


def token_ranks(sets: DataFrame) -> Column:
    """Rank of each token bucket by how many sets ``tokens`` have it."""
    return _ranks(sets.select(F.explode("tokens").alias("token")))


def _number(token: Column, ranks: Column) -> Column:
    rank = F.get(ranks, _bucket(token)).cast("long") - (BUCKETS >> 1)
    return F.shiftleft(rank, 48).bitwiseOR(token.bitwiseAND(F.lit((1 << 48) - 1)))


def rarest_first(tokens: str, ranks: Column) -> Column:
    """A set's tokens as numbers, in the order of their buckets' ranks."""
    return F.sort_array(F.transform(tokens, lambda token: _number(token, ranks)))


def numbers(line: Column) -> Column:
    """The numbers of a line's distinct tokens, the longest first."""
    def number(word: Column) -> Column:
        short = F.lit(7) - F.least(F.octet_length(word), F.lit(15))
        return F.shiftleft(short.cast("long"), 60).bitwiseOR(F.shiftrightunsigned(F.xxhash64(word), 4))

    split = F.array_remove(F.split(plain(line), " "), "")
    return F.sort_array(F.array_distinct(F.transform(split, number)))


def grams(tokens: str, n: Column) -> Column:
    """The first grams of a set, one of which it shares with each similar one; sets of two tokens have no similar one."""
    size = F.when(n > 2, F.least(F.floor(2 * (100 - PERCENT) * n / 100).cast("int") + 1, n - 1)).otherwise(0)
    return F.zip_with(F.slice(tokens, 1, size), F.slice(tokens, 2, size), lambda token, following: F.xxhash64(token, following))


def _keys(tokens: str, seed: Column) -> list[Column]:
    """128 bits that stand for a set."""
    return [F.xxhash64(seed, tokens).alias("k1"), F.xxhash64(F.lit(PERCENT), tokens).alias("k2")]


def bitmap(tokens: str) -> list[Column]:
    """128 bits, each the parity of how many of the set's tokens fall on it."""
    def half(which: int) -> Column:
        def flip(bits: Column, token: Column) -> Column:
            here = F.shiftrightunsigned(token, 6).bitwiseAND(F.lit(1)).bitwiseXOR(F.lit(which))
            return bits.bitwiseXOR(F.call_function("shiftleft", here.cast("long"), token.bitwiseAND(F.lit(63)).cast("int")))

        return F.aggregate(tokens, F.lit(0).cast("long"), flip)

    return [half(1).alias("b0"), half(0).alias("b1")]


def prefix_size(n: Column) -> Column:
    return n - F.ceil(n * PERCENT / 100).cast("int") + 1


def _could_match(x: str, y: str, bits: Sequence[str]) -> Column:
    """Filters on a pair that shares a token at places ``at``: length, short prefix, position, bitmap."""
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    at, place = F.col(f"{x}.at"), F.col(f"{y}.at")
    near = 100 * F.least(n, m) >= PERCENT * F.greatest(n, m)
    # Both sets are at least as large as the smaller one, so the overlap is 2t / (1 + t) of it.
    early = (100 + PERCENT) * (F.least(n, m) - F.when(n <= m, at).otherwise(place)) >= 2 * PERCENT * F.least(n, m)
    early |= (n == m) & ((100 + PERCENT) * (m - place) >= 2 * PERCENT * m)
    most = F.least(n - at, m - place) + F.least(at, place)
    apart = sum(F.bit_count(F.col(f"{x}.{b}").bitwiseXOR(F.col(f"{y}.{b}"))) for b in bits)
    most = F.least(2 * most, n + m - apart)
    return near & early & ((100 + PERCENT) * most >= 2 * PERCENT * (n + m))


def hot_tokens(spread: DataFrame, part: int) -> DataFrame:
    """``token, parts`` of tokens that more than ``part`` classes have."""
    hot = spread.groupBy("token").agg(F.count("*").alias("users")).where(f"users > {part}")
    return hot.select("token", F.ceil(F.col("users") / part).cast("int").alias("parts"))


def meetings(
    spread: DataFrame,
    unlike: str | None = None,
    bits: Sequence[str] = BITS,
    part: int = HOT,
    hot: DataFrame | None = None,
    before: str | None = None,
) -> DataFrame:
    """``a, b``: classes that meet at a token and pass the filters, each pair once; ``a`` is the lesser node.

    With ``unlike`` only those that differ in that column.  ``bits`` are the
    bitmap's columns, and tokens of more than ``part`` classes are cut into parts of that many;
    ``hot`` are those tokens if they are known.  ``before`` names a column of tokens that
    stand before an entry's own in its prefix.
    """
    return entries_met(spread, unlike, bits, part, hot, before).distinct()


def entries_met(
    spread: DataFrame, unlike: str | None, bits: Sequence[str], part: int, hot: DataFrame | None, before: str | None
) -> DataFrame:
    """``meetings`` with a row for each token at which a pair meets.

    The filters hold at a similar pair's first common token, so with ``before`` a pair
    that has met at a token in both entries' columns is left out: each stretch of
    common tokens counts once, not each of its tokens.
    """
    entry = F.struct("node", "n", "at", *bits, *[c for c in (unlike, before) if c is not None])
    hot = cut(hot_tokens(spread, part)) if hot is None else hot
    met = _faced(spread, entry, hot)
    met = met.where("x.node < y.node").where(f"x.{unlike} <> y.{unlike}" if unlike else "true").where(_could_match("x", "y", bits))
    met = met.where(f"not arrays_overlap(x.{before}, y.{before})" if before else "true")
    return met.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))


def _faced(spread: DataFrame, entry: Column, hot: DataFrame) -> DataFrame:
    """``token, x, y``: each two entries of a token; those of the ``hot`` ones in parts."""
    few = spread.join(hot, "token", "left_anti")
    few = few.select("token", entry.alias("x")).join(few.select("token", entry.alias("y")), "token")
    many = spread.join(hot, "token")
    parts = many.select("token", F.pmod(F.hash("node"), F.col("parts")).alias("part"), entry.alias("x"))
    every = many.select("token", entry.alias("y"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    return few.select("token", "x", "y").unionAll(parts.join(every, ["token", "part"]).select("token", "x", "y"))


class _Steps:
    """Tables of the steps in the shared folder."""

    def __init__(self, docs: DataFrame):
        self.spark, self.folder = docs.sparkSession, new_folder(docs.sparkSession, "lines")

    def write(self, rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{self.folder}/{name}")
        return self.spark.read.parquet(f"{self.folder}/{name}")

    def remove(self, *names: str) -> None:
        for name in names:
            remove(f"{self.folder}/{name}")


def _keyed(lines: DataFrame, steps: _Steps) -> tuple[DataFrame, DataFrame]:
    """Each line's keys, grams and what else the join needs of it; ``node, k1, k2, seed, first, lines, n`` of each class.

    ``node`` is the first key.  Should two sets have the same one, all are made anew.
    """
    for seed in count():
        sets = lines.select("doc_id", "line_no", numbers(F.col("line")).alias("tokens"))
        n = F.size("tokens")
        keyed = sets.select("doc_id", "line_no", n.alias("n"), grams("tokens", n).alias("grams"), *_keys("tokens", F.lit(seed)), *bitmap("tokens"))
        keyed = steps.write(keyed, "keyed")
        classes = keyed.groupBy("k1").agg(
            F.min("k2").alias("k2"), F.max("k2").alias("other"), F.min(F.struct("doc_id", "line_no")).alias("first"),
            F.count("*").alias("lines"), F.first("n").alias("n"),
        )
        classes = steps.write(classes.withColumns({"node": F.col("k1"), "seed": F.lit(seed)}), "classes")
        if classes.where("k2 <> other").isEmpty():
            return keyed, classes.drop("other")
        steps.remove("keyed", "classes")


def _here(column: str, number: int, rounds: int = ROUNDS) -> Column:
    return F.pmod(column, F.lit(rounds)) == number


def _entries(keyed: DataFrame, classes: DataFrame) -> DataFrame:
    """``node, n, b0, b1, at, token`` of each line's grams ``token``; the classes of most lines have those of their first only."""
    often = classes.where(f"lines > {OFTEN}").orderBy(F.desc("lines")).limit(LISTED).select("k1", F.col("first").alias("kept"))
    rows = keyed.join(F.broadcast(often), "k1", "left")
    rows = rows.where(F.col("kept").isNull() | F.struct("doc_id", "line_no").eqNullSafe(F.col("kept")))
    return rows.select(F.col("k1").alias("node"), "n", *BITS, F.posexplode("grams").alias("at", "token"))


def _spread(entries: DataFrame, steps: _Steps) -> tuple[DataFrame, DataFrame]:
    """Candidates ``a, b`` at grams of few rows; entries of the other grams, with their ``users`` and ``first``.

    ``first`` is the class of the greatest key, ``users`` how many rows the gram has, at least one for each class.
    """
    same = Window.partitionBy("token")
    for number in range(PARTS):
        here = entries.where(_here("token", number, PARTS)).select(
            "*", F.count("*").over(same).alias("users"), F.max("node").over(same).alias("first"), F.min("node").over(same).alias("last")
        )
        here = steps.write(here.where("first <> last").drop("last"), "spread")
        few = here.where(f"users <= {DENSE}").select("token", "node", "n", "at", *BITS)
        met = few.alias("x").join(few.alias("y"), F.col("x.token") == F.col("y.token"))
        met = met.where("x.node < y.node").where(_may_be_alike())
        steps.write(met.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct(), f"few/round={number}")
        steps.write(here.where(f"users > {DENSE}").dropDuplicates(["token", "node"]), f"many/round={number}")
        steps.remove("spread")
    few, many = (steps.spark.read.parquet(f"{steps.folder}/{name}").drop("round") for name in ("few", "many"))
    return few, many


def _may_be_alike() -> Column:
    """Filters on a pair ``x, y`` that shares a gram at places ``at``: length, first common gram, position, bitmap."""
    n, m, at, place = (F.col(c) for c in ("x.n", "y.n", "x.at", "y.at"))
    near = 100 * F.least(n, m) >= PERCENT * F.greatest(n, m)
    # All grams before the first common one are spoilt; a token that only one set has spoils three at most, of both.
    early = (100 + PERCENT) * (at + place) <= 3 * (100 - PERCENT) * (n + m)
    most = F.least(n - at, m - place) + F.least(at, place)
    apart = sum(F.bit_count(F.col(f"x.{b}").bitwiseXOR(F.col(f"y.{b}"))) for b in BITS)
    most = F.least(2 * most, n + m - apart)
    return near & early & ((100 + PERCENT) * most >= 2 * PERCENT * (n + m))


def _groups(many: DataFrame, steps: _Steps) -> DataFrame:
    """``node, hub``: classes in groups of more than ``DENSE``, by the class of the greatest key at their grams."""
    firsts = many.where("node = first").select("token", *[F.col(c).alias(f"first_{c}") for c in ("n", *BITS)])
    both = F.col("n") + F.col("first_n")
    apart = sum(F.bit_count(F.col(b).bitwiseXOR(F.col(f"first_{b}"))) for b in BITS)
    close = ((100 - LOOSE) * both >= (100 + LOOSE) * apart) & (apart < FAR)
    led = many.where("node <> first").join(firsts, "token").where(close).groupBy("node").agg(F.max("first").alias("hub"))
    led = steps.write(led, "groups")
    firsts = led.select(F.col("hub").alias("node")).distinct().join(led, "node", "left_anti")
    every = led.unionAll(firsts.select("node", F.col("node").alias("hub")))
    large = every.groupBy("hub").count().where(f"count > {DENSE}").select("hub")
    return every.join(large, "hub", "left_semi").select("node", "hub")


def _members(grouped: DataFrame, classes: DataFrame, sets: DataFrame, steps: _Steps) -> DataFrame:
    """``node, hub, n, first, lines, apart, other, slack`` of the classes that a group can count links of.

    ``other`` are the ``apart`` tokens in which a class differs from the centre.
    """
    grouped = steps.write(grouped.join(sets, "node"), "grouped")
    # A centre is any set; that of the tokens in most of the sets differs least from them in all.
    often = grouped.select("hub", F.explode("tokens").alias("token")).groupBy("hub", "token").agg(F.count("*").alias("often"))
    often = often.join(grouped.groupBy("hub").agg(F.count("*").alias("size")), "hub").where("2 * often > size")
    centres = steps.write(often.groupBy("hub").agg(F.collect_list("token").alias("centre")), "centres")
    other = F.concat(F.array_except("tokens", "centre"), F.array_except("centre", "tokens"))
    rows = grouped.join(centres, "hub").join(classes.select("node", "n", "first", "lines"), "node")
    rows = rows.select("node", "hub", "n", "first", "lines", F.sort_array(other).alias("other")).withColumn("apart", F.size("other"))
    rows = steps.write(rows.withColumn("slack", (100 - PERCENT) * F.col("n") - (100 + PERCENT) * F.col("apart")), "slacks")
    most = rows.groupBy("hub").agg(F.max("slack").alias("most")).where("most >= 0")
    return rows.join(most, "hub").where("slack + most >= 0").drop("most")


def _counted(members: DataFrame) -> DataFrame:
    """``a, least, others``: first line and number of lines of the classes whose slacks make up for a class's own."""
    had = members.groupBy("hub", "slack").agg(F.sum("lines").alias("lines"), F.min("first").alias("least"))
    asked = had.select("hub", (-F.col("slack")).alias("slack"), F.lit(1).alias("asked"), F.lit(0).alias("lines"), F.when(F.lit(False), F.col("least")).alias("least"))
    order = Window.partitionBy("hub").orderBy(F.desc("slack"), "asked").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    had = had.select("hub", "slack", F.lit(0).alias("asked"), "lines", "least").unionAll(asked)
    sums = had.select("hub", "slack", "asked", F.sum("lines").over(order).alias("others"), F.min("least").over(order).alias("least")).where("asked = 1")
    sums = sums.select("hub", (-F.col("slack")).alias("slack"), "others", "least")
    # A class whose slack is not negative is among those it asked for; its own first line is no earlier one.
    own = F.when(F.col("slack") >= 0, F.col("lines")).otherwise(0)
    return members.join(sums, ["hub", "slack"]).select(F.col("node").alias("a"), "least", (F.col("others") - own).alias("others"))


def _uncounted(members: DataFrame) -> DataFrame:
    """Links ``a, b`` within groups that the slacks do not tell; such sets differ from the centre in a common token."""
    few = members.groupBy("hub").agg(F.min("slack").alias("fewest")).where("fewest < 0")
    rows = members.join(few, "hub").where("slack + fewest < 0")
    spread = rows.select("node", "slack", "other", F.explode("other").alias("at"), "hub").withColumn("token", F.xxhash64("hub", "at"))
    spread = cut(spread.select("node", "slack", "other", "hub", "at", "token"))
    met = _faced(spread, F.struct("node", "slack", "other", "hub", "at"), cut(hot_tokens(spread, HOT)))
    met = met.where("x.node < y.node and x.hub = y.hub and x.at = y.at and x.slack + y.slack < 0")
    common = F.array_intersect("x.other", "y.other")
    met = met.where(F.col("x.slack") + F.col("y.slack") + 2 * (100 + PERCENT) * F.size(common) >= 0)
    return met.where(F.array_min(common) == F.col("x.at")).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))


def _apart(named: DataFrame) -> DataFrame:
    """``x, y``: each two entries of a gram once, but for those of its main group if it is cut into parts."""
    entry = F.struct("node", "n", "at", *BITS, "hub")
    cold = named.where(f"users <= {HOT}").select("token", entry.alias("x"))
    cold = cold.join(cold.select("token", F.col("x").alias("y")), "token").where("x.node < y.node")
    hot = named.where(f"users > {HOT}").withColumn("parts", F.ceil(F.col("users") / HOT).cast("int"))
    main = hot.where("hub is not null").groupBy("token").agg(F.mode("hub").alias("main"))
    hot = hot.join(main, "token", "left").withColumn("own", F.expr("coalesce(hub = main, false)"))
    parts = hot.select("token", F.pmod(F.hash("node"), F.col("parts")).alias("part"), "own", entry.alias("x"))
    # Two of the main group need not meet, so only the others go to all parts.
    every = hot.where("not own").select("token", entry.alias("y"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    faced = parts.join(every, ["token", "part"]).where("own or x.node < y.node")
    return cold.select("x", "y").unionAll(faced.select("x", "y"))


def _met(few: DataFrame, many: DataFrame, members: DataFrame, steps: _Steps) -> DataFrame:
    """Candidates ``a, b`` at all grams, but for those within a group."""
    hubs = members.select("node", "hub")
    named = many.join(hubs, "node", "left").select("token", "node", "n", "at", *BITS, "hub", "users")
    named = steps.write(named, "hubs")
    for number in range(ROUNDS):
        # A class in no group has no hub; it may be another group's.
        met = _apart(named.where(_here("token", number))).where("coalesce(x.hub <> y.hub, true)").where(_may_be_alike())
        ends = [f("x.node", "y.node").alias(end) for f, end in ((F.least, "a"), (F.greatest, "b"))]
        steps.write(met.select(*ends).distinct(), f"met/round={number}")
    met = steps.spark.read.parquet(f"{steps.folder}/met").select("a", "b").unionAll(few).distinct()
    for end in ("a", "b"):
        met = met.join(hubs.select(F.col("node").alias(end), F.col("hub").alias(f"hub_{end}")), end, "left")
    return met.where("coalesce(hub_a <> hub_b, true)").select("a", "b")


def near_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, line_no, class_doc, class_line, match_doc, match_line, removed, n_links`` of every line with a word.

    ``class_*`` is the first line with the same token set, ``match_*`` the first
    earlier line of another set with similarity ``PERCENT`` or more, if there is
    one.  A line is removed if it is not its class's first or has such a match.
    ``n_links`` is how many other lines, earlier or later, have similarity
    ``PERCENT`` or more with it; lines of the same set count.  Order is by
    document id, nulls first, then line; words are compared with A-Z
    lower-cased and their order and number ignored.  Rows that repeat an id have
    their lines at the same places; of those the result has each line.
    """
    spark = docs.sparkSession
    steps = _Steps(docs)
    with setting(spark, FREE_SHUFFLES, "true"):
        lines = lines_of(docs, id_column, text_column)
        keyed, classes = _keyed(lines, steps)
        places = steps.write(keyed.select("doc_id", "line_no", "k1", "k2"), "places")
        few, many = _spread(_entries(keyed, classes), steps)
        steps.remove("keyed")
        grouped = steps.write(_groups(many, steps), "together")
        steps.remove("groups")
        sets = _sets(lines, classes, grouped.select("node"), steps)
        members = steps.write(_members(grouped, classes, sets, steps), "members")
        steps.remove("together", "wanted", "sets", "grouped", "centres", "slacks")
        steps.write(_uncounted(members), f"links/round={ROUNDS}")
        pairs = steps.write(_met(few, many, members, steps), "pairs")
        steps.remove("few", "many", "hubs", "met")
        links = _verified(lines, PERCENT, classes, pairs, steps)
        steps.remove("pairs", "wanted", "sets")
        named = steps.write(_named(classes, links, _counted(members)), "named")
        steps.remove("links", "members", "classes")
    out = places.join(named, ["k1", "k2"])
    later = ~F.struct("doc_id", "line_no").eqNullSafe(F.col("first"))
    return out.select(
        "doc_id", "line_no",
        F.col("first.doc_id").alias("class_doc"), F.col("first.line_no").alias("class_line"),
        F.col("match.doc_id").alias("match_doc"), F.col("match.line_no").alias("match_line"),
        (later | F.col("match").isNotNull()).alias("removed"),
        "n_links",
    )


def _named(classes: DataFrame, links: DataFrame, counted: DataFrame) -> DataFrame:
    """``k1, k2, first, match, n_links`` of each class."""
    ends = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = classes.select(F.col("node").alias("b"), F.col("first").alias("least"), F.col("lines").alias("others"))
    linked = ends.join(others, "b").select("a", "least", "others").unionAll(counted.select("a", "least", "others"))
    linked = linked.groupBy("a").agg(F.min("least").alias("least"), F.sum("others").alias("others"))
    return classes.join(linked, classes["node"] == linked["a"], "left").select(
        "k1", "k2", "first", F.when(F.col("least") < F.col("first"), F.col("least")).alias("match"),
        (F.col("lines") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
    )


def _sets(lines: DataFrame, classes: DataFrame, nodes: DataFrame, steps: _Steps) -> DataFrame:
    """``node, tokens`` of the classes ``nodes``, made again."""
    wanted = classes.join(nodes, "node", "left_semi").select(
        "node", "seed", F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), F.col("first.doc_id").alias("_doc"), F.col("first.line_no").alias("_line")
    )
    # A table, so that the join knows its size.
    wanted = steps.write(wanted, "wanted")
    # Sets are made from the class's first line, met by its place; the keys tell repeated ids apart.
    # The generator keeps the keys' comparison above the join, where sets would be made of all lines.
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("line_no") == F.col("_line"))
    made = F.struct("node", "seed", "_k1", "_k2", numbers(F.col("line")).alias("tokens"))
    sets = lines.join(wanted, same).select(F.inline(F.array(made)))
    sets = sets.select("node", "_k1", "_k2", "tokens", *_keys("tokens", F.col("seed"))).where("k1 = _k1 and k2 = _k2")
    return steps.write(sets.select("node", "tokens").dropDuplicates(["node"]), "sets")


def _verified(lines: DataFrame, percent: int, classes: DataFrame, pairs: DataFrame, steps: _Steps) -> DataFrame:
    """The pairs ``a, b`` whose full sets have similarity ``percent`` or more, after the links written before."""
    sets = _sets(lines, classes, pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), steps)
    a = sets.select(F.col("node").alias("a"), F.col("tokens").alias("a_tokens"))
    b = sets.select(F.col("node").alias("b"), F.col("tokens").alias("b_tokens"))
    both = F.size(F.array_intersect("a_tokens", "b_tokens"))
    for number in range(ROUNDS):
        # The sets move with their pairs; a round has those of a part of the first ones.
        here = _here("a", number)
        tested = pairs.where(here).join(a.where(here), "a").join(b, "b")
        tested = tested.select("a", "b", both.alias("both"), (F.size("a_tokens") + F.size("b_tokens")).alias("sum"))
        steps.write(tested.where(f"{100 + percent} * both >= {percent} * sum").select("a", "b"), f"links/round={number}")
    return steps.spark.read.parquet(f"{steps.folder}/links").select("a", "b")


def drop_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_lines, n_removed, removed`` per document id with a line; ``removed`` lists line numbers."""
    gone = F.when(F.col("removed"), F.col("line_no"))
    return (
        near_lines(docs, id_column, text_column)
        .groupBy("doc_id")
        .agg(
            F.count("*").alias("n_lines"),
            F.count(gone).alias("n_removed"),
            F.sort_array(F.collect_list(gone)).alias("removed"),
        )
    )
