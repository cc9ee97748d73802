"""Quality rules, line first: drop failing lines, then documents that lose too much.

Everything is an expression over one row: no shuffle, no Python, and a document
needs memory for its own text only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keytide.llm.common import NOT_BLANK, words

# Symbols and limits of the base rules.
SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# A document may lose this share of the characters of its words with its lines.
MAX_LOST_PERCENT = 40
SHORT_LINE, LONG_LINE = 100, 30  # characters, words
SEPARATORS = "[|»›·•]"
SUSPECT = r"[|»›·•#*$%&<>!]|\A[^\p{P}]*\z"  # a mark of the rules below, or no punctuation at all
BOILERPLATE = (
    r"(?i)\b(all rights reserved|terms of (use|service)|privacy policy|cookie (policy|settings)|"
    r"accept (all )?cookies|enable javascript|subscribe (now|to our)|sign up (now|for)|log ?in|"
    r"click here|read more|share (this|on)|back to top|skip to (main )?content)\b"
)


def line_fails(line: Column) -> Column:
    """Whether a line is navigation, symbol noise, shouting, unpunctuated or boilerplate.

    One pattern finds the few lines that the first four can concern.
    """
    n = F.size(words(line))
    count = lambda pattern: F.regexp_count(line, F.lit(pattern))
    navigation = (count(SEPARATORS) >= 2) & (count(SEPARATORS) * 4 >= n)
    noise = count(SYMBOLS) * 2 >= n
    shouting = (n >= 3) & (count("!") >= n)
    unpunctuated = (n >= LONG_LINE) & ~line.rlike(r"\p{P}")
    boilerplate = (F.char_length(line) <= SHORT_LINE) & line.rlike(BOILERPLATE)
    return (line.rlike(SUSPECT) & (navigation | noise | shouting | unpunctuated)) | boilerplate


def clean_lines(text: Column) -> Column:
    """The text without its failing lines; other lines and their breaks stay."""
    return F.array_join(F.filter(F.split(text, "\n"), lambda line: ~line_fails(line)), "\n")


def _neighbours(array: str, field: str) -> Column:
    """The elements of a sorted array that share a field with the one beside them."""
    same = lambda x, at: F.coalesce(F.get(array, at)[field] == x[field], F.lit(False))
    return F.filter(array, lambda x, i: same(x, i - 1) | same(x, i + 1))


def _covered(places: Column) -> Column:
    """Number of words in the triples that start at some places, given in order."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    step = lambda acc, p: F.struct(
        (acc["n"] + p + 3 - F.greatest(p, acc["end"])).alias("n"), (p + 3).alias("end")
    )
    return F.aggregate(places, start, step)["n"]


def judge(docs: DataFrame, text_column: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """Each row's ``keep`` columns as ``row``, its measures, its cleaned text and the verdict.

    A null or blank text has no words and fails.  Rows are judged one by one, so
    ids may be null or repeat, and other columns may have any name: they are
    inside ``row``.
    """
    text = F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit("")).alias("text")
    row = F.struct(*[F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)]).alias("row")
    rows = docs.select(row, text).withColumn("words", words(F.col("text")))
    word = lambda i: F.get("words", i)
    places = F.sequence(F.lit(0), F.greatest(F.size("words") - 3, F.lit(0)))
    # Equal triples have equal hashes, so only triples with a repeated hash are compared as texts.
    rows = rows.withColumn("hashes", F.transform(places, lambda i: F.xxhash64(word(i), word(i + 1), word(i + 2))))
    repeats = (F.size("words") >= 3) & (F.size(F.array_distinct("hashes")) < F.size("hashes"))
    placed = F.transform("hashes", lambda h, i: F.struct(h.alias("hash"), i.alias("place")))
    none = F.array().cast("array<struct<hash:bigint,place:int>>")
    rows = rows.select(
        "row",
        "text",
        "words",
        F.when(repeats, F.sort_array(placed)).otherwise(none).alias("by_hash"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(NOT_BLANK)).alias("full_lines"),
        clean_lines(F.col("text")).alias("clean_text"),
    )
    triple = lambda x: F.struct(
        F.concat_ws(" ", word(x["place"]), word(x["place"] + 1), word(x["place"] + 2)).alias("text"), x["place"]
    )
    by_text = F.sort_array(F.transform(_neighbours("by_hash", "hash"), triple))
    rows = rows.select(
        "row",
        "clean_text",
        (F.octet_length("clean_text") < F.octet_length("text")).alias("changed"),
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("full_lines") - F.size(F.array_distinct("full_lines"))).cast("long").alias("n_dup_lines"),
        by_text.alias("by_text"),
    )
    left = F.char_length(F.array_join(words(F.col("clean_text")), ""))
    twice = F.sort_array(F.transform(_neighbours("by_text", "text"), lambda x: x["place"]))
    rows = rows.withColumns(
        {
            "n_repeat_words": _covered(twice).cast("long"),
            "lost_chars": F.when(F.col("changed"), F.col("word_chars") - left).otherwise(F.lit(0)).cast("long"),
        }
    ).drop("by_text", "changed")
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    kept = ~failed & (100 * F.col("lost_chars") <= MAX_LOST_PERCENT * F.col("word_chars"))
    return rows.withColumn("base_failed", failed).withColumn("kept", kept)


def keep_clean(docs: DataFrame, text_column: str = "text", length_column: str | None = None) -> DataFrame:
    """The documents that pass, with their cleaned text and the columns they had.

    ``length_column`` is set to the new length where lines went.
    """
    # The one-element array keeps the filter above the measures: below, it would repeat them.
    kept = judge(docs, text_column).select(F.inline_outer(F.array(F.struct("*")))).where("kept")
    changed = F.col("lost_chars") > 0
    columns = []
    for name in docs.columns:
        value = F.col("row")[name]
        if name == text_column:
            value = F.when(changed, F.col("clean_text")).otherwise(value)
        elif name == length_column:
            new = F.char_length("clean_text").cast(docs.schema[name].dataType)
            value = F.when(changed, new).otherwise(value)
        columns.append(value.alias(name))
    return kept.select(*columns)
