"""Helpers shared by the operators: checkpoints, word patterns, the input's columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keytide.session import shared_dir

# What a word is, as Java patterns of one separator or one word.
BLANKS = r"[\x20\x09-\x0D]+"
NOT_BLANK = r"[^\x20\x09-\x0D]"
NOT_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def cut(rows: DataFrame) -> DataFrame:
    """Rows written to the shared checkpoint folder and read back.

    A lost executor costs a read of those files, not the work above them.
    """
    context = rows.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(f"{shared_dir(rows.sparkSession)}/keytide/checkpoints")
    return rows.checkpoint()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(rows: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Id and text under fixed names; a null text is an empty one.

    Other columns are left out, so their names cannot clash.
    """
    return rows.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit("")).alias("text"),
    )


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else.

    ``lower`` would change other alphabets too; on pure ASCII the two agree, and
    ``lower`` is several times faster.
    """
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def words(text: Column) -> Column:
    """Words between white space, as an array without empty strings."""
    return F.array_remove(F.split(text, BLANKS), "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")
