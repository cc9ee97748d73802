"""A training corpus from raw documents: clean, deduplicate, decontaminate, mix, encode."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from keytide.llm import decontaminate, line_quality, mixing, near_dups, token_codes
from keytide.llm.common import load
from keytide.llm.queries import tokenizer_path
from keytide.llm.storage import new_folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, without their failing lines."""
    return line_quality.keep_clean(docs, length_column="n_chars" if "n_chars" in docs.columns else None)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies."""
    return near_dups.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.drop_leaks(docs, load(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.repeat(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files written, and each document's place and checksum read from them."""
    files = token_codes.write_tokens(docs, new_folder(spark, "corpus"), tokenizer_path())
    return token_codes.read_tokens(files)


STAGES = [
    ("quality rules", quality_rules),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixture),
    ("token files", token_files),
]

# The tokenizer and the iterative stages have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    docs = load(spark, sf_dir, "documents")
    folder = new_folder(spark, "pipeline")
    for step, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{step}"
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    return docs
