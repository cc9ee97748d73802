"""One registered query per operator, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keytide.llm import decontaminate, license_scan, line_dedup, line_quality, mixing, near_dups, runs, substring, token_codes, toxicity, url_graph, warc, whitening
from keytide.llm.common import NOT_BLANK, load, words
from keytide.llm.storage import new_folder


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_url_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page's host, path, rule and verdict."""
    return url_graph.judge_urls(load(spark, sf_dir, "pages"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base phrases and license labels of every document."""
    return license_scan.scan_licenses(load(spark, sf_dir, "documents")).drop("base", "detections")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item found in a document, at its most similar window."""
    found = decontaminate.find_leaks(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    return found.drop("text_key")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records and read back."""
    folder = new_folder(spark, "warc")
    warc.write_archives(load(spark, sf_dir, "pages"), folder)
    return warc.read_archives(spark, folder).drop("payload", "record_id")


def op5_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left of each document once earlier documents' passages are gone."""
    return substring.remove_repeats(load(spark, sf_dir, "documents")).drop("kept_text")


def op6_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures, base verdict and the verdict after line cleaning, per document."""
    docs = load(spark, sf_dir, "documents")
    return line_quality.judge(docs, keep=["doc_id"]).select(
        "row.doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "lost_chars",
    )


def op7_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's shingle count and component."""
    found = near_dups.near_duplicates(load(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op8_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts encoded, written and read back."""
    files = token_codes.write_tokens(load(spark, sf_dir, "documents"), new_folder(spark, "tokens"), tokenizer_path())
    return token_codes.read_tokens(files)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of each document, next to its source's size and target."""
    mixed = mixing.mix(load(spark, sf_dir, "documents"), keep=["doc_id"])
    return mixed.select(
        "row.doc_id",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
        "rate",
        "copies",
    )


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line with a word: its class, its first earlier match, whether it goes, and its links."""
    return line_dedup.near_lines(load(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each usable vector on up to 32 whitened components."""
    made = whitening.whiten(load(spark, sf_dir, "embeddings"))
    made = made.select("vec_id", "n", "deviation", "explained", "identity_error", F.posexplode("whitened").alias("at", "whitened"))
    return made.select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "whitened", F.get("explained", "at").alias("explained"), "identity_error"
    )


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity score; a quarter of the ids teaches nothing."""
    remainder = lambda doc_id: F.coalesce(F.crc32(doc_id.cast("string")) % 4, F.lit(-1))
    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    scored = toxicity.score(docs, labels, learn_from=lambda doc_id: remainder(doc_id) != 2)
    return scored.select("doc_id", (remainder(F.col("doc_id")) == 2).alias("held_out"), "score", "predicted")


def _repeating(docs: DataFrame) -> DataFrame:
    """A tenth of the documents, by their id, with a tail that repeats: ``doc_id, text``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    h = F.crc32(F.col("doc_id").cast("string"))
    n, g = F.size("_words"), F.floor(F.col("_h") / 10)
    rows = docs.select(F.col("doc_id"), text.alias("text"), h.alias("_h"))
    chosen = rows.where("_h % 10 = 0").withColumn("_words", words(F.col("text"))).where("size(_words) > 0")
    chosen = chosen.withColumns({"_n": n, "_a": (g % n).cast("int"), "_g": g})
    p = F.lit(1) + F.floor((F.col("_n") - F.col("_a")) / (3 + F.col("_g") % 8)).cast("int")
    chosen = chosen.withColumn("_p", p)
    tail = F.slice("_words", F.col("_a") + 1, F.col("_p"))
    times = F.ceil((F.col("_n") - F.col("_a")) / F.col("_p")).cast("int")
    made = F.concat(F.slice("_words", F.lit(1), F.col("_a")), F.flatten(F.array_repeat(tail, times)))
    made = chosen.select("doc_id", F.array_join(F.slice(made, F.lit(1), F.col("_n")), " ").alias("text"))
    same = rows.where(F.expr("_h is null or _h % 10 <> 0") | ~F.col("text").rlike(NOT_BLANK)).select("doc_id", "text")
    return same.unionAll(made)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's runs, the longest of them, and digests of all runs and of the text without repeats."""
    found = runs.periodic_runs(_repeating(load(spark, sf_dir, "documents")))
    order = lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))
    best = F.array_max(F.transform("runs", order))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    found = found.withColumns({"best": best, "lines": lines})
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length"),
        (-F.col("best.period")).alias("period"),
        F.expr("(1000 * best.length) div -best.period").alias("exponent_milli"),
        F.sha2(F.col("lines").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("kept_text").cast("binary"), 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_url_graph, op2_license_scan, op3_decontaminate, op4_warc, op5_substring, op6_line_quality, op7_near_dups,
        op8_token_codes, op9_mixing, op10_line_dedup, op11_whitening, op12_toxicity, op13_periodic_runs,
    )
}
