"""URL verdicts by rules, and by trust and distrust spread over the link graph.

Hosts with allowed pages are trusted seeds, hosts with blocked pages distrusted
ones.  Personalised PageRank carries trust along links and distrust against
them, as who links to a blocked host is suspect; a host is blocked if its
distrust outweighs its trust.  Pages that no rule fits get their host's verdict.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keytide.llm.common import ascii_lower, cut

# The rules as (verdict, host, path).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
DAMPING, TOLERANCE = 0.85, 1e-6
MOST_STEPS = 500  # about 100 reach the tolerance, as a step sends on at most DAMPING of what it got
OUTWEIGHS = 1.0
LINK = r"""(?i)\bhref\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)"""


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?`` or ``#``, A-Z lower-cased; empty without one."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)\A(?:(?!://).)*://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A(?:(?!://).)*://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest rule that fits, as a struct; of equals the longer host, then the block."""
    order = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r[0] != "block"))
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in reversed(order):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        value = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, value).otherwise(found)
    return found


def host_edges(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """``src, dst, weight`` from absolute links between different hosts; ``pages`` has ``host``."""
    links = F.array_distinct(F.transform(F.regexp_extract_all(html_column, F.lit(LINK), 1), ascii_lower))
    edges = pages.select(F.col("host").alias("src"), F.explode_outer(links).alias("dst"))
    edges = edges.where("src <> '' and dst <> src").groupBy("src", "dst")
    return edges.agg(F.count("*").cast("double").alias("weight"))


def spread(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """``host, score``: personalised PageRank of ``edges`` from ``seeds(host, mass)``.

    What a host without outgoing links holds goes back to the seeds.  Both that
    and the restart only scale the seeds, so the scores are, to scale, the sum of
    what the seeds send over no, one, two, .. links, damped at each.  Goes on until all
    that is still to come is under ``TOLERANCE`` of the scores, and raises if
    ``MOST_STEPS`` do not get there; without cycles it ends with the longest path.
    Each step is one join over a table kept in the shared folder, and one small aggregate of it.
    """
    total = seeds.agg(F.sum("mass")).first()[0] or 0.0
    seeds = seeds.select("host", (F.col("mass") / (total or 1.0)).alias("seed")).where("seed > 0")
    out = edges.groupBy("src").agg(F.sum("weight").alias("out"))
    shares = cut(edges.join(out, "src").select("src", "dst", (DAMPING * F.col("weight") / F.col("out")).alias("share")))
    hosts = edges.select(F.col("src").alias("host")).union(edges.select("dst")).union(seeds.select("host")).distinct()
    seed = F.coalesce("seed", F.lit(0.0))
    scores = cut(hosts.join(seeds, "host", "left").select("host", seed.alias("score"), seed.alias("fresh")))
    for _ in range(MOST_STEPS):
        moving = scores.where("fresh > 0").join(shares, scores["host"] == shares["src"])
        sent = moving.groupBy("dst").agg(F.sum(F.col("fresh") * F.col("share")).alias("got"))
        got = F.coalesce("got", F.lit(0.0))
        scores = scores.join(sent, scores["host"] == sent["dst"], "left").select("host", (F.col("score") + got).alias("score"), got.alias("fresh"))
        scores = cut(scores)
        whole, fresh = scores.agg(F.coalesce(F.sum("score"), F.lit(0.0)), F.coalesce(F.sum("fresh"), F.lit(0.0))).first()
        if fresh * DAMPING / (1 - DAMPING) <= TOLERANCE * whole:
            return scores.select("host", (F.col("score") / (whole or 1.0)).alias("score"))
    raise RuntimeError(f"spread: not under {TOLERANCE} within {MOST_STEPS} steps")


def judge_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
) -> DataFrame:
    """``page_id, host, path, rule, verdict, trust, distrust``, one row per row of ``pages``.

    A null url, or one without ``://``, has an empty host and path, fits no rule
    and is allowed.  A null page has no links.  Rows may repeat; the graph counts
    each page that links.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rows = pages.select(
        F.col(f"`{id_column}`").alias("page_id"), F.col(f"`{url_column}`").cast("string").alias("url"), F.col(f"`{html_column}`").cast("string").alias("html")
    )
    rows = rows.withColumns({"host": host, "path": path})
    judged = rows.withColumn("found", rule_of(F.col("host"), F.col("path"), rules))
    edges = cut(host_edges(rows, "html"))
    seeds = judged.groupBy("host").agg(
        F.sum((F.col("found.verdict") == "allow").cast("double")).alias("allow"),
        F.sum((F.col("found.verdict") == "block").cast("double")).alias("block"),
    )
    seeds = cut(seeds.where("host <> ''"))
    trust = spread(edges, seeds.select("host", F.col("allow").alias("mass")))
    distrust = spread(edges.selectExpr("dst as src", "src as dst", "weight"), seeds.select("host", F.col("block").alias("mass")))
    scores = trust.withColumnRenamed("score", "trust").join(distrust.withColumnRenamed("score", "distrust"), "host", "full")
    out = judged.select("page_id", "host", "path", "found").join(scores, "host", "left")
    out = out.withColumns({"trust": F.coalesce("trust", F.lit(0.0)), "distrust": F.coalesce("distrust", F.lit(0.0))})
    blocked = F.col("distrust") > OUTWEIGHS * F.col("trust")
    verdict = F.coalesce(F.col("found.verdict"), F.when(blocked, "block").otherwise("allow"))
    return out.select("page_id", "host", "path", F.col("found.rule").alias("rule"), verdict.alias("verdict"), "trust", "distrust")
