"""Toxicity by gradient-boosted trees over dense features, calibrated by isotonic regression.

1. A bounded sample of the labelled rows to learn from, ``PER_LABEL`` of each label.
2. Two word lists: a short one written by hand, by kind of abuse, and a longer one
   learned from the labels: words and stems most of whose texts are toxic, by
   the lower end of that share's confidence interval.  The sample has two halves; each is
   described by the list that the other one taught, so that no text is described
   by what it taught itself.
3. Features per text: densities of both lists, how near second-person words
   stand, capitals, punctuation, and spellings that hide a listed word.
4. Trees on three quarters of the sample, isotonic calibration on the rest.

Scoring is one pass over the texts.  The learned list, ``LEARNED`` terms at most,
and the trees are what tasks get.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keytide.llm.common import cut, texts
from keytide.llm.runs import joined_words
from keytide.llm.text_arrays import Words, word_slices

PER_LABEL = 10_000  # sampled rows of each label
LEARNED, LEAST_TEXTS, LEAST = 5_000, 3, 0.3
STRONG = 0.8
Z = 2.58  # of the intervals: 99 %
STEMS = (4, 5)
TREES, DEPTH, STEP = 12, 3, 0.3
NEAR = 6  # words between a listed word and a second-person one
THRESHOLD = 0.3
HELD_ENTRIES = 300_000  # terms a task counts before it sends them on

# Written by hand, in four languages; plurals and endings are met by the last letters left out.
KINDS = {
    "insult": (
        "idiot stupid moron dumb dumbass fool clown loser imbecile cretin retard jackass "
        "idiota estúpido estúpida imbécil tonto tonta payaso payasa burro cretino "
        "idiote stupide imbécile crétin abruti abrutie débile bouffon connard connasse "
        "dumm dummkopf blöd blödmann trottel depp vollidiot schwachkopf versager"
    ),
    "contempt": (
        "worthless pathetic disgusting useless trash garbage scum filth vermin parasite pig swine rat "
        "basura asqueroso asquerosa inútil escoria patético patética cerdo "
        "ordure déchet dégoûtant dégoûtante minable pathétique nul vermine porc "
        "abschaum dreck müll wertlos ekelhaft erbärmlich ungeziefer schwein"
    ),
    "profanity": (
        "fuck fucking shit bullshit asshole bastard bitch crap damn "
        "mierda puta puto cabrón joder pendejo "
        "merde putain salope enculé bordel "
        "scheiße scheisse arschloch hurensohn wichser verdammt"
    ),
    "threat": (
        "kill die hang burn destroy "
        "muere muérete matar "
        "crève tuer mourir "
        "stirb töten verrecke"
    ),
}
SECOND = frozenset(
    "you your yours yourself youre u ur tú tu usted ustedes vosotros te ti vous votre vos toi ton ta du dich dir dein deine ihr euch euer sie".split()
)
LISTED = {word: kind for kind, words in KINDS.items() for word in words.split()}
# Characters that stand for letters in hidden spellings.
HIDDEN = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": "", "_": "", "-": "", ".": ""})
WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
# A token with letters around something that is none, or with a sign before or after that stands for one.
ODD = re.compile(r"[^\W\d_][0134578@$!*_.\-]+[^\W\d_]|[0134578@$*][^\W\d_]|[^\W\d_][0134578@$*]")
MARKS = ".,;:!?"
REPEATED = re.compile(r"[!?]{2,}")
SPACED = 4  # single letters in a row that may spell a word
TOGETHER = 10  # words among which listed ones are counted together

SUMS = (
    "words", *KINDS, "learned", "strong", "evidence", "stems", "second", "letters", "capitals", "shouted", "exclamations", "questions", "marks",
    "repeated_marks", "odd", "hidden",
)
AT = {name: i for i, name in enumerate(SUMS)}
FEATURES = (
    "log_words", *KINDS, "learned", "strong", "evidence", "stems", "second", "capitals", "shouted", "exclamations", "questions", "marks",
    "repeated_marks", "odd", "hidden", "listed", "strongest", "near_second", "learned_near_second", "together",
)


def terms_of(word: str) -> list[str]:
    """A word and its stems; stems end in a dash, so that no word is one."""
    return [word, *(word[:n] + "-" for n in STEMS if len(word) > n)]


def listed_kind(word: str) -> str | None:
    """The kind of a word in the hand-written list, also with an ending of up to two letters."""
    for end in range(3):
        kind = LISTED.get(word[: len(word) - end] if end else word)
        if kind and (not end or len(word) - end >= 4):
            return kind
    return None


def token_row(token: str, learned: dict[str, float]) -> tuple[float, ...]:
    """``SUMS`` of one token between white space, then its strongest term, and whether it is a single letter."""
    low = token.lower()
    words = WORD.findall(low)
    row = [0.0] * len(SUMS)
    strongest = 0.0
    for word in words:
        kind = listed_kind(word)
        if kind:
            row[AT[kind]] += 1
        strength = learned.get(word, 0.0)
        if not strength:
            strength = max((learned.get(t, 0.0) for t in terms_of(word)[1:]), default=0.0)
            row[AT["stems"]] += strength > 0
        row[AT["learned"]] += strength > 0
        row[AT["strong"]] += strength >= STRONG
        row[AT["evidence"]] += strength
        strongest = max(strongest, strength)
        row[AT["second"]] += word in SECOND
    row[AT["words"]] = len(words)
    if words:
        row[AT["letters"]] = sum(map(len, words))
        if low != token:
            row[AT["capitals"]] = sum(map(str.isupper, token))
            row[AT["shouted"]] = sum(len(w) > 2 and w.isupper() for w in WORD.findall(token))
    if not low.isalpha():
        row[AT["exclamations"]], row[AT["questions"]] = token.count("!"), token.count("?")
        row[AT["marks"]] = sum(map(token.count, MARKS))
        row[AT["repeated_marks"]] = len(REPEATED.findall(token))
        if ODD.search(low):
            plain = low.strip(MARKS).translate(HIDDEN)
            row[AT["odd"]] = 1
            row[AT["hidden"]] = _spells(plain, learned) and not any(row[AT[k]] for k in KINDS)
    return *row, strongest, float(len(token) == 1 and token.isalpha())


def _spells(plain: str, learned: dict[str, float]) -> bool:
    return bool(listed_kind(plain)) or learned.get(plain, 0.0) >= STRONG


def features(words: Words, learned: dict[str, float], known: dict[bytes, tuple[float, ...]]) -> np.ndarray:
    """``FEATURES`` of each text of a slice, all finite; ``known`` keeps the rows of tokens met before."""
    joined, begins = joined_words(words)
    column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begins) - 1, [None, pa.py_buffer(begins.astype(np.int64)), pa.py_buffer(joined)])
    coded = column.dictionary_encode()
    rows = []
    for token in coded.dictionary.to_pylist():
        row = known.get(token)
        if row is None:
            row = known[token] = token_row(token[:-1].decode(), learned)
        rows.append(row)
    ids = coded.indices.to_numpy()
    table = np.array(rows, dtype=np.float64).reshape(-1, len(SUMS) + 2)
    n = words.counts
    out = np.zeros((len(n), len(FEATURES)))
    full = np.flatnonzero(n)
    if not len(full):
        return out
    first, last = words.first[:-1][full], words.first[1:][full]
    sums = np.add.reduceat(table[ids, : len(SUMS)], first, axis=0)
    hits, second = table[ids, AT["learned"]] > 0, table[ids, AT["second"]] > 0
    listed = table[:, [AT[k] for k in KINDS]].sum(axis=1)[ids] > 0
    owner = np.repeat(np.arange(len(full)), last - first)
    near = _near(second, first[owner], last[owner])
    ahead = np.cumsum(np.append(0, hits))
    together = ahead[np.minimum(np.arange(len(ids)) + TOGETHER, last[owner])] - ahead[:-1]
    spaced = _spaced(table[ids, len(SUMS) + 1] > 0, first, owner, joined, begins, learned)
    sums[:, AT["odd"]] += np.bincount(spaced[0], minlength=len(full))
    sums[:, AT["hidden"]] += np.bincount(spaced[0][spaced[1]], minlength=len(full))
    count = sums[:, AT["words"]]
    per = (1000.0 / np.maximum(count, 20))[:, None]
    rates = sums[:, 1:] * per
    letters, capitals = AT["letters"] - 1, AT["capitals"] - 1
    rates[:, capitals] = sums[:, AT["capitals"]] / np.maximum(sums[:, AT["letters"]], 1)
    rates = np.delete(rates, letters, axis=1)
    rest = np.stack(
        [
            np.add.reduceat(listed, first, dtype=np.int64) * per[:, 0],
            np.maximum.reduceat(table[ids, len(SUMS)], first),
            np.add.reduceat(listed & near, first, dtype=np.int64) * per[:, 0],
            np.add.reduceat(hits & near, first, dtype=np.int64) * per[:, 0],
            np.maximum.reduceat(together, first),
        ],
        axis=1,
    )
    out[full] = np.concatenate([np.log1p(count)[:, None], rates, rest], axis=1)
    return out


def _near(flags: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Places with a flag of their own text at most ``NEAR`` words away."""
    before = np.cumsum(np.append(0, flags))
    at = np.arange(len(flags))
    return before[np.minimum(at + NEAR + 1, last)] > before[np.maximum(at - NEAR, first)]


def _spaced(single: np.ndarray, first: np.ndarray, owner: np.ndarray, joined: np.ndarray, begins: np.ndarray, learned: dict[str, float]) -> tuple[np.ndarray, np.ndarray]:
    """Text and whether they spell a listed word, of each row of single letters."""
    opens, closes = single.copy(), single.copy()
    opens[1:] &= ~(single[:-1] & (owner[1:] == owner[:-1]))
    closes[:-1] &= ~(single[1:] & (owner[1:] == owner[:-1]))
    lo, hi = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    long = hi - lo >= SPACED
    lo, hi = lo[long], hi[long]
    spelt = [_spells(joined[begins[a] : begins[b]].tobytes().decode().replace(" ", "").lower(), learned) for a, b in zip(lo, hi)]
    return owner[lo], np.array(spelt, dtype=bool)


def _describe(learned: dict[str, float], keep: list[str]):
    """Map: the kept columns and ``features``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, tuple[float, ...]] = {}
        for batch in batches:
            for row, to, words in word_slices(batch.column("text"), lower=False):
                if len(known) > HELD_ENTRIES:
                    known.clear()
                made = features(words, learned, known)
                bounds = pa.array(np.arange(len(made) + 1) * made.shape[1], pa.int32())
                columns = {c: batch.column(c)[row:to] for c in keep}
                yield pa.RecordBatch.from_pydict(columns | {"features": pa.ListArray.from_arrays(bounds, pa.array(made.ravel()))})

    return run


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``half, term, toxic, clean``: texts of each half and label that have a term, combined in the task."""
    counts: Counter = Counter()

    def flush() -> pa.RecordBatch:
        keys = list(counts)
        batch = pa.RecordBatch.from_pydict(
            {
                "half": pa.array([k[0] for k in keys], pa.int32()),
                "term": pa.array([k[1] for k in keys], pa.string()),
                "toxic": pa.array([counts[k] if k[2] else 0 for k in keys], pa.int64()),
                "clean": pa.array([0 if k[2] else counts[k] for k in keys], pa.int64()),
            }
        )
        counts.clear()
        return batch

    for batch in batches:
        for half, toxic, text in zip(*(batch.column(c).to_pylist() for c in ("half", "toxic", "text"))):
            found = {t for word in set(WORD.findall(text.lower())) for t in terms_of(word)}
            counts.update((half, term, toxic) for term in found)
            if len(counts) > HELD_ENTRIES:
                yield flush()
    if counts:
        yield flush()


def strength(toxic: Column, clean: Column) -> Column:
    """Lower end of Wilson's interval for the share of toxic ones among the texts with a term."""
    n, z = toxic + clean, Z
    return (toxic + z * z / 2 - z * F.sqrt(toxic * clean / n + z * z / 4)) / (n + z * z)


def _learn(terms: DataFrame, halves: tuple[int, ...]) -> dict[str, float]:
    """The ``LEARNED`` terms that speak most for toxicity in these halves, with their strengths."""
    counts = terms.where(F.col("half").isin(*halves)).groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    best = counts.where(f"toxic >= {LEAST_TEXTS}").select("term", strength(F.col("toxic"), F.col("clean")).alias("strength"))
    best = best.where(f"strength >= {LEAST}")
    return dict(map(tuple, best.orderBy(F.desc("strength"), "term").limit(LEARNED).collect()))


def sample(docs: DataFrame, labels: DataFrame, learn_from: Callable[[Column], Column], label_column: str, id_column: str) -> DataFrame:
    """``half, part, toxic, text`` of up to ``PER_LABEL`` labelled texts of each label, the same on every run.

    An id with both labels counts as toxic; null labels and ids are left out.
    An id that repeats gives each of its texts; equal texts
    are one, so that copies do not count as many witnesses.
    """
    # The least hashes of each label; its task keeps so many rows, not its input.
    known = labels.select(F.col(f"`{id_column}`").cast("long").alias("_id"), F.col(f"`{label_column}`").cast("int").alias("toxic"))
    known = known.where("_id is not null and toxic is not null").where(learn_from(F.col("_id")))
    known = known.groupBy("_id").agg((F.max("toxic") > 0).cast("int").alias("toxic")).withColumn("hash", F.xxhash64("_id"))
    sides = [known.where(f"toxic = {label}").orderBy("hash", "_id").limit(PER_LABEL) for label in (0, 1)]
    few = cut(sides[0].unionAll(sides[1]))
    # Bounded by the sample, so it is sent to the texts instead of shuffling them.
    rows = docs.join(F.broadcast(few), docs["doc_id"] == few["_id"]).dropDuplicates(["text"])
    return rows.select(
        F.pmod(F.col("hash"), F.lit(2)).cast("int").alias("half"), F.pmod(F.shiftright("hash", 1), F.lit(4)).cast("int").alias("part"), "toxic", "text"
    )


def _trained(known: DataFrame):
    """The learned list and the model, or the share of toxic texts if there is nothing to tell apart."""
    known = cut(known)
    sizes = {(r["half"], r["toxic"]): r["count"] for r in known.groupBy("half", "toxic").count().collect()}
    toxic, total = sum(n for (_, label), n in sizes.items() if label), sum(sizes.values())
    if not toxic or toxic == total:
        return {}, toxic / total if total else 0.0
    terms = cut(known.select("half", "toxic", "text").mapInArrow(_count_terms, "half int, term string, toxic long, clean long")
                .groupBy("half", "term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).where("toxic > 0"))
    parts = []
    for half in (0, 1):
        learned = _learn(terms, (1 - half,))
        rows = known.where(f"half = {half}").select("part", "toxic", "text")
        parts.append(rows.mapInArrow(_describe(learned, ["part", "toxic"]), "part int, toxic int, features array<double>"))
    described = cut(parts[0].unionAll(parts[1]).select("part", "toxic", array_to_vector("features").alias("features")))
    fit, rest = described.where("part < 3"), described.where("part = 3")
    if len(fit.select("toxic").distinct().collect()) < 2 or len(rest.select("toxic").distinct().collect()) < 2:
        fit = rest = described  # too few rows to part
    # One partition: the sample is bounded, and its order is then always the same.
    fit = fit.select(F.col("toxic").alias("label"), "features").coalesce(1)
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=1).fit(fit)
    raw = trees.transform(rest).select(F.col("toxic").cast("double").alias("label"), _margin().alias("margin"))
    return _learn(terms, (0, 1)), (trees, IsotonicRegression(featuresCol="margin").fit(raw.coalesce(1)))


def _margin() -> Column:
    return vector_to_array("rawPrediction")[1]


def score(
    docs: DataFrame,
    labels: DataFrame,
    learn_from: Callable[[Column], Column] = lambda doc_id: F.lit(True),
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
) -> DataFrame:
    """``doc_id, score, predicted``, one row per row of ``docs``.

    ``learn_from`` tells which ids may teach; ids and labels are no inputs of a
    score.  A null text is an empty one and gets a score too.  Without labels,
    or with one label only, every score is the share of toxic labels, 0 without any.
    """
    docs = texts(docs, id_column, text_column)
    learned, model = _trained(sample(docs, labels, learn_from, label_column, id_column))
    if isinstance(model, float):
        scored = docs.select("doc_id", F.lit(model).alias("score"))
    else:
        trees, steps = model
        rows = docs.mapInArrow(_describe(learned, ["doc_id"]), "doc_id long, features array<double>")
        rows = trees.transform(rows.select("doc_id", array_to_vector("features").alias("features")))
        rows = steps.transform(rows.select("doc_id", _margin().alias("margin")))
        scored = rows.select("doc_id", F.least(F.greatest("prediction", F.lit(0.0)), F.lit(1.0)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
