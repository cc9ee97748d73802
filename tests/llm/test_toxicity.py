"""Toxicity: single features, the learned list, and accuracy on texts that taught nothing."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa

from keytide.llm import toxicity
from keytide.llm.queries import op12_toxicity
from keytide.llm.text_arrays import word_slices

SCHEMA = "doc_id long, text string, features array<double>, label double, toxic int, prediction double"


def described(text, learned=None):
    made = [f for _, _, words in word_slices(pa.array([text]), lower=False) for f in toxicity.features(words, learned or {}, {})]
    assert len(made) == 1 and np.isfinite(made[0]).all()
    return dict(zip(toxicity.FEATURES, made[0]))


def test_single_features():
    plain = described("A quiet walk by the river, then home.")
    assert not any(plain[k] for k in (*toxicity.KINDS, "listed", "learned", "hidden", "odd", "near_second"))
    loud = described("YOU are such an IDIOT!!! Idiots, all of them, idiot.")
    assert loud["insult"] == loud["listed"] == 3 * 50 and loud["near_second"] >= 50 and loud["shouted"] > 0
    assert loud["exclamations"] == 3 * 50 and loud["repeated_marks"] == 50 and loud["capitals"] > plain["capitals"]
    far = described("you " + "word " * 30 + "idiot")
    assert far["near_second"] == 0 < far["insult"] and far["second"] > 0
    assert described("du bist ein Dummkopf")["insult"] and described("tu es un connard")["near_second"]
    assert all(described(t)["hidden"] for t in ("an 1d10t again", "such an id!ot here", "id.iot", "he is an i d i o t now"))
    assert not any(described(t)["hidden"] for t in ("on 12.05.2024 we met", "a well-known man", "an idiot", "a b c d e f"))
    stem = described("vexorian vexoria words", {"vexor-": 0.9})
    assert stem["stems"] == 2 * 50 and stem["strong"] == 2 * 50 and stem["strongest"] == 0.9 and stem["together"] == 2


def test_empty_and_very_long_texts():
    for text in ("", " \n\t", "?!", " "):
        assert set(toxicity.FEATURES) == set(described(text))
    words = "calm " * 300_000
    long = described(words + "idiot")
    assert 0 < long["insult"] < 0.01 and long["log_words"] > 12
    # Texts side by side do not see each other's words.
    batch = pa.array(["x you", "idiot x", None, "i d", "i o t"])
    made = [f for _, _, w in word_slices(batch, lower=False) for f in toxicity.features(w, {}, {})]
    at = toxicity.FEATURES.index
    assert len(made) == 5 and made[1][at("near_second")] == 0 and not any(f[at("odd")] for f in made)


def corpus(seed, n):
    """Half in one made-up language with a toxic stem, half in English with listed words; one in five is toxic."""
    rng = random.Random(seed)
    usual = [a + b + c for a in ("br", "st", "pl", "gr") for b in "aeiou" for c in ("n", "rd", "lt", "m", "sk")]
    rows = []
    for i in range(n):
        words = [rng.choice(usual) for _ in range(rng.randrange(20, 120))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(3):
                word = "zuxqe" + rng.choice(usual) if i % 2 else rng.choice(["idiot", "worthless", "scum"])
                words.insert(rng.randrange(len(words)), word)
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_held_out_accuracy_and_odd_rows(spark):
    rows = corpus(3, 600)
    docs = [(i, t, None, 0.0, 1, 0.0) for i, t, _ in rows] + [(None, "idiot", None, 0.0, 1, 0.0), (7, None, None, 0.0, 0, 0.0), (8, "", None, 0.0, 0, 0.0), (8, "", None, 0.0, 0, 0.0)]
    labels = [(i, 1, y) for i, _, y in rows] + [(None, 1, 1), (3, 1, None), (5, 1, 0), (99999, 1, 1)]
    docs = spark.createDataFrame(docs, SCHEMA)
    labels = spark.createDataFrame(labels, "doc_id long, text int, toxic int")
    teaches = lambda i: i % 3 > 0
    got = toxicity.score(docs, labels, learn_from=teaches).collect()
    assert len(got) == 604 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    held = [(r["predicted"], rows[r["doc_id"]][2]) for r in got[:600] if r["doc_id"] % 3 == 0]
    assert np.mean([p for p, y in held if y]) >= 0.95 and np.mean([p for p, y in held if not y]) <= 0.02
    # Labels that may not teach change nothing.
    other = labels.withColumn("toxic", toxicity.F.expr("if(doc_id % 3 = 0, 1 - toxic, toxic)"))
    assert sorted(map(str, toxicity.score(docs, other, learn_from=teaches).collect())) == sorted(map(str, got))


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "idiot", None, 0.0, 0, 0.0), (2, None, None, 0.0, 0, 0.0)], SCHEMA)
    empty = spark.createDataFrame([], "doc_id long, toxic int")
    one = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, toxic int")
    assert [(r["score"], r["predicted"]) for r in toxicity.score(docs, empty).collect()] == [(0.0, 0)] * 2
    assert [(r["score"], r["predicted"]) for r in toxicity.score(docs, one).collect()] == [(1.0, 1)] * 2
    assert toxicity.score(docs.where("doc_id > 5"), one).count() == 0


def test_query_on_a_whole_table(spark, sf_dir):
    got = op12_toxicity(spark, sf_dir).collect()
    ids = [r["doc_id"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id").collect()]
    assert sorted(r["doc_id"] for r in got) == sorted(ids)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
