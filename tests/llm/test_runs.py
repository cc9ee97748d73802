"""Periodic runs against a plain version, on made texts and on a given table."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np

from keytide.llm import runs
from keytide.llm.queries import op13_periodic_runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, runs string, n_words int, kept_text string"


def plain_runs(words):
    """All runs by trying every period at every place."""
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(12, 2 * q):
                if not any(q % d == 0 and words[i : j + q - d] == words[i + d : j + q] for d in range(1, q)):
                    out.append((i, size, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def kept_words(words, found):
    gone = {i for s, size, q in found for i in range(s + q, s + size)}
    return [w for i, w in enumerate(words) if i not in gone]


def made(rng, kind):
    if kind == 0:
        return [f"w{rng.randrange(rng.choice([1, 2, 3]))}" for _ in range(rng.randrange(120))]
    if kind == 1:  # Fibonacci words hold as many runs as words can
        a, b = ["a"], ["a", "b"]
        while len(b) < 90:
            a, b = b, b + a
        return b
    words = []
    while len(words) < 100:
        base = [f"w{rng.randrange(rng.choice([2, 5, 40]))}" for _ in range(rng.randrange(1, 25))]
        words += (base * 7)[: rng.randrange(1, 110)] + [f"x{rng.randrange(9)}" for _ in range(rng.randrange(4))]
    return words


def test_runs_of_made_texts(spark):
    rng = random.Random(13)
    texts = [made(rng, i % 4) for i in range(240)]
    rows = [(i, " \n".join(t), None, 1, None) for i, t in enumerate(texts)]
    rows += [(None, "a " * 20, None, 1, None), (7, None, None, 1, None), (7, " \t\r\n", None, 1, None), (7, "  " * 12, None, 1, None)]
    got = runs.periodic_runs(spark.createDataFrame(rows, SCHEMA)).collect()
    found = {r["doc_id"]: r for r in got[: len(texts)]}
    for i, words in enumerate(texts):
        want = plain_runs(words)
        assert [tuple(r) for r in found[i]["runs"]] == want
        assert found[i]["kept_text"] == " ".join(kept_words(words, want)) and found[i]["n_words"] == len(words)
    # A null id, a null and a blank text, and a space that is not a separator.
    rest = [(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["kept_text"]) for r in got[len(texts) :]]
    assert rest == [(None, 20, [(0, 20, 1)], "a"), (7, 0, [], ""), (7, 0, [], ""), (7, 12, [(0, 12, 1)], " ")]


def test_runs_of_an_empty_table(spark):
    assert runs.periodic_runs(spark.createDataFrame([], SCHEMA)).count() == 0


def test_runs_of_a_very_long_text():
    rng = random.Random(5)
    base = rng.sample(range(100000), 7000)
    ids = np.array(rng.sample(range(200000, 300000), 5000) + base * 9 + base[:100] + [1] * 40)
    start, end, period = runs.find(ids, np.array([0, len(ids)]))
    assert list(zip(start, end, period)) == [(5000, 5000 + 9 * 7000 + 100, 7000), (len(ids) - 40, len(ids), 1)]


def test_rounds_change_nothing(monkeypatch):
    """Without any grammar rule the halves alone find the same."""
    rng = random.Random(8)
    words = [w for i in range(40) for w in made(rng, i % 4)]
    names = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.array([names[w] for w in words])
    whole = [v.tolist() for v in runs.find(ids, np.array([0, len(ids)]))]
    monkeypatch.setattr(runs, "ROUNDS", 0)
    assert whole == [v.tolist() for v in runs.find(ids, np.array([0, len(ids)]))]


def test_grammar_derives_each_place():
    """Nodes of one rule have the same words."""
    rng = random.Random(2)
    ids = np.array([rng.randrange(4) for _ in range(3000)] * 2)
    nodes = runs.re_pair(ids, np.array([0, 1500, 6000]))
    by_rule = {}
    for rule, lo, mid, hi in zip(nodes.rule, nodes.lo, nodes.mid, nodes.hi):
        assert lo < mid < hi
        by_rule.setdefault(rule, set()).add((mid - lo, *ids[lo:hi]))
    assert all(len(words) == 1 for words in by_rule.values())
    assert len(by_rule) < len(nodes.rule)


def test_query_on_a_whole_table(spark, sf_dir, limit=600):
    """The registered query against the contract, for texts of up to ``limit`` words."""
    got = {r["doc_id"]: r for r in op13_periodic_runs(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(got) == len(docs)
    for doc in docs:
        words = WORD.findall(doc["text"] or "")
        n, h = len(words), zlib.crc32(str(doc["doc_id"]).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        if n > limit:
            continue
        found = plain_runs(words)
        best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
        assert tuple(got[doc["doc_id"]]) == (
            doc["doc_id"], len(found), *((*best, 1000 * best[1] // best[2]) if best else (None,) * 4),
            digest("".join(f"{s},{size},{q}\n" for s, size, q in found)), digest(" ".join(kept_words(words, found))),
        )
