"""Whitening against a plain version in exact fractions, and the awkward rows."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from keytide.llm import whitening
from keytide.llm.queries import op11_whitening

SCHEMA = "vec_id long, embedding array<float>, x int, n int, pair string"


def plain(rows):
    """Whole values, exact covariance, then eigenvectors in double precision."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(64 * float(c)) + 1000000 for c in v] for _, v in kept]
    n, d = len(x), len(x[0])
    s = [sum(r[k] for r in x) for k in range(d)]
    off = [[n * r[k] - s[k] for k in range(d)] for r in x]
    v = np.array([[float(Fraction(sum(r[i] * r[j] for r in off), n**3)) for j in range(d)] for i in range(d)])
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    deviation = [sum(c * c for c in r) for r in off]
    white = np.array(off, dtype=float) / n @ vectors / np.sqrt(values)
    return [i for i, _ in kept], n, deviation, white, values / np.trace(v)


def vectors(seed, n, d):
    rng = np.random.default_rng(seed)
    made = rng.normal(size=(n, d)) @ rng.normal(size=(d, d)) + rng.normal(size=d) * 40
    return [(i, [float(c) for c in np.float32(v)]) for i, v in enumerate(made)]


def test_whitening_agrees_with_exact_covariance(spark):
    rows = vectors(4, 300, 7)
    odd = [(1000, None), (1001, [1.0] * 6 + [None]), (1002, [math.nan] * 7), (1003, [math.inf] + [0.0] * 6), (1004, []), (1005, [1.0, 2.0]), (None, [0.5] * 7), (3, rows[3][1])]
    data = spark.createDataFrame([(i, v, 1, 2, "p") for i, v in rows + odd], SCHEMA).repartition(5)
    got = whitening.whiten(data).collect()
    ids, n, deviation, white, explained = plain(rows + [r for r in odd if r[1] and len(r[1]) == 7])
    assert len(got) == len(ids) == 302 and {r["n"] for r in got} == {n}
    by_id = {}
    for i, d, w in zip(ids, deviation, white):
        by_id.setdefault(i, []).append((d, w))
    assert sum(r["vec_id"] is None for r in got) == 1 and sum(r["vec_id"] == 3 for r in got) == 2
    one = got[0]
    signs = np.sign(np.array(one["whitened"]) * by_id[one["vec_id"]][0][1])
    for r in got:
        d, w = by_id[r["vec_id"]][0]
        assert r["deviation"] == d
        assert np.allclose(np.array(r["whitened"]) * signs, w, atol=1e-9)
        assert np.allclose(r["explained"], explained, rtol=1e-9)
    assert max(r["identity_error"] for r in got) < 1e-9


def test_far_and_huge_values_stay_exact(spark):
    rng = np.random.default_rng(9)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(rng.integers(-(1 << 40), 1 << 40, size=(40, 3)))]
    data = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = whitening.whiten(data).collect()
    _, _, deviation, white, explained = plain(rows)
    assert all(r["deviation"] is None for r in got) and min(deviation) >= 1 << 63
    assert np.allclose(got[0]["explained"], explained, rtol=1e-12) and got[0]["identity_error"] < 1e-9
    assert np.allclose(np.abs(sorted(abs(r["whitened"][0]) for r in got)), sorted(abs(white[:, 0])), atol=1e-9)
    more = spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 2.0])], "vec_id long, embedding array<double>")
    assert len(whitening.whiten(more).collect()) == 3


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_nothing_to_span(spark, rows):
    data = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert whitening.whiten(data).collect() == []


def test_fewer_dimensions_than_components(spark):
    """Three vectors span a plane; a long vector and a tie of lengths."""
    rows = [(i, [float(i == k) for k in range(200)]) for i in range(3)] + [(10 + i, [1.0 * i]) for i in range(3)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert sorted(r["vec_id"] for r in got) == [0, 1, 2] and {len(r["whitened"]) for r in got} == {2}
    assert max(r["identity_error"] for r in got) < 1e-9


def test_query_on_a_whole_table(spark, sf_dir):
    got = op11_whitening(spark, sf_dir).collect()
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    ids, n, deviation, white, explained = plain(rows)
    want = {i: (d, w) for i, d, w in zip(ids, deviation, white)}
    assert len(got) == 32 * len(ids) and {r["n"] for r in got} == {n} and {r["component"] for r in got} == set(range(1, 33))
    first = {r["component"]: r["whitened"] * want[r["vec_id"]][1][r["component"] - 1] for r in got if r["vec_id"] == ids[0]}
    for r in got:
        d, w = want[r["vec_id"]]
        k = r["component"] - 1
        assert r["deviation"] == d and abs(r["whitened"] * np.sign(first[k + 1]) - w[k]) < 1e-8
        assert abs(r["explained"] / explained[k] - 1) < 1e-9 and r["identity_error"] < 1e-9
