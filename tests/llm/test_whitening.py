import random

import numpy as np
import pytest

from lectern.llm import whitening
from lectern.llm.whitening import Spectrum, below

SCHEMA = "vec_id long, embedding array<double>"


def symmetric(values, seed=0):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    return (q * np.array(values)) @ q.T


def test_counts_of_eigenvalues():
    rng = np.random.default_rng(3)
    for size in (1, 2, 5, 20):
        for _ in range(20):
            a = rng.integers(-3, 4, (size, size)).astype(float)
            a = a + a.T
            values = np.linalg.eigvalsh(a)
            for shift in rng.uniform(-10, 10, 10):
                assert below(a, shift) == (values < shift).sum()
    # a zero on the diagonal needs a pivot of two
    assert below(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1


@pytest.mark.parametrize(
    "values",
    [
        [5, 4, 3, 2, 1, 0.5],
        [3, 3, 3, 2, 2, 1],
        [1 + 1e-9, 1, 1 - 1e-9, 0.5, 0.25, 0],
        [1e6, 1, 1e-3, 1e-8, 0, 0],
        list(np.linspace(1, 1.1, 64)),
    ],
)
def test_leading_pairs(values):
    a = symmetric(values)
    got, vectors = Spectrum(a).leading(16)
    want = np.sort(values)[::-1][: len(got)]
    assert np.allclose(got, want, atol=1e-13 * max(values) * len(values))
    assert len(got) == min(16, sum(v > 1e-12 * sum(values) for v in values))
    assert np.abs(vectors.T @ vectors - np.eye(len(got))).max() < 1e-12
    assert np.abs(a @ vectors - vectors * got).max() < 1e-12 * max(values)


def brute(rows, most=16):
    """Plain whitening of the whole table by a full eigendecomposition."""
    fine = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = {i: tuple(int(np.floor(64 * c)) + 1_000_000 for c in v) for i, v in fine}
    fit = np.array(sorted(set(x.values())), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    y = (fit - sums / n).astype(float)
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    kept = [k for k in range(min(most, len(values))) if values[k] > 1e-12 * values.sum()]
    out = {}
    for i, v in x.items():
        deviation = sum((n * a - s) ** 2 for a, s in zip(v, sums, strict=True))
        w = (np.array(v) - (sums / n).astype(float)) @ vectors[:, kept] / np.sqrt(values[kept])
        for k in kept:
            out[i, k + 1] = (n, deviation, w[k], values[k] / values.sum())
    return out


def vectors(count=300, dims=20, seed=5):
    rng = random.Random(seed)
    rows = [(k, [rng.gauss(0.1, 1 / (1 + d)) for d in range(dims)]) for k in range(count)]
    rows += [(1000 + k, list(rows[7][1])) for k in range(100)]
    odd = [None, [0.5] * (dims - 1) + [None], [float("nan")] * dims, [float("-inf")] + [0.0] * (dims - 1)]
    return rows + [(2000 + k, v) for k, v in enumerate(odd)]


def test_against_a_full_decomposition(spark):
    rows = vectors()
    df = spark.createDataFrame([(*r, 7.0) for r in rows], SCHEMA + ", whitened double").repartition(5)
    got = whitening.whiten(df).collect()
    want = brute(rows)
    assert {(r["vec_id"], r["component"]) for r in got} == set(want) and len(got) == len(want)
    sign = {r["component"]: np.sign(r["whitened"] * want[3, r["component"]][2]) for r in got if r["vec_id"] == 3}
    for r in got:
        n, deviation, w, share = want[r["vec_id"], r["component"]]
        assert (r["n"], r["deviation"]) == (n, deviation)
        assert r["whitened"] == pytest.approx(sign[r["component"]] * w, rel=1e-8, abs=1e-9)
        assert r["explained"] == pytest.approx(share, rel=1e-10)
        assert r["identity_error"] < 1e-10


def test_few_and_dependent_vectors(spark):
    def run(rows, schema=SCHEMA):
        return whitening.whiten(spark.createDataFrame(rows, schema)).collect()

    assert run([]) == []
    assert run([(1, [0.5, 0.5]), (2, [0.5, 0.5])]) == []
    assert run([(1, None), (2, [])]) == []
    # two vectors lie on one line; repeated ids and a null id stay rows
    got = run([(1, [0.0, 1.0, 2.0]), (1, [0.0, 1.0, 2.0]), (None, [1.0, 0.0, 0.0])])
    assert [r["component"] for r in got] == [1, 1, 1]
    assert sorted(round(abs(r["whitened"]), 9) for r in got) == [1, 1, 1]
    assert all(r["n"] == 2 and r["explained"] == pytest.approx(1) for r in got)
    # other lengths and entries beyond the limit take no part
    got = run([(1, [0.0, 1.0]), (2, [1.0, 0.0]), (3, [0.5, 3.0]), (4, [1.0]), (5, [1e300, 0.0])])
    assert {r["vec_id"] for r in got} == {1, 2, 3}


def test_large_entries_are_exact(spark):
    rows = [(1, [2.0**39, 1.0]), (2, [-(2.0**39), 0.0]), (3, [0.0, 5.0])]
    got = {(r["vec_id"], r["component"]): r for r in whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[1, 1]["deviation"] is None
    assert got[3, 1]["deviation"] == (3 * 320 - 384) ** 2 + 0
