"""Components and whitened rows against numpy's eigenvectors and plain sums."""

import numpy as np
import pyarrow.parquet as pq
import pytest

from feedloom.llm import whitening
from feedloom.llm.queries import op13_whitening

from .helpers import FOLDER

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def vectors():
    table = pq.read_table(f"{FOLDER}/embeddings.parquet")
    return table["vec_id"].to_pylist(), table["embedding"].to_pylist()


def plain(ids, rows):
    """{(vec_id, component): (n, deviation, |whitened|, explained)} by numpy."""
    x = [[int(np.floor(64 * float(c))) + 1_000_000 for c in row] for row in rows]
    fit = sorted({tuple(r) for r in x})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    z = np.array([[(n * c - s) / n for c, s in zip(row, sums)] for row in fit])
    values, axes = np.linalg.eigh(z.T @ z / n)
    values, axes = values[::-1], axes[:, ::-1]
    found = {}
    for i, row in zip(ids, x):
        parts = [n * c - s for c, s in zip(row, sums)]
        w = np.array(parts) / n @ axes / np.sqrt(np.maximum(values, 1e-300))
        for k in range(min(16, len(w))):
            found[i, k + 1] = n, sum(p * p for p in parts), abs(w[k]), values[k] / values.sum()
    return found


def test_query_against_numpy(spark):
    ids, rows = vectors()
    want = plain(ids, rows)
    got = op13_whitening(spark, FOLDER).collect()
    assert len(got) == len(want) == 16 * len(ids)
    for r in got:
        n, deviation, w, share = want[r.vec_id, r.component]
        assert (r.n, r.deviation) == (n, deviation)
        assert abs(r.whitened) == pytest.approx(w, abs=1e-8)
        assert r.explained == pytest.approx(share, rel=1e-9)
        assert r.identity_error < 1e-9
    assert len({r.identity_error for r in got}) == 1


@pytest.mark.parametrize("spectrum", [[5.0] * 6, [9, 9, 9, 1, 1, 0.5], [1e6, 1, 1e-3, 1e-3, 1e-6, 0], [3, 2.999999, 2, 1, 1e-9, 0], list(range(1, 41))])
def test_components_of_hard_spectra(spectrum):
    m = len(spectrum)
    axes = np.linalg.qr(np.random.default_rng(1).standard_normal((m, m)))[0]
    v = axes @ np.diag(spectrum) @ axes.T
    v = (v + v.T) / 2
    values, found = whitening.leading_components(v, m)
    assert found.shape == (m, m) and np.allclose(found.T @ found, np.eye(m), atol=1e-12)
    assert np.allclose(values, sorted(spectrum, reverse=True), atol=1e-13 * max(spectrum) * m)
    assert np.abs(v @ found - found * values).max() < 1e-13 * m * max(spectrum)
    few, part = whitening.leading_components(v, 3)
    assert np.allclose(few, values[:3], atol=1e-12 * max(spectrum)) and part.shape == (m, 3)


def test_diagonal_matrix_and_shift_on_an_eigenvalue():
    v = np.diag([4.0, 3.0, 2.0, 1.0, 0.0])  # the median and the mean are eigenvalues
    values, found = whitening.leading_components(v, 5)
    assert np.allclose(values, [4, 3, 2, 1, 0], atol=1e-14)
    assert np.allclose(np.abs(found), np.eye(5), atol=1e-12)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [0.5, 0.25, 0.0], 1), (1, [0.5, 0.25, 0.0], 1), (2, [0.1, -0.5, 1.0], None), (3, [0.5, 0.25], 1), (4, None, 1),
        (5, [nan, 0.0, 0.0], 1), (6, [0.0, inf, 0.0], 1), (7, [None, 0.0, 0.0], 1), (None, [1.0, 1.0, 0.125], 2), (8, [-1.0, 0.3, 0.2], 2),
        (9, [3e38, 0.0, 0.0], 1),
    ]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'clash' AS y", "1 AS i", "2 AS v")
    got = whitening.whiten(df).collect()
    kept = [(i, list(v) + [0.0] * (3 - len(v))) for i, v, _ in rows if i in (1, 2, 3, 8, None)]
    assert len(got) == 3 * len(kept) and {r.n for r in got} == {4}
    want = plain([i if i is not None else -1 for i, _ in kept], [np.float32(v) for _, v in kept])
    for r in got:
        n, deviation, w, _ = want[-1 if r.vec_id is None else r.vec_id, r.component]
        assert r.deviation == deviation and abs(r.whitened) == pytest.approx(w, abs=1e-8)
    same = spark.createDataFrame([(i, [0.5, 0.5], 1) for i in range(3)], SCHEMA)
    assert whitening.whiten(same).collect() == []
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, [], 1), (2, None, 1)], SCHEMA)).collect() == []


def test_large_entries_stay_exact():
    w = whitening.Whitening(10**7, np.zeros(2, np.int64), [3, -4], np.ones(1), np.ones((2, 1)), 1.0)
    y = np.array([[2**30, 5], [1, 2]])
    assert w.deviations(y) == [None, (10**7 - 3) ** 2 + (2 * 10**7 + 4) ** 2]
    a = np.array([[2**28, 3], [-(2**28), 7]])
    assert whitening._exact_gram(a).tolist() == [[2**57, -4 * 2**28], [-4 * 2**28, 58]]
