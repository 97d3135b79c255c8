"""Embedding whitening with components from a spectral divide and conquer by polar decompositions (QDWH).

Entries go to whole numbers x = floor(64 c) + 1,000,000. The *fit list* has each distinct x vector once; Spark
counts it, sums it and adds up the products of its centred entries, all in exact whole numbers, so the
covariance V doesn't depend on the order of rows or tasks. What reaches the driver is V, whose size is that of a vector
squared.

The eigenvectors of V are found by splitting. A shifted matrix V - s I has the polar decomposition U H; U has the
eigenvalue 1 on the eigenvectors of V above s and -1 on those below, so (I + U)/2 projects on the upper invariant
subspace and (I - U)/2 on the lower. Orthonormal bases of both cut V into two smaller matrices, and so on
until a subspace is one component, or has equal eigenvalues, where any basis will do. U comes from the QR-based,
dynamically weighted Halley iteration. Lower subspaces beyond the last component asked for are left alone.

The components are then broadcast, and every row is projected where it is.

Defined results: rows with a null vector, or a null, infinite or not-a-number entry, are dropped; so are rows with an
entry of 2^31 grid steps or more. A shorter vector than the longest has zeros behind its end. Repeated rows and rows
with a null vec_id each get their rows. Components whose eigenvalue is zero but for rounding can't be
scaled and are left out; a table of equal vectors, or an empty one, gives an empty result. Among equal
eigenvalues the components are some orthonormal basis. A deviation beyond 64 bits is null. Other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from feedloom.llm.vectors import dimensions, matrix, on_grid, padded, usable
from feedloom.operators.stage import staged

GRID = 64.0
COMPONENTS = 16
RESULT = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
_EXACT = 2**53
_EPS = float(np.finfo(float).eps)


# ---- spectral divide and conquer -----------------------------------------------------------------------------


def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix, by QDWH."""
    m = len(a)
    x = a / max(np.linalg.norm(a), np.finfo(float).tiny)
    low = _EPS
    for _ in range(12):
        d = (4.0 * (1.0 - low**2) / low**4) ** (1.0 / 3.0)
        root = np.sqrt(1.0 + d)
        ka = root + 0.5 * np.sqrt(8.0 - 4.0 * d + 8.0 * (2.0 - low**2) / (low**2 * root))
        kb = (ka - 1.0) ** 2 / 4.0
        kc = ka + kb - 1.0
        q, _ = np.linalg.qr(np.vstack([np.sqrt(kc) * x, np.eye(m)]))
        new = (kb / kc) * x + (ka - kb / kc) / np.sqrt(kc) * (q[:m] @ q[m:].T)
        new = (new + new.T) / 2.0
        moved = np.linalg.norm(new - x)
        x, low = new, min(1.0, low * (ka + kb * low**2) / (1.0 + kc * low**2))
        if abs(1.0 - low) < 10 * _EPS and moved < 1e-8:
            break
    return x


def _basis(projector: np.ndarray, k: int) -> np.ndarray:
    """Orthonormal basis of the k-dimensional range of a projector: two subspace steps from fixed random vectors."""
    q = np.random.default_rng(k).standard_normal((len(projector), k))
    for _ in range(2):
        q, _ = np.linalg.qr(projector @ q)
    return q


def _split(a: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of the invariant subspaces above and below a shift; None where the eigenvalues are equal."""
    m = len(a)
    mean = np.trace(a) / m
    spread = np.linalg.norm(a - mean * np.eye(m))
    if spread <= 4 * m * _EPS * max(np.linalg.norm(a), np.finfo(float).tiny):
        return None
    # The median of the diagonal halves well; the mean always has eigenvalues on both sides. A shift may hit an
    # eigenvalue, whose sign is then undecided, so others stand by.
    for shift in (np.median(np.diag(a)), mean, mean + 0.07 * spread / m, mean - 0.05 * spread / m, mean + 0.011 * spread / m):
        u = polar_factor(a - shift * np.eye(m))
        k = int(round((m + np.trace(u)) / 2.0))
        if 0 < k < m and np.linalg.norm(u @ u - np.eye(m)) < 1e-10 * m:
            return _basis((np.eye(m) + u) / 2.0, k), _basis((np.eye(m) - u) / 2.0, m - k)
    return None


def leading_components(v: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns) of the ``wanted`` largest of a symmetric matrix."""
    found: list[np.ndarray] = []
    todo = [np.eye(len(v))] if len(v) else []
    while todo and sum(b.shape[1] for b in found) < wanted:
        basis = todo.pop()
        parts = _split(basis.T @ v @ basis) if basis.shape[1] > 1 else None
        if parts is None:
            found.append(basis)
        else:
            upper, lower = (np.linalg.qr(basis @ part)[0] for part in parts)
            todo += [lower, upper]
    if not found:
        return np.empty(0), np.empty((len(v), 0))
    vectors = np.hstack(found)
    # V has its scale from the data: quotients are taken on the vectors as they are.
    values = np.einsum("ij,ij->j", vectors, v @ vectors)
    order = np.argsort(-values, kind="stable")[:wanted]
    return values[order], vectors[:, order]


# ---- sums over the fit list ----------------------------------------------------------------------------------


def _exact_gram(a: np.ndarray) -> np.ndarray:
    """a^T a of whole numbers as Python integers."""
    top = max(1, int(np.abs(a).max(initial=0)))
    if top * top >= _EXACT:
        wide = a.astype(object)
        return wide.T.dot(wide)
    step, total = max(1, _EXACT // (top * top)), np.zeros((a.shape[1], a.shape[1]), object)
    for at in range(0, len(a), step):
        part = a[at : at + step].astype(np.float64)
        total = total + (part.T @ part).astype(np.int64).astype(object)
    return total


def _summed(fit: DataFrame, size: int, part: Callable[[np.ndarray], np.ndarray], kind: str) -> dict[tuple[int, int], object]:
    """Sum over all rows of the upper triangle of ``part`` (rows -> square matrix), added up in tasks, then by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            found = part(matrix(batch.column(0), size))
            total = found if total is None else total + found
        if total is not None:
            i, j = np.triu_indices(len(total))
            values = pa.array([str(v) if kind != "double" else float(v) for v in total[i, j]])
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), values], ["i", "j", "v"])

    rows = fit.select("y").mapInArrow(run, f"i int, j int, v {'double' if kind == 'double' else 'string'}")
    sums = rows.groupBy("i", "j").agg(F.sum(F.col("v").cast(kind)).alias("v")).collect()
    return {(r.i, r.j): r.v for r in sums}


@dataclass(frozen=True)
class Whitening:
    """n distinct vectors with mean ``centre + rest / n`` on the grid, and their components."""

    n: int
    centre: np.ndarray
    rest: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float = 0.0

    def whitened(self, y: np.ndarray) -> np.ndarray:
        """Centred rows on the components, scaled to unit variance."""
        shift = np.array([r / self.n for r in self.rest])
        return ((y - self.centre).astype(np.float64) - shift) @ self.vectors / np.sqrt(self.values)

    def deviations(self, y: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)^2, exactly; None beyond 64 bits."""
        away = y - self.centre
        top = self.n * (int(np.abs(away).max(initial=0)) + 1)
        if away.shape[1] * top * top < 2**63:
            terms = self.n * away - np.array(self.rest, np.int64)
            return (terms * terms).sum(axis=1).tolist()
        terms = self.n * away.astype(object) - np.array(self.rest, object)
        return [s if s < 2**63 else None for s in (terms * terms).sum(axis=1)]


def grid_rows(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, int]:
    """(vec_id, y) of the rows that take part, y = floor(64 c), all of one length; and that length."""
    vector = F.col(vector_col)
    kept = embeddings.filter(usable(vector, GRID)).select(F.col(id_col).cast("bigint").alias("vec_id"), on_grid(vector, GRID).alias("y"))
    rows = staged(kept, "whitening-rows")
    size = dimensions(rows, "y")
    return rows.select("vec_id", padded(F.col("y"), size).alias("y")), size


def fit_whitening(rows: DataFrame, size: int, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the distinct vectors of ``rows``; None where there is nothing to scale."""
    fit = staged(rows.select("y").distinct(), "whitening-fit")
    n = fit.count()
    if not n or not size:
        return None
    sums = fit.select(F.posexplode("y").alias("i", "x")).groupBy("i").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("s")).collect()
    s = {r.i: int(r.s) for r in sums}
    # Entries are centred on the whole number next to their mean; what is left of the mean is below one step.
    centre = np.array([(2 * s[i] + n) // (2 * n) for i in range(size)], np.int64)
    rest = [s[i] - n * int(centre[i]) for i in range(size)]
    gram = _summed(fit, size, lambda y: _exact_gram(y - centre), "decimal(38,0)")
    v = np.zeros((size, size))
    for (i, j), g in gram.items():
        v[i, j] = v[j, i] = (n * int(g) - rest[i] * rest[j]) / (n * n)
    trace = float(sum((n * int(gram[i, i]) - rest[i] ** 2 for i in range(size))) / (n * n))
    values, vectors = leading_components(v, components)
    real = values > size * _EPS * max(trace, 0.0)
    if not real.any():
        return None
    plain = Whitening(n, centre, rest, values[real], vectors[:, real], trace)
    return Whitening(n, centre, rest, values[real], vectors[:, real], trace, _identity_error(fit, size, plain))


def _identity_error(fit: DataFrame, size: int, w: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened fit list minus the identity."""
    k = len(w.values)
    means = _summed(fit, size, lambda y: np.diag(w.whitened(y).sum(axis=0)), "double")
    mean = np.array([means[i, i] / w.n for i in range(k)])

    def products(y: np.ndarray) -> np.ndarray:
        z = w.whitened(y) - mean
        return z.T @ z

    cov = _summed(fit, size, products, "double")
    return float(max(abs(x / w.n - (i == j)) for (i, j), x in cov.items()))


def whiten(embeddings: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """A row per remaining row and component (``RESULT``)."""
    spark = embeddings.sparkSession
    rows, size = grid_rows(embeddings, id_col, vector_col)
    fitted = fit_whitening(rows, size, components)
    if fitted is None:
        return spark.createDataFrame([], RESULT)
    shared = spark.sparkContext.broadcast(fitted)
    names = [part.split()[0] for part in RESULT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        k = len(w.values)
        for batch in batches:
            y, rows = matrix(batch.column(1), size), batch.num_rows
            ids = batch.column(0).take(pa.array(np.repeat(np.arange(rows), k)))
            deviation = pa.array(w.deviations(y), pa.int64()).take(pa.array(np.repeat(np.arange(rows), k)))
            fixed = [pa.array(np.full(rows * k, x)) for x in (w.n, w.identity_error)]
            number, share = np.tile(np.arange(1, k + 1, dtype=np.int32), rows), np.tile(w.values / w.trace, rows)
            columns = [ids, pa.array(number), fixed[0], deviation, pa.array(w.whitened(y).ravel()), pa.array(share), fixed[1]]
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(run, RESULT)
