"""Whitening of embeddings by the leading components of their covariance, found by contour integration.

Vectors are taken on a grid of 1/256 (whole numbers x); the statistics are over
every distinct grid vector once. Two passes over that list give the exact sums
and the covariance, centred before multiplying, from one partial matrix per
task. The components come from the matrix alone (one row and column per
dimension, so its size does not depend on the rows):

1. inertia counts: the signs of the pivots of a shifted, tridiagonalised matrix
   say how many eigenvalues lie below a shift; bisecting on them places an
   interval that holds the leading eigenvalues and ends in a wide gap;
2. contour integration: a quadrature over a circle around the interval of solves
   with the complex shifted covariance projects a block of vectors onto the
   eigenvectors inside;
3. Rayleigh-Ritz on the projected block gives values and vectors; 2 and 3 repeat
   until the residuals are at rounding level;
4. as many values as the inertia count says must lie in the interval, otherwise
   the block grows and the search starts again.

A second job applies the components to all rows, duplicates included.

Cases: rows whose vector is null, empty, or holds null or non-finite entries are
left out; entries too large for a long are the nearest long; vectors of
different lengths are fitted and whitened length by length; a component without
variance (all vectors equal, or fewer vectors than dimensions) has a null
`whitened`, and counts neither for `identity_error` nor as explained; a
`deviation` beyond a long is null; rows that repeat a vec_id, or have none, are
rows of their own; an empty table gives an empty table; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segloom.llm.common import query, table
from segloom.runtime import cut

COMPONENTS = 4
GRID = 256
NODES = 8  # quadrature points on the upper half of the circle
SPARE = 8  # eigenvalues beyond those asked for among which the interval may end
ROUNDS = 60
RESIDUAL = 2e-14  # of the largest eigenvalue
_LONG = 2**63
SCHEMA = "component int, n long, deviation long, whitened double, explained double, identity_error double"


# --- eigenvalues of one symmetric matrix


def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and next diagonal of a tridiagonal matrix with the same inertia at every shift (Householder reflections)."""
    a = v.copy()
    d = len(a)
    for k in range(d - 2):
        x = a[k + 1 :, k]
        size = np.linalg.norm(x)
        if size <= np.abs(x[0]):
            continue  # nothing below
        u = x.copy()
        u[0] += np.copysign(size, x[0])
        u /= np.linalg.norm(u)
        rest = a[k + 1 :, k + 1 :]
        p = rest @ u
        p -= u * (u @ p)
        rest -= 2 * (np.outer(u, p) + np.outer(p, u))
        a[k + 1 :, k] = a[k, k + 1 :] = 0
        a[k + 1, k] = a[k, k + 1] = -np.copysign(size, x[0]) if size else 0.0
    return np.diag(a).copy(), np.diag(a, 1).copy()


def inertia(diagonal: np.ndarray, beside: np.ndarray, shift: float) -> int:
    """Number of eigenvalues below the shift: negative pivots of the shifted matrix."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    squares = np.concatenate([[0.0], beside * beside]).tolist()
    pivot, count = 1.0, 0
    for x, s in zip(diagonal.tolist(), squares, strict=True):
        pivot = x - shift - s / pivot
        if abs(pivot) < tiny:
            pivot = -tiny
        count += pivot < 0
    return count


def _interval(diagonal: np.ndarray, beside: np.ndarray, want: int) -> tuple[float, float, int]:
    """(low, high, number): an interval with the `want` largest eigenvalues that ends in a wide gap below."""
    d = len(diagonal)
    around = np.concatenate([[0.0], np.abs(beside)]) + np.concatenate([np.abs(beside), [0.0]])
    bottom, top = float((diagonal - around).min()), float((diagonal + around).max())
    wide = max(top - bottom, abs(top) * 1e-6)
    bottom, top = bottom - 1e-3 * wide, top + 1e-3 * wide

    def nth(k: int) -> float:
        """The k-th largest eigenvalue, by bisection."""
        lo, hi = bottom, top
        for _ in range(36):
            mid = (lo + hi) / 2
            if d - inertia(diagonal, beside, mid) >= k:
                lo = mid
            else:
                hi = mid
        return (lo + hi) / 2

    values = [nth(k) for k in range(1, min(d, want + SPARE) + 1)]
    high = values[0] + 0.05 * max(values[0] - values[-1], 1e-6 * wide)
    if len(values) == d:
        # Everything is at hand: the interval may hold all eigenvalues.
        values.append(bottom - wide)
    gaps = [(values[k - 1] - values[k]) / (high - values[k]) for k in range(want, len(values))]
    at = want + int(np.argmax(gaps))
    low = (values[at - 1] + values[at]) / 2
    return low, high, d - inertia(diagonal, beside, low)


def components(v: np.ndarray, want: int) -> tuple[np.ndarray, np.ndarray]:
    """The `want` largest eigenvalues, falling, and their unit eigenvectors as columns."""
    d = len(v)
    want = min(want, d)
    scale = float(np.trace(v))
    if scale <= 0:
        return np.zeros(want), np.eye(d)[:, :want]
    a = (v + v.T) / (2 * scale)
    diagonal, beside = tridiagonal(a)
    low, high, number = _interval(diagonal, beside, want)
    centre, radius = (low + high) / 2, (high - low) / 2
    points, weights = np.polynomial.legendre.leggauss(NODES)
    turns = np.exp(0.5j * np.pi * (1 + points))
    largest = high
    rng = np.random.default_rng(0)
    size = min(d, 2 * number + 8)
    while True:
        block = rng.normal(size=(d, size))
        best = np.inf
        for _ in range(ROUNDS):
            projected = np.zeros((d, size))
            for turn, weight in zip(turns, weights, strict=True):
                shifted = (centre + radius * turn) * np.eye(d) - a
                projected += 0.5 * weight * (radius * turn * np.linalg.solve(shifted, block.astype(complex))).real
            basis = np.linalg.qr(projected)[0]
            values, turned = np.linalg.eigh(basis.T @ a @ basis)
            block = basis @ turned
            inside = np.flatnonzero((values > low) & (values < high))
            if len(inside) != number:
                continue
            rest = np.linalg.norm(a @ block[:, inside] - block[:, inside] * values[inside], axis=0).max()
            if rest <= RESIDUAL * largest or (rest >= best / 2 and rest <= 1e-12 * largest):
                order = inside[np.argsort(-values[inside], kind="stable")][:want]
                vectors = block[:, order]
                return np.maximum(values[order], 0) * scale, vectors / np.linalg.norm(vectors, axis=0)
            best = min(best, rest)
        if size == d:
            raise ArithmeticError("the contour holds fewer components than the inertia count says")
        size = min(d, 2 * size)


# --- statistics of the list


def usable(embedding: Column) -> Column:
    """Whether a vector takes part."""
    bad = F.exists(embedding, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    return embedding.isNotNull() & (F.size(embedding) > 0) & ~F.coalesce(bad, F.lit(False))


def on_grid(embedding: Column) -> Column:
    return F.transform(embedding, lambda c: F.floor(c.cast("double") * GRID))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()) if len(column) else np.zeros((0, 0), np.int64)


@dataclass
class Fit:
    n: int
    sums: list[int]  # exact, per dimension
    values: np.ndarray  # eigenvalues of the components, falling
    vectors: np.ndarray  # one column per component
    trace: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([float(Fraction(s, self.n)) for s in self.sums])

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """One column per component, NaN where it has no variance."""
        with np.errstate(divide="ignore", invalid="ignore"):
            scale = np.where(self.has_variance(), 1 / np.sqrt(self.values), np.nan)
        return (x - self.mean) @ self.vectors * scale

    def has_variance(self) -> np.ndarray:
        return self.values > 1e-13 * max(self.trace, 0.0)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of (n*x - S)^2; None beyond a long."""
        largest = max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0
        reach = self.n * largest + max(abs(s) for s in self.sums)
        if reach * reach * len(self.sums) < _LONG:
            centred = x * np.int64(self.n) - np.array(self.sums, np.int64)
            return (centred * centred).sum(1).tolist()
        exact = [sum((self.n * int(c) - s) ** 2 for c, s in zip(row, self.sums, strict=True)) for row in x]
        return [e if e < _LONG else None for e in exact]


def _sums(vectors: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and exact sums per dimension, from one partial sum per task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, total = 0, None
        for batch in batches:
            x = _matrix(batch["x"])
            if not len(x):
                continue
            high = x >> 32  # two halves, so that neither sum overflows
            part = (high.sum(0).astype(object) << 32) + (x - (high << 32)).sum(0).astype(object)
            n, total = n + len(x), part if total is None else total + part
        if total is not None:
            yield pd.DataFrame({"place": range(-1, len(total)), "part": [str(n), *map(str, total)]})

    parts = vectors.mapInPandas(run, "place int, part string").groupBy("place").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total"))
    got = {r["place"]: int(r["total"]) for r in parts.collect()}  # a row per dimension
    return got[-1], [got[k] for k in range(len(got) - 1)]


def _products(vectors: DataFrame, mapped) -> np.ndarray:
    """Sum of y'y over all vectors, y = mapped(x); one partial matrix per task, added entry by entry."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            if len(batch):
                y = mapped(_matrix(batch["x"]))
                total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            yield pd.DataFrame({"i": range(len(total)), "row": list(total)})

    parts = vectors.mapInPandas(run, "i int, row array<double>").select("i", F.posexplode("row").alias("j", "part"))
    got = parts.groupBy("i", "j").agg(F.sum("part").alias("total")).toPandas()  # an entry per pair of dimensions
    size = int(got["i"].max()) + 1
    out = np.zeros((size, size))
    out[got["i"], got["j"]] = got["total"]
    return out


def fit(vectors: DataFrame, components_: int = COMPONENTS) -> tuple[Fit, float]:
    """The fit over `vectors` (column x, distinct, of one length) and its identity error."""
    n, sums = _sums(vectors)
    mean = np.array([float(Fraction(s, n)) for s in sums])
    covariance = _products(vectors, lambda x: x - mean) / n
    values, axes = components(covariance, components_)
    model = Fit(n, sums, values, axes, float(np.trace(covariance)))
    some = model.has_variance()
    if not some.any():
        return model, 0.0
    # A column of ones beside the whitened ones gives their means.
    moments = _products(vectors, lambda x: np.column_stack([model.whitened(x)[:, some], np.ones(len(x))])) / n
    centred = moments[:-1, :-1] - np.outer(moments[:-1, -1], moments[:-1, -1])
    return model, float(np.abs(centred - np.eye(int(some.sum()))).max())


def whitened(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components_: int = COMPONENTS) -> DataFrame:
    """A row per usable vector and component: see the module's docstring and SCHEMA."""
    kind = rows.schema[vec_id].dataType.simpleString()
    grid = rows.where(usable(F.col(embedding))).select(F.col(vec_id).alias("vec_id"), on_grid(F.col(embedding)).alias("x"))
    vectors = cut(grid.select("x").distinct())
    out = rows.sparkSession.createDataFrame([], f"vec_id {kind}, {SCHEMA}")
    for (length,) in vectors.select(F.size("x")).distinct().collect():  # lengths of vectors: one, as a rule
        model, error = fit(vectors.where(F.size("x") == length), components_)
        out = out.unionAll(_applied(grid.where(F.size("x") == length), model, error, kind))
    return out


def _applied(grid: DataFrame, model: Fit, error: float, kind: str) -> DataFrame:
    explained = np.where(model.has_variance(), model.values / model.trace if model.trace > 0 else 0.0, 0.0)
    count = len(model.values)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = _matrix(batch["x"])
            if not len(x):
                continue
            y = model.whitened(x)
            yield pd.DataFrame(
                {
                    "vec_id": batch["vec_id"].repeat(count).array,
                    "component": np.tile(np.arange(1, count + 1, dtype=np.int32), len(x)),
                    "n": model.n,
                    "deviation": pd.array([e for e in model.deviations(x) for _ in range(count)], dtype="Int64"),
                    "whitened": pd.array([None if v != v else v for v in y.ravel().tolist()], dtype="Float64"),
                    "explained": np.tile(explained, len(x)),
                    "identity_error": error,
                }
            )

    return grid.mapInPandas(run, f"vec_id {kind}, {SCHEMA}")


@query("op12_embedding_whitening")
def op12_embedding_whitening(spark, sf_dir):
    """All embeddings on their four leading components."""
    return whitened(table(spark, sf_dir, "embeddings"))
