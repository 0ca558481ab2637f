import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from segloom.llm import whitening

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, want=4):
    """Rows of the contract, by a dense eigenvalue routine."""
    used = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    distinct = np.array(sorted({tuple(x) for _, x in used}), float)
    n, sums = len(distinct), [int(s) for s in distinct.sum(0)]
    centred = distinct - distinct.mean(0)
    v = centred.T @ centred / n
    values, vectors = np.linalg.eigh(v)
    out = {}
    for i, x in used:
        dev = sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
        for k in range(1, min(want, len(sums)) + 1):
            out.setdefault((i, k), []).append((n, dev, abs((np.array(x) - distinct.mean(0)) @ vectors[:, -k]) / math.sqrt(values[-k]), values[-k] / np.trace(v)))
    return out


def check(df, rows):
    want, got = brute(rows), {}
    for r in df.collect():
        got.setdefault((r.vec_id, r.component), []).append(r)
    assert {k: len(v) for k, v in got.items()} == {k: len(v) for k, v in want.items()}
    for key, found in got.items():
        for r, (n, dev, size, share) in zip(found, want[key], strict=True):
            assert (r.n, r.deviation) == (n, dev)
            assert abs(r.whitened) == pytest.approx(size, abs=1e-8)
            assert r.explained == pytest.approx(share, rel=1e-9)
            assert 0 <= r.identity_error < 1e-9


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(2)
    base = rng.normal(size=(300, 12)) * np.linspace(3, 0.2, 12)
    rows = [(i, np.float32(v).tolist()) for i, v in enumerate(base)]
    rows += [(1000 + i, rows[7][1]) for i in range(150)]  # copies count once
    rows += [(5, rows[9][1]), (2000, None), (2001, []), (2002, [float("nan")] * 12), (2003, [1.0] * 11 + [None]), (2004, [float("inf")] + [0.0] * 11)]
    return rows


def test_brute_force(spark, vectors):
    check(whitening.whitened(spark.createDataFrame(vectors, SCHEMA).repartition(5)), vectors)


def test_given_table(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    check(whitening.op12_embedding_whitening(spark, sf), [(r.vec_id, r.embedding) for r in df.collect()])


@pytest.mark.parametrize("values", [[5, 4, 3, 2, 1, 0.5], [1.0] * 9, [3, 3, 3, 3, 3, 1, 1, 1], [2, 1, 0, 0, 0], [1e-9, 1e-10, 1e-11, 1e-12, 1e-13], [7.0], [1 + 1e-9 * k for k in range(20)], list(range(1, 120)), [1e12, 1, 1, 1, 1, 1]])
def test_components(values):
    rng = np.random.default_rng(len(values))
    q = np.linalg.qr(rng.normal(size=(len(values), len(values))))[0]
    v = q * np.array(values, float) @ q.T
    got, axes = whitening.components(v, 4)
    want = sorted(values, reverse=True)[:4]
    assert got == pytest.approx(want, rel=1e-9, abs=1e-13 * max(values))
    assert axes.T @ axes == pytest.approx(np.eye(len(want)), abs=1e-10)
    assert np.abs(v @ axes - axes * got).max() <= 1e-11 * max(values)


def test_inertia_counts():
    rng = np.random.default_rng(1)
    a = rng.normal(size=(30, 30))
    a = a + a.T
    diagonal, beside = whitening.tridiagonal(a)
    values = np.linalg.eigvalsh(a)
    for shift in np.concatenate([values - 1e-9, values + 1e-9, [-100.0, 0.0, 100.0]]):
        assert whitening.inertia(diagonal, beside, shift) == (values < shift).sum()


def test_odd_tables(spark, vectors):
    assert whitening.whitened(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whitening.whitened(spark.createDataFrame([(1, None), (2, [None])], SCHEMA)).collect() == []
    same = whitening.whitened(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0]), (None, [1.0, 2.0])], SCHEMA)).collect()
    assert sorted((r.vec_id or 0, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in same) == [(i, c, 1, 0, None, 0.0, 0.0) for i in (0, 1, 2) for c in (1, 2)]
    small = vectors[:40]
    names = ("x", "i", "j", "row", "place", "part", "n", "component", "total", "whitened")
    check(whitening.whitened(spark.createDataFrame(small, SCHEMA).withColumns({c: F.lit("x") for c in names})), small)
    # Two lengths: each has its own list.
    mixed = whitening.whitened(spark.createDataFrame([*small, (900, [1.0]), (901, [3.0])], SCHEMA))
    assert sorted((r.vec_id, r.n, r.deviation, abs(r.whitened)) for r in mixed.where("vec_id >= 900").collect()) == [(900, 2, 512**2, 1.0), (901, 2, 512**2, 1.0)]
    check(mixed.where("vec_id < 900"), small)


def test_large_entries(spark):
    rows = spark.createDataFrame([(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [0.0, 2.0])], "vec_id int, embedding array<double>")
    got = whitening.whitened(rows).collect()
    assert len(got) == 6 and all(r.deviation is None for r in got if r.vec_id < 3)
    mid = whitening.whitened(spark.createDataFrame([(1, [1e6]), (2, [-1e6]), (3, [0.0])], "vec_id int, embedding array<double>")).collect()
    assert sorted((r.vec_id, r.deviation) for r in mid) == [(1, (3 * 256 * 10**6) ** 2), (2, (3 * 256 * 10**6) ** 2), (3, 0)]
