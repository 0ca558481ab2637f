"""The nearest-neighbour join by reference points against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from segloom.operators import distance as D

SCHEMA = "g string, k long, v array<double>"


def brute(rows):
    out = {}
    for g in {r[0] for r in rows}:
        own = sorted(((k, np.array(v, float)) for h, k, v in rows if h == g), key=lambda r: r[0])
        keys = [k for k, _ in own]
        x = np.array([v / (np.linalg.norm(v) or 1.0) for _, v in own])
        d = 1 - x @ x.T
        np.fill_diagonal(d, np.inf)
        for i, k in enumerate(keys):
            if len(keys) > 1:
                out[g, k] = d[i].min()
    return out


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    out = []
    for g, centres in (("a", 9), ("b", 3), ("c", 1)):
        middle = rng.normal(size=(centres, 6))
        for k in range(40 * centres):
            out.append((g, len(out), (middle[k % centres] + 0.2 * rng.normal(size=6)).tolist()))
    out += [("a", 9000 + i, out[3][2]) for i in range(20)] + [("a", 9100, (np.array(out[3][2]) * 2).tolist())]  # copies, and one of another length
    out += [("b", 9200, [0.0] * 6), ("b", 9201, [0.0] * 6), ("d", 9300, [1.0] * 6), ("e", 9400, [0.0] * 6), ("e", 9401, [1.0] * 6)]
    return out


@pytest.mark.parametrize(("block", "pivots"), [(1024, 256), (16, 256), (16, 3), (1, 1)])
def test_all_pairs(spark, rows, block, pivots):
    if (block, pivots) == (1, 1):
        rows = rows[:30] + rows[-5:]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = D.cosine_nearest(df, ["g"], "k", "v", block, pivots).collect()
    want = brute(rows)
    vector = {(g, k): np.array(v) / (np.linalg.norm(v) or 1.0) for g, k, v in rows}
    assert sorted((r.g, r.k) for r in got) == sorted(want)
    for r in got:
        assert r.distance == pytest.approx(want[r.g, r.k], abs=1e-9)
        assert r.neighbour != r.k and 1 - vector[r.g, r.k] @ vector[r.g, r.neighbour] == pytest.approx(r.distance, abs=1e-9)


def test_few_cells_are_visited(spark):
    """20,000 vectors around 200 centres: the bound leaves few of the visits."""
    rng = np.random.default_rng(8)
    middle = rng.normal(size=(200, 16))
    x = middle[rng.integers(0, 200, 20_000)] + 0.1 * rng.normal(size=(20_000, 16))
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate(x.tolist())], SCHEMA)
    seen = []
    got = D.cosine_nearest(df, ["g"], "k", "v", block=256, watch=lambda *n: seen.append(n))
    low = got.agg(F.max("distance")).first()[0]
    assert got.count() == 20_000 and low < 0.5
    visits, every = seen[0]
    assert visits < 0.05 * every, seen
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    some = {r.k: r.distance for r in got.filter("k % 400 = 7").collect()}
    for k, d in some.items():
        e = 1 - u @ u[k]
        e[k] = 9
        assert d == pytest.approx(e.min(), abs=1e-9)


def test_empty(spark):
    assert D.cosine_nearest(spark.createDataFrame([], SCHEMA), ["g"], "k", "v").collect() == []
