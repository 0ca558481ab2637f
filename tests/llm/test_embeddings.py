import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from segloom.llm import embeddings

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, limit=0.93):
    def usable(v):
        return v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    unit = [np.array(v, np.float64) / np.linalg.norm(np.array(v, np.float64)) if usable(v) and lab is not None else None for _, v, lab in rows]
    n, label = [0] * len(rows), [r[0] for r in rows]
    links = []
    for i in range(len(rows)):
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and (rows[i][1] == rows[j][1] or unit[i] @ unit[j] >= limit):
                links.append((i, j))
                n[i] += 1
                n[j] += 1
    for _ in range(len(rows)):
        before = list(label)
        for i, j in links:
            label[i] = label[j] = min(label[i], label[j])
        if before == label:
            break
    return sorted((r[0], k, c, r[0] == c) for r, k, c in zip(rows, n, label, strict=True))


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(5)
    rows = []
    for k in range(12):
        centre = rng.normal(size=16)
        for i in range(25):
            v = centre + rng.normal(size=16) * (0.02 + 0.04 * (i % 8))
            rows.append((len(rows) * 2, np.float32(v).tolist(), k % 3))
    rows += [(1000 + i, rows[3][1], rows[3][2]) for i in range(40)]
    rows += [(2001, None, 1), (2002, [0.0] * 16, 1), (2003, [float("nan")] * 16, 1), (2004, [None] * 16, 1), (2005, rows[0][1], None), (2006, [], 1), (2007, [1.0, 2.0], 1), (2008, [1.0, 2.0], 1), (2009, [2.0, 4.0], 1), (2010, [float("inf")] * 16, 0)]
    return rows


def got(df, **settings):
    return sorted(tuple(r) for r in embeddings.near_vectors(df, **settings).collect())


def test_brute_force(spark, vectors, monkeypatch):
    df = spark.createDataFrame(vectors, SCHEMA).repartition(4)
    assert got(df) == brute(vectors)
    monkeypatch.setattr(embeddings, "BLOCK", 7)  # many block pairs
    monkeypatch.setattr(embeddings, "_GROUP", 50)
    assert got(df) == brute(vectors)


def test_recall_of_the_index(spark, sf):
    """Links found through shared reference points, against all pairs."""
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [tuple(r) for r in df.collect()]
    want, found = brute(rows), got(df)
    links = sum(r[1] for r in want)
    assert sum(min(a[1], b[1]) for a, b in zip(want, found, strict=True)) >= 0.9 * links
    assert all(b[1] <= a[1] for a, b in zip(want, found, strict=True))


def test_odd_tables(spark, vectors):
    assert got(spark.createDataFrame([], SCHEMA)) == []
    none = [(1, None, 1), (2, [0.0], 1), (None, None, None)]
    assert [tuple(r) for r in embeddings.near_vectors(spark.createDataFrame(none, SCHEMA)).orderBy("vec_id").collect()] == [(None, 0, None, True), (1, 0, 1, True), (2, 0, 2, True)]
    small = vectors[:60]
    clash = spark.createDataFrame(small, SCHEMA).withColumns({c: F.lit("x") for c in ("node", "vector", "count", "pivot", "first", "component", "e", "block", "kept")})
    assert got(clash) == brute(small)
    twice = spark.createDataFrame([*small[:3], small[0]], SCHEMA)
    assert got(twice)[0][1] == got(twice)[1][1] >= 1


def test_extreme_lengths(spark):
    rows = [(1, [1e38, 1e38], 0), (2, [1e-38, 1e-38], 0), (3, [-1.0, 1.0], 0)]
    assert got(spark.createDataFrame(rows, SCHEMA)) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]
