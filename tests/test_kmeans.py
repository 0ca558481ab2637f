"""k-means of many runs at once, against all partitions of a few profiles."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from segloom.config import MISSING
from segloom.operators import kmeans as K

ROWS = [
    ("A", "x", 0, "p", "q", 5), ("A", "x", 1, "p", "r", 3), ("A", "x", 2, "s", "q", 1), ("A", "x", 3, MISSING, "q", 4), ("A", "x", 4, "s", "r", 7),
    ("A", "x", 5, "t", MISSING, 2), ("A", "x", 6, "t", "u", 6), ("A", "x", 7, MISSING, MISSING, 1),
    ("B", "x", 0, "p", "p", 9), ("B", "x", 1, "q", "q", 9), ("B", "x", 2, "p", "q", 2), ("C", "x", 0, "p", "q", 2), ("D", "x", 0, MISSING, MISSING, 50), ("D", "x", 1, None, MISSING, 5),
]
AXES = ["place", "topic"]


@pytest.fixture(scope="module")
def profiles(spark):
    return spark.createDataFrame(ROWS, "job_type string, payment_group string, pid int, place string, topic string, n long").repartition(3)


def vectors(cell):
    rows = [r for r in ROWS if r[0] == cell]
    values = sorted({(i, r[i]) for r in rows for i in (3, 4)} - {(3, MISSING), (4, MISSING)})
    x = np.array([[float(r[i] == v) for i, v in values] for r in rows])
    return x, np.array([r[5] for r in rows], float)


def cost(x, n, labels):
    out = 0.0
    for c in set(labels):
        own = np.flatnonzero(np.array(labels) == c)
        centre = (x[own] * n[own, None]).sum(0) / n[own].sum()
        out += (((x[own] - centre) ** 2).sum(1) * n[own]).sum()
    return out


@pytest.mark.parametrize(("cell", "k"), [("A", 2), ("A", 3), ("B", 2)])
def test_best_of_seeds_is_the_best_partition(profiles, cell, k):
    x, n = vectors(cell)
    runs = [((cell, "x"), k, s) for s in range(20)]
    got = K.kmeans_runs(profiles, AXES, runs).groupBy("seed").agg(F.array_sort(F.collect_list(F.struct("pid", "cluster"))).alias("l")).collect()
    found = [cost(x, n, [p["cluster"] for p in r["l"]]) for r in got]
    best = min(cost(x, n, labels) for labels in itertools.product(range(k), repeat=len(x)) if len(set(labels)) == k)
    assert len(found) == 20 and min(found) == pytest.approx(best)


def test_runs_are_independent_of_partitions_and_of_each_other(profiles):
    rows = lambda df: sorted(map(tuple, df.select("job_type", "pid", "k", "seed", "cluster").collect()))
    runs = [(("A", "x"), k, s) for k in (2, 3) for s in (0, 1)] + [(("B", "x"), 2, 0)]
    assert rows(K.kmeans_runs(profiles, AXES, runs)) == rows(K.kmeans_runs(profiles.repartition(1), AXES, runs))


def test_cells_that_are_one_cluster(profiles):
    runs = [(("A", "x"), 1, 0), (("C", "x"), 2, 0), (("D", "x"), 3, 0), (("B", "x"), 2, 0)]
    got = K.kmeans_runs(profiles, AXES, runs)
    assert {r["job_type"]: r["c"] for r in got.groupBy("job_type").agg(F.countDistinct("cluster").alias("c")).collect()} == {"A": 1, "B": 2, "C": 1, "D": 1}
    assert K.kmeans_runs(profiles, AXES, []) is None
