"""Work that must not grow with repeated passes, blocks or cells."""

from __future__ import annotations

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from segloom import runtime
from segloom.config import AXES
from segloom.operators import distance as D
from segloom.operators import linkage as L
from segloom.operators import models as MD
from segloom.plans import joins_queries as JQ
from segloom.plans import views as V


def counted(df, spark):
    """The rows, and an accumulator of how many of them have been worked out."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    return df.mapInPandas(count, df.schema), seen


def test_training_reads_its_rows_once_and_keeps_no_forest_on_the_driver(spark):
    rows = spark.range(400).select(
        "id", F.lit("model").alias("job_type"), F.lit("n2").alias("payment_group"), (F.col("id") % 2).cast("int").alias("segment_id"),
        *[F.concat(F.lit(a), F.pmod(F.hash("id", F.lit(a)), F.lit(3)) + F.col("id") % 2).alias(a) for a in AXES],
    )
    rows, seen = counted(rows, spark)
    models, _, held_out = MD.train_cells(rows, trees=4)
    assert held_out.agg(F.sum("n")).first()[0] == 80
    assert seen.value == 400
    assert isinstance(models.forests, MD.SavedForests) and models.forests["model_n2"].getNumTrees == 4
    assert MD.forest().getCacheNodeIds()


def test_clusters_without_a_neighbour_below_the_limit_leave_the_rounds(spark):
    far = np.eye(90)
    close = np.zeros((20, 90))
    close[:, 0] = 1.0
    close[:, 80] = 0.1 * np.arange(20)
    vectors = np.concatenate([far[1:80], close])
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    rows = [(i, 1.0, v.tolist()) for i, v in enumerate(vectors)]
    points = spark.createDataFrame(rows, "id long, size double, total array<double>")
    watched = []
    merges = L.average_linkage(points, [], D.CosineForm(), max_height=0.5, block=12, watch=lambda *n: watched.append(n))
    assert watched[0][1] == 99 and watched[1:] and all(n <= 20 for _, n, _ in watched[1:])
    whole = L.average_linkage(points, [], D.CosineForm(), max_height=0.5)
    assert {(r.a, r.b, r.height) for r in merges.collect()} == {(r.a, r.b, r.height) for r in whole.collect()}


def test_blocks_of_a_round_grow_with_the_clusters(spark, monkeypatch):
    asked = []

    class Stop(Exception):
        pass

    def watched(rows, others, by, key, reduce, schema, block):
        asked.append(block)
        raise Stop

    monkeypatch.setattr(L, "over_blocks", watched)
    points = spark.range(400).select("id", F.lit(1.0).alias("size"), F.array(F.lit(1.0), F.col("id") * 0.01).alias("total"))
    with pytest.raises(Stop):
        L.average_linkage(points, [], D.CosineForm(), max_height=0.02, block=8)
    assert asked == [50]  # and not 8, of which every vector would be sent to 50


def unit(x):
    return x / np.linalg.norm(x, axis=1)[:, None]


def clusters_frame(spark, vectors):
    return spark.createDataFrame([(i, 1.0, v.tolist()) for i, v in enumerate(vectors)], "id long, size double, total array<double>")


def test_rounds_of_few_looking_clusters_need_no_plan_each(spark, monkeypatch):
    # Along an arc whose steps grow, one pair merges in a round, and the merged cluster is nearest to the next one.
    chain, rest = np.zeros((36, 36)), np.zeros((30, 36))
    for k in range(3):
        angle = np.cumsum(5e-5 * (1 + k / 10) * 2.2 ** np.arange(12))
        chain[k::3, 2 * k], chain[k::3, 2 * k + 1] = np.cos(angle), np.sin(angle)
    rest[np.arange(30), np.arange(6, 36)] = 1.0
    points = clusters_frame(spark, np.concatenate([chain, rest]))
    plans, watched, real = [], [], L.over_blocks

    def counted(*args):
        plans.append(args)
        return real(*args)

    monkeypatch.setattr(L, "over_blocks", counted)
    many = L.average_linkage(points, [], D.CosineForm(), max_height=0.5, block=8, watch=lambda *n: watched.append(n))
    one = L.average_linkage(points, [], D.CosineForm(), max_height=0.5)
    keys = ["round", "a", "b"]
    assert sorted(many.select(keys).collect()) == sorted(one.select(keys).collect()) and one.count() == 33
    assert len(watched) > 7 and [r for r, _, _ in watched] == list(range(1, len(watched) + 1))
    assert len(plans) == 1  # and not one for each round of more than a block


def test_rounds_in_a_task_end_where_many_look_and_go_on_over_blocks(spark, monkeypatch):
    x = unit(np.random.default_rng(5).normal(size=(300, 5)))
    points = clusters_frame(spark, np.concatenate([x, x[:40]]))  # equal vectors, too
    ways = []
    for most, block in ((8000, 30), (1 << 29, 30), (1 << 29, 1024)):
        monkeypatch.setattr(L, "ROUND_PAIRS", most)
        merges = L.average_linkage(points, [], D.CosineForm(), max_height=0.7, block=block)
        ways.append(sorted((r["round"], r.a, r.b, round(r.height, 8)) for r in merges.collect()))
    assert ways[0] == ways[1] == ways[2] and len(ways[0]) > 200


def test_single_precision_hides_no_nearest_vector(monkeypatch):
    monkeypatch.setattr(L, "TILE", 16)
    rng = np.random.default_rng(6)
    x = unit(np.repeat(rng.normal(size=(30, 9)), 5, axis=0) + 1e-6 * rng.normal(size=(150, 9)))  # heights that differ from the 9th digit on
    x = np.concatenate([x, x[:20], np.zeros((2, 9))])
    sizes = rng.integers(1, 5, len(x)).astype(float)
    all_of = L._Vectors(np.arange(len(x)) * 7, sizes, x * sizes[:, None])
    mine, form = all_of[np.arange(0, len(x), 2)], D.CosineForm()
    want = L._closest(mine.ids, mine.heights(all_of, form), all_of.ids)
    got, back = L._nearest(mine, all_of, form, np.inf, both=True)
    theirs = L._closest(all_of.ids, all_of.heights(mine, form), mine.ids)
    assert [w.tolist() for w in theirs] == [g.tolist() for g in back]
    assert [w.tolist() for w in want] == [g.tolist() for g in got]
    below = L._nearest(mine, all_of, form, 1e-12)[0]
    assert np.isfinite(below[0]).sum() == (want[0] < 1e-12).sum() > 0


def test_points_of_one_group_are_dealt_where_they_are(spark, unbroadcast):
    points = spark.range(0, 4000, 1, 8).select(F.lit(0).alias("g"), "id")
    dealt = L.over_blocks(points, points, ["g"], "id", lambda rows, others: rows, "g int, id long", 500)
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroups" in plan and not re.search(r"hashpartitioning\(g#\d+, \d+\)", plan)
    assert dealt.groupBy("id").count().filter("count <> 8").count() == 0


def test_counted_pairs_below_the_limit(spark):
    x = unit(np.random.default_rng(7).normal(size=(130, 4)))
    heights = np.round(1 - x @ x.T, 9)
    for block in (20, 1024):
        got = L.pairs_below(clusters_frame(spark, x), D.CosineForm(), 0.4, block=block).first()["n_below"]
        assert got == (np.triu(heights < 0.4, 1)).sum()


def test_pairs_are_worked_out_in_double_precision_near_the_limit_only(monkeypatch):
    monkeypatch.setattr(L, "TILE", 32)
    worked, real = [], L._Vectors.heights

    def counted(self, others, form):
        worked.append(len(self) * len(others))
        return real(self, others, form)

    monkeypatch.setattr(L._Vectors, "heights", counted)
    x = np.concatenate([np.eye(400), np.eye(400)[:3] + 0.1])
    x = L._Vectors(np.arange(403), np.ones(403), unit(x))
    assert L._below(x, x, D.CosineForm(), 0.75) == (np.triu(1 - x.sums @ x.sums.T < 0.75, 1)).sum() > 0
    assert sum(worked) < 0.05 * 403**2


def test_norm_of_a_vector_is_not_worked_out_for_each_element(spark):
    units = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],), ([],), (None,)], "v array<float>").select(D.unit_vector("v").alias("u"))
    assert [r.u for r in units.collect()] == [[0.6, 0.8], [0.0, 0.0], [], None]
    assert units._jdf.queryExecution().analyzed().toString().count("aggregate(") == 1


def test_a_vector_is_sent_once_to_the_cells_it_visits(spark, monkeypatch):
    sent = []
    real = D.over_blocks

    def watched(rows, others, *args):
        sent.append(rows.count())
        return real(rows, others, *args)

    monkeypatch.setattr(D, "over_blocks", watched)
    monkeypatch.setattr(D, "BUNDLE", 200)
    x = np.random.default_rng(8).normal(size=(600, 12))  # without structure: nearly every cell is visited
    df = spark.createDataFrame([(i, 0, v.tolist()) for i, v in enumerate(x)], "k long, g int, v array<double>")
    got = {r.k: (r.neighbour, r.distance) for r in D.cosine_nearest(df, ["g"], "k", "v", block=64).collect()}
    u = x / np.linalg.norm(x, axis=1)[:, None]
    d = 1 - u @ u.T
    np.fill_diagonal(d, np.inf)
    assert [got[i][0] for i in range(600)] == d.argmin(axis=1).tolist()
    assert max(sent) <= 600 * 4  # a vector for each of the few bundles, not for each of 40 cells


@pytest.fixture
def unbroadcast(spark):
    """Joins as of large tables: nothing is broadcast unless it is marked."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    kept = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, kept)


def test_weights_leave_the_rows_of_a_class_where_they_are(spark, unbroadcast):
    rows = spark.range(0, 4000, 1, 8).select("id", (F.col("id") % 4 == 0).cast("int").alias("y"), F.lit(1.0).alias("n"))
    weighted = MD.balanced_weights(rows, "y").groupBy(F.spark_partition_id().alias("part"), "y")
    got = weighted.agg(F.count("*").alias("n"), F.min("weight").alias("low"), F.max("weight").alias("high")).collect()
    assert {r.part for r in got} == set(range(8)) and max(r.n for r in got) == 375  # and not a class in one task
    for y, n in ((0, 3000), (1, 1000)):
        assert {w for r in got if r.y == y for w in (r.low, r.high)} == {4000 / (2 * n)}


def test_tasks_of_category_lists_do_not_grow_with_the_lines(spark, sf, unbroadcast, monkeypatch):
    monkeypatch.setattr(runtime, "TASK_ROWS", 500)
    lines = V.table(spark, sf, "lineitem").count()
    for query in (JQ.posting_categories, JQ.repeated_categories):
        rows = query(spark, sf)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert plan.count("hashpartitioning(job_posting_id") == 1 and "hashpartitioning(category_id" not in plan
        per = [r.n for r in rows.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.max("categories")).collect()]
        assert len(per) == -(-lines // 500) and sum(per) == V.table(spark, sf, "orders").count()
        assert max(per) < 2 * sum(per) / len(per)
