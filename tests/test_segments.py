import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from segloom.config import AXES, CELL, DEFAULT_CONFIG, HYBRID, MISSING, TUNED_CONFIG, SegmentConfig
from segloom.operators import density as DN
from segloom.operators import distance as D
from segloom.operators import kmeans as K
from segloom.operators import linkage as L
from segloom.operators import merge as MG
from segloom.operators import stats as S
from segloom.plans import segment as SG
from segloom.plans import views as V

Q = MISSING


def plain_gower(a, b, weights):
    top = bottom = 0.0
    for x, y, w in zip(a, b, weights):
        if x == Q and y == Q:
            continue
        if x == Q or y == Q:
            top, bottom = top + w * 0.35, bottom + w * 0.5
        else:
            top, bottom = top + w * (x != y), bottom + w
    return top / bottom if bottom else 0.0


def test_gower_values(spark):
    pairs = [
        (("S", "P", "N", Q, "x", "y"), ("O", "P", Q, Q, "x", "z"), 2.05 / 3.5),
        (("S", Q, Q, Q, "a", "a"), (Q, Q, Q, Q, "a", "b"), 0.7),
        (("S", "P", Q, Q, "a", "a"), (Q, Q, "N", "C", "a", "a"), 0.7),
        (("S", "P", "N", "C", "a", "b"), ("S", "P", "N", "C", "c", "d"), 0.0),
        (("S", "P", "N", "C", "a", "b"), ("T", "R", "M", "D", "a", "b"), 1.0),
        ((Q, Q, Q, Q, "a", "b"), (Q, Q, Q, Q, "c", "d"), 0.0),
    ]
    names = [f"l{i}" for i in range(6)] + [f"r{i}" for i in range(6)]
    df = spark.createDataFrame([(*a, *b, w) for a, b, w in pairs], names + ["want"])
    d = D.gower([F.col(f"l{i}") for i in range(6)], [F.col(f"r{i}") for i in range(6)])
    for row in df.select(d.alias("d"), "want").collect():
        assert row["d"] == pytest.approx(row["want"])


def random_profile(rng, sizes):
    """(values, codes): MISSING or a value per axis, None or its code."""
    codes = [rng.choice([None, *range(n)]) for n in sizes.values()]
    return [Q if c is None else str(c) for c in codes], codes


def counts_of(codes, sizes, n=1.0):
    width, offset, marks = 1 + sum(sizes.values()), 1, [0]
    pattern = sum(1 << k for k, c in enumerate(codes) if c is not None)
    for c, size in zip(codes, sizes.values()):
        if c is not None:
            marks.append(offset + c)
        offset += size
    return {pattern * width + p: n for p in marks}


def test_counts_give_sums_of_distances(monkeypatch):
    sizes, weights = {"a": 3, "b": 2, "c": 4}, [1.0, 3.0, 2.0]
    form = D.GowerForm(sizes, weights)
    rng = random.Random(1)
    for chunk in (1024, 3):
        monkeypatch.setattr(D.GowerForm, "_CHUNK", chunk)
        groups = [[random_profile(rng, sizes) for _ in range(rng.randint(1, 6))] for _ in range(30)]
        rows = []
        for group in groups:
            total = {}
            for _, codes in group:
                for slot, n in counts_of(codes, sizes).items():
                    total[slot] = total.get(slot, 0) + n
            rows.append({"slots": list(total), "amounts": list(total.values())})
        frame = pd.DataFrame(rows)
        got = form.totals(frame[:11], frame[11:])
        for i, left in enumerate(groups[:11]):
            for j, right in enumerate(groups[11:]):
                assert got[i, j] == pytest.approx(sum(plain_gower(x, y, weights) for x, _ in left for y, _ in right))


def test_wide_domains_need_little_memory():
    """200 values on each of four axes: what the closure carries and what a block takes."""
    import pickle
    import tracemalloc

    sizes = dict.fromkeys("abcd", 200)
    form = D.GowerForm(sizes, [1, 1, 3, 3])
    assert len(pickle.dumps(form)) < 50_000
    rng = random.Random(2)
    counts = [counts_of(random_profile(rng, sizes)[1], sizes) for _ in range(1024)]
    frame = pd.DataFrame({"slots": [list(c) for c in counts], "amounts": [list(c.values()) for c in counts]})
    tracemalloc.start()
    form.totals(frame, frame)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200 << 20


def brute_linkage(d, n, k=None, limit=None):
    """Clusters of average linkage on a weighted distance matrix without ties."""
    groups = [[i] for i in range(len(n))]

    def mean(a, b):
        w = np.outer(n[a], n[b])
        return float((d[np.ix_(a, b)] * w).sum() / w.sum())

    while len(groups) > (k or 1):
        height, i, j = min((mean(a, b), i, j) for i, a in enumerate(groups) for j, b in enumerate(groups) if i < j)
        if limit is not None and height >= limit:
            break
        groups[i] += groups.pop(j)
    return sorted(sorted(g) for g in groups)


def points_frame(spark, vectors, sizes):
    rows = [(0, i, float(n), [float(x * n) for x in v]) for i, (v, n) in enumerate(zip(vectors, sizes))]
    return spark.createDataFrame(rows, "g int, id long, size double, total array<double>")


@pytest.mark.parametrize("block", [1024, 7])
@pytest.mark.parametrize("seed", [0, 1])
def test_linkage_matches_brute_force(spark, block, seed):
    rng = np.random.default_rng(seed)
    vectors = rng.normal(size=(24, 5))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    sizes = rng.integers(1, 6, 24).astype(float)
    points = points_frame(spark, vectors, sizes)
    d = 1 - vectors @ vectors.T
    merges = L.average_linkage(points, ["g"], D.CosineForm(), block=block)
    assert merges.count() == 23
    for k in (1, 4, 11, 24):
        ks = spark.createDataFrame([(0, k)], "g int, k int")
        got = {}
        for r in L.cut_tree(points, merges, ["g"], ks).collect():
            got.setdefault(r["cluster"], []).append(r["id"])
        assert sorted(sorted(g) for g in got.values()) == brute_linkage(d, sizes, k)
        assert sorted(got) == list(range(k))
    if block == 1024:
        below = L.average_linkage(points, ["g"], D.CosineForm(), max_height=0.8, block=block)
        got = {}
        for r in L.cut_tree(points, below, ["g"]).collect():
            got.setdefault(r["cluster"], []).append(r["id"])
        assert sorted(sorted(g) for g in got.values()) == brute_linkage(d, sizes, limit=0.8)


def test_clusters_look_again_only_after_a_merge(spark):
    """Work per round falls, and the tree is the one of a single block."""
    rng = np.random.default_rng(9)
    vectors = rng.normal(size=(400, 6))
    points = points_frame(spark, vectors / np.linalg.norm(vectors, axis=1, keepdims=True), np.ones(400))
    looked = []
    many = L.average_linkage(points, ["g"], D.CosineForm(), max_height=0.9, block=60, watch=lambda *r: looked.append(r))
    one = L.average_linkage(points, ["g"], D.CosineForm(), max_height=0.9)
    assert {(r.a, r.b, round(r.height, 7)) for r in many.collect()} == {(r.a, r.b, round(r.height, 7)) for r in one.collect()}
    assert len(looked) >= 3 and looked[0][2] == 400
    assert all(looking < clusters for _, clusters, looking in looked[1:]), looked
    assert sum(r[2] for r in looked) < 0.9 * sum(r[1] for r in looked), looked


def test_tied_linkage_does_not_depend_on_blocks_or_partitions(spark, sf):
    rows = V.cells(spark, sf).filter("payment_group = 'n2'")
    table = SG.catalogue_table(rows)
    one = SG.build_tree(table).merges
    other = SG.build_tree(table.repartition(13), block=60).merges
    keys = [*CELL, "a", "b"]
    assert one.select(keys).exceptAll(other.select(keys)).count() == 0
    assert one.count() == other.count()


def test_raw_cluster_counts(spark):
    cells = ["model_n2", "model_n3", "model_pay", "beauty_n2", "beauty_n3", "beauty_pay", "photo_n2", "photo_pay", "photo_n3", "x_y"]
    df = spark.createDataFrame([(i, c, 1000) for i, c in enumerate(cells)], "i int, c string, n long")

    def counts(config, frame=df):
        return [r[0] for r in frame.orderBy("i").select(D.target_raw_k(F.col("c"), F.col("n"), config)).collect()]

    assert counts(TUNED_CONFIG) == [24, 10, 10, 12, 6, 3, 10, 2, 1, 1]
    assert counts(DEFAULT_CONFIG) == [16, 5, 7, 5, 3, 3, 5, 2, 1, 1]
    # a cell scale replaces the global one
    assert counts(SegmentConfig(raw_k_scale=10.0, cell_raw_k_scale={"model_n2": 1.0}))[:2] == [16, 50]
    assert counts(TUNED_CONFIG, df.withColumn("n", F.lit(4)))[0] == 4


def frame_of(spark, values, axis="purpose"):
    rows = [(v if axis == "purpose" else "P",) for v in values]
    return spark.createDataFrame(rows, "purpose string").withColumn("g", F.lit(0))


@pytest.mark.parametrize(
    ("values", "want"),
    [
        (["A"] * 7 + ["B"] * 3, "A"),
        (["A"] * 6 + ["B"] * 4, HYBRID),
        ([MISSING] * 6 + ["A"] * 4, MISSING),
        (["B", "A"], HYBRID),
        (["A"] * 7 + [None] * 3, "A"),
        (["A"] * 6 + [None] * 4, HYBRID),
        (["A"], "A"),
    ],
)
def test_dominant(spark, values, want):
    assert S.dominants(frame_of(spark, values), ["g"], ["purpose"]).first()["dom_purpose"] == want


def absorbed(spark, segments, min_size=10):
    rows = [("m", "x", i, list(k), n) for i, (k, n) in enumerate(segments)]
    df = spark.createDataFrame(rows, "job_type string, payment_group string, first_cluster int, merge_key array<string>, n long")
    out = MG.absorb_small(df, min_size=min_size).groupBy("into").agg(F.sum("n").alias("n")).collect()
    return {segments[r["into"]][0]: r["n"] for r in out}


def test_absorb_values(spark):
    assert absorbed(spark, [(("P", "S", "N"), 8), (("P", "O", "N"), 40), (("Q", "S", "W"), 60)]) == {("P", "O", "N"): 48, ("Q", "S", "W"): 60}
    tie = [(("P", "S", "N", "펌"), 4), (("P", "S", "N", "any"), 7), (("Q", "S", "W"), 60), (("P", "O", "N", "펌", "any"), 30)]
    assert absorbed(spark, tie) == {("Q", "S", "W"): 60, ("P", "O", "N", "펌", "any"): 41}
    assert absorbed(spark, [(("P",), 4), (("Q",), 5)]) == {("Q",): 9}
    assert absorbed(spark, [(("P",), 4)]) == {("P",): 4}
    # two equal targets: the earlier one
    assert absorbed(spark, [(("A", "x"), 20), (("B", "x"), 20), (("C", "x"), 3)]) == {("A", "x"): 23, ("B", "x"): 20}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.tuples(st.sampled_from("ABC"), st.sampled_from("xy"), st.sampled_from("pq")), st.integers(1, 40), min_size=1, max_size=9))
def test_absorb_keeps_rows(spark, segments):
    out = absorbed(spark, list(segments.items()), 15)
    assert sum(out.values()) == sum(segments.values())
    assert len(out) == 1 or min(out.values()) >= 15


def catalogue_rows(spark, rows):
    schema = "id int, job_type string, payment_group string, " + ", ".join(f"{a} string" for a in AXES)
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], schema)


def test_special_cells(spark):
    rows = [
        ("model", "n3", "S", "P", "N", Q, "any", Q),  # the only usable row of its cell
        ("model", "n3", Q, Q, Q, Q, "any", "once"),  # info-poor in spite of explicit career
        ("beauty", "pay", "S", Q, "N", Q, Q, Q),
        ("photo", "n3", "S", "P", Q, "컷", Q, Q),
        ("photo", "n3", "O", "P", Q, "컷", Q, Q),
        ("photo", "n3", Q, Q, Q, Q, Q, Q),
        ("beauty", "n2", Q, Q, Q, Q, Q, Q),  # all info-poor
        ("other", "n2", "S", "P", "N", Q, Q, Q),  # unsupported type
    ]
    out = SG.build_catalogue(catalogue_rows(spark, rows)).rows
    got = {r["id"]: (r["segment_id"], r["segment_key"], r["raw_cluster_id"]) for r in out.collect()}
    assert got == {
        0: (0, "P·S·N", 0),
        1: (-1, "정보 부족형", -1),
        2: (0, "단일·부분정보", 0),
        3: (0, "P", 0),
        4: (0, "P", 0),
        5: (-1, "정보 부족형", -1),
        6: (-1, "정보 부족형", -1),
    }


def test_more_clusters_than_profiles(spark):
    rows = [("model", "n2", p, "P", "N", "C", Q, Q) for p in "SOH" for _ in range(12)]
    out = SG.build_catalogue(catalogue_rows(spark, rows)).rows
    assert out.select("raw_cluster_id").distinct().count() == 3
    assert out.groupBy("segment_id").count().count() == 3


def test_catalogue_covers_all_rows(spark, sf):
    rows = V.cells(spark, sf)
    built = SG.build_catalogue(rows, TUNED_CONFIG)
    assert built.rows.count() == rows.count()
    sizes = built.rows.groupBy(*CELL, "segment_id").count().filter("segment_id <> -1")
    small = sizes.filter("count < 25").join(sizes.groupBy(*CELL).agg(F.count("*").alias("k")), [*CELL]).filter("k > 1")
    assert small.count() == 0
    # every cell has at most its number of clusters, and its ids are dense
    dense = sizes.groupBy(*CELL).agg(F.max("segment_id").alias("m"), F.count("*").alias("k"))
    assert dense.filter("m <> k - 1").count() == 0


def test_split_limits(spark):
    def rows(n_missing, n_other, purpose="P"):
        place = [MISSING] * n_missing + ["S"] * n_other
        data = [("model", "n2", 0, "k", purpose, p, "N", Q, Q, Q) for p in place]
        return spark.createDataFrame(data, "job_type string, payment_group string, segment_id int, segment_key string, purpose string, place string, topic string, treatment string, career string, continuity string")

    def keys(df):
        out, log = MG.split_by_place(df, SegmentConfig(split_min_segment=100))
        return {(r["segment_id"], r["segment_key"]): r["count"] for r in out.groupBy("segment_id", "segment_key").count().collect()}, log.count()

    assert keys(rows(30, 90)) == ({(0, "P·S·N"): 90, (1, "P·N·장소미기재"): 30}, 1)  # ratio exactly .25, part exactly 30
    assert keys(rows(29, 80)) == ({(0, "k"): 109}, 0)  # part too small
    assert keys(rows(40, 59)) == ({(0, "k"): 99}, 0)  # segment too small
    assert keys(rows(40, 60)) == ({(0, "k"): 100}, 0)  # hybrid place
    assert keys(rows(60, 40)) == ({(0, "P·S·N"): 40, (1, "P·N·장소미기재"): 60}, 1)  # missing place dominates


def test_elbows(spark):
    def elbow(ys, xs=None):
        xs = xs or range(4, 4 + len(ys))
        df = spark.createDataFrame([(0, x, float(y)) for x, y in zip(xs, ys)], "g int, x int, y double")
        return K.kneedle(df, ["g"], "x", "y").first()["elbow"]

    assert elbow([0.2, 0.05, 0.01]) == 5
    assert elbow([1, 1, 1, 1]) == 4
    assert elbow([1, 2]) == 4
    assert elbow([1]) == 4


def test_k_caps(spark):
    df = spark.createDataFrame([(i, c) for i, c in enumerate([20, 10, 15, 6, 5, 3, 1, 40])], "i int, c int")
    assert [r[0] for r in df.orderBy("i").select(K.derive_k_cap(F.col("c"))).collect()] == [10, 5, 7, 3, 2, 2, 1, 15]


def test_silhouette_matches_brute_force(spark):
    rng = random.Random(3)
    rows = [(0, i, rng.choice("AB" + Q[:1]), rng.choice("xyz"), rng.randint(1, 4), rng.randint(0, 2)) for i in range(20)]
    rows = [(g, i, Q if a == Q[:1] else a, b, n, c) for g, i, a, b, n, c in rows]
    df = spark.createDataFrame(rows, "g int, pid int, a string, b string, n int, cluster int")
    flat = [(a, b, c) for _, _, a, b, n, c in rows for _ in range(n)]

    def dist(p, q):
        return sum(0 if x == y else 2 - (x == Q) - (y == Q) for x, y in zip(p[:2], q[:2])) ** 0.5

    scores = []
    for i, p in enumerate(flat):
        by = {}
        for j, q in enumerate(flat):
            if i != j:
                by.setdefault(q[2], []).append(dist(p, q))
        if p[2] not in by:
            scores.append(0.0)
            continue
        a, b = np.mean(by.pop(p[2])), min(np.mean(v) for v in by.values())
        scores.append((b - a) / max(a, b) if max(a, b) else 0.0)
    for block in (1024, 6):
        got = K.silhouette(df, ["g"], ["a", "b"], drop_missing=True, block=block).first()["silhouette"]
        assert got == pytest.approx(np.mean(scores))


def test_spanning_tree_weight(spark):
    rng = random.Random(5)
    seen = sorted({(rng.choice("ABCD"), rng.choice("xyz"), rng.choice("pqr")) for _ in range(30)})
    rows = [(0, i, *v, rng.randint(1, 3), 4, 2) for i, v in enumerate(seen)]
    df = spark.createDataFrame(rows, "g int, pid int, a string, b string, c string, n int, mcs int, min_samples int")
    axes = ["a", "b", "c"]
    n = [r[5] for r in rows]

    def square(i, j):
        return 2 * sum(x != y for x, y in zip(seen[i], seen[j]))

    def core(i):
        total = 0
        for level in (0, 2, 4, 6):
            total = sum(n[j] for j in range(len(seen)) if square(i, j) <= level)
            if total >= 2:
                return level

    cores = [core(i) for i in range(len(seen))]
    got = DN.core_squares(df, ["g"], axes, block=5)
    assert {r["pid"]: r["core"] for r in got.collect()} == dict(enumerate(cores))
    edges = sorted((max(square(i, j), cores[i], cores[j]), i, j) for i in range(len(seen)) for j in range(i))
    owner, want = list(range(len(seen))), 0
    for w, i, j in edges:
        a, b = owner[i], owner[j]
        if a != b:
            owner, want = [a if o == b else o for o in owner], want + w
    tree = DN.spanning_tree(got, ["g"], axes, block=5).collect()
    assert len(tree) == len(seen) - 1
    assert sum(r["level"] for r in tree) == want


def test_density_clusters_of_two_groups(spark):
    near = [("A", "x", "p", 8), ("A", "x", "q", 7), ("A", "y", "p", 6)]
    far = [("B", "z", "s", 9), ("B", "z", "t", 7), ("B", "w", "s", 6)]
    rows = [("c", a, b, c) for a, b, c, n in [*near, *far, ("C", "v", "u", 1)] for _ in range(n)]
    df = spark.createDataFrame(rows, "g string, a string, b string, c string")
    out = DN.density_clusters(df, ["a", "b", "c"], by=["g"], min_sizes={"c": 15}).collect()
    label = {(r["a"], r["b"], r["c"]): r["cluster"] for r in out}
    assert len({label[v[:3]] for v in near}) == 1 and len({label[v[:3]] for v in far}) == 1
    assert label[near[0][:3]] != label[far[0][:3]]
    assert label[("C", "v", "u")] == -1
    few = DN.density_clusters(df, ["a", "b", "c"], by=["g"], min_sizes={"c": 500})
    assert few.filter("cluster <> -1").count() == 0


def test_key_similarity(spark):
    df = spark.createDataFrame([(["a", "b"], ["a", "c", "b"]), (["a", "b", "c"], ["a", "b", "c"]), ([], ["a"])], "x array<string>, y array<string>")
    assert [r[0] for r in df.select(MG.key_similarity("x", "y")).collect()] == [1, 3, 0]


def test_absorbed_count(spark, sf):
    rows = V.assigned(spark, sf)
    out = MG.absorb_ambiguous(rows)
    gained = out.filter("segment_id = -1").count() - rows.filter("segment_id = -1").count()
    assert MG.absorbed_count(rows, out).first()["n_absorbed"] == gained
