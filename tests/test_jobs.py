from pathlib import Path
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from segloom.config import AXES, CELL, MISSING, SegmentConfig
from segloom.operators import assigning as A
from segloom.operators import encoding as E
from segloom.operators import models as MD
from segloom.operators import quality as Q
from segloom.operators import ranking as R
from segloom.operators import report as RP
from segloom.operators import textmodels as T
from segloom.operators.joins import attach_categories, dedup_by_id
from segloom.operators.typed import attribute_types, attribute_values
from segloom.plans import views as V
from segloom.runtime import cut, scratch, scratch_path, shared_dir
from segloom.sources import readers, sinks
from segloom.streaming import assign_stream as ST


def test_required_columns(spark):
    df = spark.createDataFrame([(1,)], "id long")
    assert readers.require_columns(df, ["id"]) is df
    with pytest.raises(ValueError, match="segment_id"):
        readers.require_columns(df, ["id", "segment_id"])


def test_json_lines_skip_blank_and_broken(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"recruitId": 1, "ok": true}\n\n{"recruitId": 2, \n{"recruitId": 3}\n', encoding="utf-8")
    rows = readers.read_jsonl(spark, str(tmp_path), "recruitId long, ok boolean").orderBy("recruitId").collect()
    assert [(r["recruitId"], r["ok"]) for r in rows] == [(1, True), (3, None)]
    assert readers.read_jsonl(spark, str(tmp_path), "recruitId long, ok boolean", keep_corrupt=True).count() == 3


def test_upsert_changes_only_listed_ids(spark):
    target = spark.createDataFrame([(1, None, None), (2, 5, "v1"), (3, None, None)], "id long, segment_id int, segment_version string")
    updates = spark.createDataFrame([(1, 7, "v2", 0.5)], "id long, segment_id int, segment_version string, segment_confidence double")
    out = {r["id"]: r for r in sinks.merge_assignments(target, updates).collect()}
    assert (out[1]["segment_id"], out[1]["segment_version"]) == (7, "v2") and out[1]["segment_assigned_at"] is not None
    assert (out[2]["segment_id"], out[2]["segment_version"], out[2]["segment_assigned_at"]) == (5, "v1", None)
    assert out[3]["segment_id"] is None


def test_upsert_rewrites_touched_buckets_only(spark):
    path = scratch_path(spark, "bucketed")
    target = spark.range(5000).withColumns({"segment_id": F.when(F.col("id") % 3 == 0, 4), "title": F.concat(F.lit("t"), "id")})
    sinks.write_bucketed(target, path, buckets=32)
    folder = Path(urlparse(path).path)
    files = lambda: {f: (f.stat().st_mtime_ns, f.read_bytes()) for f in folder.glob("bucket=*/*.parquet")}
    before = files()
    assert len({f.parent for f in before}) == 32
    updates = spark.createDataFrame([(7, 9, "v2", 0.5), (11, 8, "v2", 0.25), (999_999, 1, "v2", 0.1)], "id long, segment_id int, segment_version string, segment_confidence double")
    at = F.lit("2026-01-02 03:04:05")
    touched = sinks.merge_into(spark, path, updates, at=at, buckets=32)
    after = files()
    changed = {f.parent.name for f in set(before) ^ set(after)}
    assert 2 <= len(touched) <= 3 and changed <= {f"bucket={b}" for b in touched}
    assert all(before[f] == after[f] for f in set(before) & set(after))
    want = sorted(map(tuple, sinks.merge_assignments(target, updates, at=at).select("id", "segment_id", "segment_version", "title").collect()))
    got = lambda: sorted(map(tuple, sinks.read_bucketed(spark, path).select("id", "segment_id", "segment_version", "title").collect()))
    assert got() == want
    sinks.merge_into(spark, path, updates, at=at, buckets=32)  # a replay
    assert got() == want
    assert sinks.merge_into(spark, path, updates.limit(0), at=at, buckets=32) == []


def test_category_order_and_multiplicity(spark):
    posts = spark.createDataFrame([(1,), (2,)], "id long")
    bridge = spark.createDataFrame([(1, 9), (1, 2), (1, 9)], "job_posting_id long, category_id int")
    dim = spark.createDataFrame([(2, "z"), (9, "a"), (3, "q")], "category_id int, name string")
    out = {r["id"]: r["categories"] for r in attach_categories(posts, bridge, dim).collect()}
    assert out == {1: ["z", "a", "a"], 2: []}


def test_distinct_pairs_are_not_counted_again(spark):
    """Every count of the pairs holds them all in its task; a bridge without repeats needs none."""
    posts = spark.createDataFrame([(1,), (2,)], "id long")
    bridge = spark.createDataFrame([(1, 9), (1, 2), (3, 9)], "job_posting_id long, category_id int")
    dim = spark.createDataFrame([(2, "z"), (9, "a")], "category_id int, name string")
    rows = attach_categories(posts, bridge, dim, distinct_pairs=True)
    assert {r["id"]: r["categories"] for r in rows.collect()} == {1: ["z", "a"], 2: []}
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1
    counted = attach_categories(posts, bridge, dim)._jdf.queryExecution().optimizedPlan().toString()
    assert counted.count("Aggregate") == 2


def test_lines_are_joined_once_for_training_and_assigning(spark, sf, monkeypatch):
    from segloom.plans import models_queries as MQ

    calls = []
    made = V.lines
    monkeypatch.setattr(V, "lines", lambda *args: calls.append(args) or made(*args))
    monkeypatch.setattr(MQ, "_LINES", {}, raising=False)
    for rows in (MQ.queued_lines(spark, sf), MQ.trained_lines(spark, sf), MQ.posting_attributes(spark, sf)):
        assert "Join" not in rows._jdf.queryExecution().optimizedPlan().toString()
    assert len(calls) == 1
    line = {r["posting_id"]: r for r in made(spark, sf).collect()}
    assert {r["posting_id"] for r in MQ.trained_lines(spark, sf).collect()} == {
        i for i, r in line.items() if r["job_type"] and (r["job_type"], r["payment_group"]) != ("photo", "n3")
    }
    assert MQ.queued_lines(spark, sf).count() == len(line)


def test_category_queries_hold_pairs_once(spark, sf):
    """The distinct pairs and the lists: no count of the pairs between them."""
    from segloom.plans import joins_queries as JQ

    plan = JQ.category_conflicts(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [job_posting_id") == 2


def test_samples_do_not_depend_on_partitions(spark):
    df = spark.range(5000).withColumn("g", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 7)))
    ids = lambda x: sorted(r["id"] for r in x.collect())
    one = R.sample_n(df, 123)
    assert one.count() == 123
    assert ids(one) == ids(R.sample_n(df.repartition(11), 123))
    quotas = spark.createDataFrame([("hot", 50), ("g1", 10_000), ("g2", 1)], "g string, quota long")
    taken = {r["g"]: r["count"] for r in R.take_quota(df, quotas, ["g"]).groupBy("g").count().collect()}
    assert taken == {"hot": 50, "g1": df.filter("g = 'g1'").count(), "g2": 1}
    # a quota takes the smallest hashes
    hashed = df.filter("g = 'hot'").withColumn("h", R.hash_order("id", 42))
    first = {r["id"] for r in hashed.orderBy("h", "id").limit(50).collect()}
    assert first == {r["id"] for r in R.take_quota(df, quotas, ["g"]).filter("g = 'hot'").collect()}


def test_stratified_sample_fills_the_deficit(spark):
    df = spark.range(1000).withColumn("s", F.when(F.col("id") < 3, "a").when(F.col("id") < 500, "b").otherwise("c"))
    strata = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2)], "s string, ord int")
    out = R.stratified_sample(df, strata, ["s"], 100)
    sizes = {r["s"]: r["count"] for r in out.groupBy("s").count().collect()}
    assert sum(sizes.values()) == 100 and sizes["a"] == 3 and min(sizes["b"], sizes["c"]) >= 33
    assert out.select("id").distinct().count() == 100


def test_split(spark):
    df = spark.range(103).withColumn("y", F.when(F.col("id") < 60, 0).when(F.col("id") < 95, 1).otherwise(2))
    sizes = {r["y"]: r["t"] for r in R.split_train_test(df, "y").groupBy("y").agg(F.count_if("is_test").alias("t")).collect()}
    assert sum(sizes.values()) == 21 and sizes == {0: 12, 1: 7, 2: 2}
    lonely = spark.range(20).withColumn("y", F.when(F.col("id") == 0, 0).otherwise(1))
    assert R.split_train_test(lonely, "y").filter("is_test").count() == 4


def test_terciles(spark):
    df = spark.createDataFrame([("a", x) for x in [1, 2, 3, 10, 20]] + [("b", 5), ("b", 9)], "g string, len int")
    limits = {r["g"]: (r["p33"], r["p66"]) for r in R.tercile_limits(df, ["g"], "len").collect()}
    assert limits["a"] == pytest.approx((7 / 3, 23 / 3)) and limits["b"] == (9.0, 9.0)


def test_dedup_hot_key(spark):
    df = spark.range(3000).select((F.col("id") % 3 == 0).cast("int").alias("k"), F.col("id").alias("v"))
    assert {(r["k"], r["v"]) for r in dedup_by_id(df, "k", [F.desc("v")]).collect()} == {(0, 2999), (1, 2997)}


def test_positions(spark):
    sparse = spark.range(0, 3000, 7).select((F.col("id") * F.col("id") * 1_000_003 - 5_000_000_000).alias("id"))
    for df in (spark.range(0, 3000, 7), sparse, spark.range(0)):
        got = [r["position"] for r in R.global_position(df, "id").orderBy("id").collect()]
        assert got == list(range(1, len(got) + 1))


def test_schema_documents(spark):
    schema = {"common_attributes": [{"name": "c", "values": ["1", "2"]}], "type_specific": {"model": [{"name": "m", "values": ["x"]}], "beauty": []}}
    assert attribute_types(schema) == {"c": ["model", "beauty"], "m": ["model"]}
    assert attribute_values(spark, schema).count() == 5
    with pytest.raises(ValueError):
        attribute_types({"common_attributes": None})


def test_encoders(spark):
    from pyspark.ml.functions import vector_to_array

    df = spark.createDataFrame([("b", MISSING), ("a", MISSING), (MISSING, MISSING)], "p string, q string")
    model = E.fit_onehot(df, ["p", "q"], drop_missing=True)
    assert E.slot_values(model) == [["a", "b"]]  # q has no explicit value
    new = spark.createDataFrame([("a", "x"), ("zz", "x"), (MISSING, "x")], "p string, q string")
    got = [r[0] for r in E.encode(new, model, ["p", "q"], True).select(vector_to_array("features")).collect()]
    assert got == [[1.0, 0.0], [0.0, 0.0], [0.0, 0.0]]
    assert E.fit_onehot(df, ["q"], drop_missing=True) is None
    fixed = E.onehot_fixed(df.withColumn("q", F.lit(" k ")), {"p": ["a", MISSING], "q": ["k", "last"]})
    assert [r[0] for r in fixed.select(vector_to_array("features")).collect()] == [[0, 1, 1, 0], [1, 0, 1, 0], [0, 1, 1, 0]]


def test_report_scores(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (0, 1), (1, 1), (2, 1)], "y int, p int")
    report = MD.class_report(MD.confusion(df, (), "y", "p"))
    got = {r["label"]: (r["precision"], r["recall"], r["f1"]) for r in report.collect()}
    assert got[0] == pytest.approx((1.0, 2 / 3, 0.8)) and got[1] == pytest.approx((1 / 3, 1.0, 0.5)) and got[2] == (0.0, 0.0, 0.0)
    summary = MD.score_summary(report).first()
    assert (summary["accuracy"], summary["macro_f1"]) == pytest.approx((0.6, 1.3 / 3))


def test_grades(spark):
    rows = [("model", "n2", -1, "정보 부족형", 9, 1.0, 1.0, 1.0), ("photo", "n3", 0, "x", 900, 90.0, 1.0, 1.0), ("model", "n2", 1, "x", 29, 1.0, 1.0, 1.0),
            ("model", "n2", 2, "x", 500, 40.1, 1.0, 1.0), ("model", "n2", 3, "x", 50, 25.0, 0.7, 0.1), ("model", "n2", 4, "x", 49, 10.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "job_type string, payment_group string, segment_id int, segment_key string, n long, pct_cell double, purpose_top double, topic_top double")
    got = [(r["grade"], r["flags"]) for r in Q.grade(df).orderBy("segment_id", "job_type").collect()]
    assert got == [("D", ["info_poor"]), ("D", ["small_cell"]), ("C", ["micro"]), ("C", ["catch_all"]), ("A", []), ("B", [])]


def test_moves(spark):
    a = spark.createDataFrame([(1, 0, "x"), (2, 0, "x"), (3, -1, "poor"), (4, 1, "y"), (5, 1, "y")], "id long, segment_id int, segment_key string")
    b = spark.createDataFrame([(1, 0, "other"), (2, -1, "poor"), (3, -1, "poor"), (4, 2, "y")], "id long, segment_id int, segment_key string")
    got = Q.move_summary(Q.assignment_moves(a, b)).first()
    assert (got["n_same"], got["n_moved"], got["n_info_poor"]) == (2, 2, 2)


def cell_rows(spark, n=40):
    """Two classes per cell that follow the purpose."""
    rows = []
    for job, group in (("model", "n2"), ("beauty", "n3")):
        for i in range(n):
            purpose = "P" if i % 2 else "R"
            rows.append((len(rows), job, group, i % 2, f"k{i % 2}", "S", purpose, "N", MISSING, "any", "x" if i % 3 else MISSING))
    return spark.createDataFrame(rows, "id long, job_type string, payment_group string, segment_id int, segment_key string, " + ", ".join(f"{a} string" for a in AXES))


@pytest.fixture(scope="module")
def fitted(spark):
    rows = cell_rows(spark)
    models, gate, held_out = MD.train_cells(rows, trees=5, depth=5)
    return models, gate, cut(held_out), cut(RP.segment_catalog(rows))


def test_training(spark, fitted):
    models, gate, held_out, _ = fitted
    assert sorted(models.forests) == ["beauty_n3", "model_n2"]
    assert {r["decision"] for r in gate.collect()} == {"train"}
    assert MD.score_summary(MD.class_report(MD.confusion(held_out, weight="n"))).first()["accuracy"] == 1.0


def test_trees_vote_like_the_library(spark):
    """Predictions from the table of trees against the models' own, and a plan that does not grow with the cells."""
    from pyspark.ml.functions import vector_to_array

    rows = V.cells(spark, "/root/testdata/sf0.001").select(F.col("posting_id").alias("id"), *CELL, *AXES)
    rows = rows.withColumn("segment_id", (F.crc32(F.concat_ws("|", "purpose", "place", F.col("id") % 3).cast("binary")) % 5).cast("int"))
    models, _, held_out = MD.train_cells(rows, trees=9, depth=6)
    assert len(models.forests) >= 5
    tuples = cut(rows.select(*CELL, *AXES).distinct().unionByName(rows.select(*CELL, *[F.lit("never seen").alias(a) for a in AXES]).distinct()))
    got = {tuple(r[:8]): (r.predicted_id, r.confidence) for r in models.predict(tuples).select(*CELL, *AXES, "predicted_id", "confidence").collect()}
    assert len(got) == tuples.count()
    for cell, forest in models.forests.items():
        here = tuples.filter(F.concat_ws("_", *CELL) == cell)
        scored = forest.transform(E.encode(here, models.encoders[cell], AXES)).withColumn("p", vector_to_array("probability"))
        for r in scored.select(*CELL, *AXES, "p").collect():
            predicted, confidence = got[tuple(r[:8])]
            assert confidence == pytest.approx(max(r.p), abs=1e-8)
            assert r.p[models.classes[cell].index(predicted)] == pytest.approx(max(r.p), abs=1e-8)
    few = MD.CellModels(models.features, *[dict(list(d.items())[:2]) for d in (models.encoders, models.forests, models.classes)], models.trees)
    size = lambda m: len(m.predict(tuples)._jdf.queryExecution().optimizedPlan().toString().splitlines())
    assert size(few) == size(models)


def test_models_survive_saving(spark, fitted):
    models, _, held_out, _ = fitted
    path = scratch_path(spark, "models")
    models.save(spark, path)
    again = MD.CellModels.load(spark, path)
    tuples = held_out.drop("predicted_id", "confidence")
    assert again.predict(tuples).exceptAll(models.predict(tuples)).count() == 0
    assert again.classes == models.classes and again.features == models.features


def assign_cases(spark):
    rows = [
        (1, "invalid", "n2", "S", "P", "N", MISSING, "any", MISSING, True),
        (2, "model", "n2", "S", "P", "N", MISSING, "any", MISSING, False),
        (3, "model", "n2", MISSING, MISSING, None, MISSING, "any", "x", True),
        (4, "photo", "n3", "S", "P", "N", MISSING, "any", MISSING, True),
        (5, "model", "n2", "S", "P", "N", MISSING, "any", MISSING, True),
        (6, "model", "n2", "S", "unseen", "N", MISSING, "any", MISSING, True),
    ]
    return spark.createDataFrame(rows, "id long, job_type string, payment_group string, " + ", ".join(f"{a} string" for a in AXES) + ", ok boolean")


def test_assignment_precedence(spark, fitted):
    models, _, _, catalog = fitted
    out = {r["id"]: r for r in MD.assign(assign_cases(spark), models, catalog, ok="ok").collect()}
    got = {i: (r["status"], r["segment_id"], r["confidence"], r["segment_key"]) for i, r in out.items()}
    assert got[1] == ("invalid_recruit_type", None, 0.0, None)
    assert got[2] == ("phase3_fail", None, 0.0, None)
    assert got[3] == ("info_poor", -1, 1.0, "정보부족")
    assert got[4] == ("no_rf_model", -1, 0.0, "정보부족")
    assert (*got[5][:2], got[5][3]) == ("ok", 1, "k1") and 0.5 < got[5][2] <= 1.0
    assert got[6][0] == "ok" and got[6][1] in (0, 1)


def test_missing_profile_is_an_error(spark, fitted):
    models, _, held_out, _ = fitted
    profiles = spark.createDataFrame([("model", "n2", 0, 10, {"a": "b"})], "job_type string, payment_group string, cluster int, size long, dominant_values map<string,string>")
    with pytest.raises(Exception, match="no profile for cluster"):
        MD.cluster_predict(held_out, profiles).collect()


def postings(spark):
    rows = [(i, f"title {i}", "메이크업" if i % 5 == 0 else "text", [-2, -3, None][i % 3], ["Model ", "beauty", "x"][i % 4 % 3], 0, int(i % 11 == 0)) for i in range(60)]
    return spark.createDataFrame(rows, "id long, title string, content string, payment int, job_type string, is_deleted int, is_expired int")


def attributes(spark):
    rows = [(i, "S", "P" if i % 2 else MISSING, "N" if i % 7 else MISSING, MISSING, "any", MISSING, i % 9 != 0) for i in range(55)]
    return spark.createDataFrame(rows, "id long, " + ", ".join(f"{a} string" for a in AXES) + ", ok boolean")


def test_stream_equals_batch(spark, fitted):
    models, _, _, catalog = fitted
    table = sinks.ensure_columns(postings(spark))
    lists = postings(spark).select("id", F.array(F.lit("일상")).alias("categories"))
    batch = A.batch_assign(table, lists, attributes(spark), models, catalog, limit=None)
    summary = batch.summary().first()
    assert summary["n_success"] + summary["n_fail"] == table.filter("is_expired = 0").count()
    assert batch.snapshot.count() == 60
    assert batch.snapshot.filter("segment_id IS NULL AND is_expired = 0").count() == summary["n_fail"]

    source, sink = scratch_path(spark, "in"), scratch_path(spark, "out")
    columns = ["id", "title", "content", "payment", "job_type"]
    live = postings(spark).filter("is_expired = 0").select(columns)

    def run():
        stream = ST.read_posting_stream(spark, source, ST_SCHEMA, max_files=1)
        job = ST.assign_stream(stream, lists, attributes(spark), models, catalog, sink, f"{sink}/checkpoint")
        job.awaitTermination()
        return ST.read_sink(spark, f"{sink}/assigned", "id long, segment_id int, segment_version string, segment_confidence float, batch_id int")

    live.filter("id < 30").repartition(2).write.parquet(source)
    run()
    # more files after a restart, with ids that were already assigned
    live.filter("id >= 20").repartition(2).write.mode("append").parquet(source)
    streamed = run().select("id", "segment_id", F.round("segment_confidence", 5).alias("c"))
    wanted = batch.updates.select("id", "segment_id", F.round("segment_confidence", 5).alias("c"))
    assert streamed.count() == wanted.count() == streamed.select("id").distinct().count()
    assert streamed.exceptAll(wanted).count() == 0
    # every batch has removed its intermediate tables
    assert not list(Path(urlparse(shared_dir(spark)).path).glob("scope-*"))


def test_stream_remembers_ids_for_a_while(spark):
    """Ten batches a day apart with ids that come twice: each is written once, and the state holds some days only."""
    source, out = scratch_path(spark, "days"), scratch_path(spark, "seen")
    for day in range(10):
        ids = spark.range(day * 100, day * 100 + 130)  # 30 of them come again the next day
        ids.withColumn("day", F.timestamp_seconds(F.lit(1_700_000_000 + day * 86_400))).coalesce(1).write.mode("append").parquet(source)
    plans = []

    def run():
        days = ST.read_posting_stream(spark, source, "id long, day timestamp", max_files=1)
        fresh = ST.first_seen(days, expiry="2 days", arrived=F.col("day"))

        def write(batch, batch_id):
            plans.append(batch._jdf.queryExecution().toString())
            ST.append_once(batch, out, batch_id)

        job = fresh.writeStream.foreachBatch(write).option("checkpointLocation", f"{out}-state").trigger(availableNow=True).start()
        job.awaitTermination()
        return [p.stateOperators[0].numRowsTotal for p in job.recentProgress if p.stateOperators]

    held = run()
    ids = [r.id for r in spark.read.parquet(out).select("id").collect()]
    assert sorted(ids) == list(range(1030))
    assert len(held) >= 10 and max(held) <= 650, held  # an id goes when the expiry has passed twice
    assert not any(out in p for p in plans)  # the sink is not read
    assert run() == [] or spark.read.parquet(out).count() == 1030  # a restart adds nothing


def test_scratch_is_removed(spark):
    with scratch(spark) as path:
        assert cut(spark.range(5)).count() == 5 and list(Path(urlparse(path).path).iterdir())
    assert not Path(urlparse(path).path).exists()


ST_SCHEMA = "id long, title string, content string, payment int, job_type string"


def test_char_grams(spark):
    df = spark.createDataFrame([("Ab  c",), (None,)], "t string")
    got = [r[0] for r in df.select(T.char_ngrams("t")).collect()]
    assert got == [[" ", "a", "b", " ", " a", "ab", "b ", " ", "c", " ", " c", "c "], []]


def test_text_models(spark):
    rows = [(i, "가나 다라 red apple" if i % 2 else "마바 사아 blue sky", i % 2 * 3) for i in range(30)]
    df = spark.createDataFrame(rows, "id long, text string, y int")
    for kind in ("char", "word"):
        model = T.train_text_model(df, kind=kind, max_iter=20, vocabulary=T.VOCABULARY)
        scored = model.score(df)
        assert scored.filter("predicted_id <> y").count() == 0
        names = spark.createDataFrame([(3, "three")], "segment_id int, name string")
        assert {(r["y"], r["name"]) for r in T.score_text(df, model, names).collect()} == {(3, "three"), (0, "미분류")}


def test_variants_report_all_configs(spark, sf):
    from segloom.plans.segment import best_variant, variant_grid

    rows = V.cells(spark, sf).filter("payment_group = 'n2'")
    grid = cut(variant_grid(rows, {"a": SegmentConfig(), "b": SegmentConfig(raw_k_scale=2.0)}))
    assert {r["variant"] for r in grid.collect()} == {"a", "b"}
    best = best_variant(grid).first()
    assert best["purity"] == max(r["purity"] for r in grid.collect())


def test_view_counts(spark, sf):
    rows = RP.segment_view(V.assigned(spark, sf), cap=2, key="posting_id")
    assert rows.filter("posts_shown > 2 OR size(posts) <> posts_shown").count() == 0
    assert rows.count() == V.assigned(spark, sf).select(*CELL, "segment_id").distinct().count()


def test_worker_functions_travel_with_the_job():
    from pyspark import cloudpickle

    assert "segloom" in cloudpickle.list_registry_pickle_by_value()


def test_training_frame_has_every_labelled_row(spark, sf):
    """No order is left out; an id without attributes has no row, an attribute that is null is the sentinel."""
    from segloom.plans.models_queries import frame

    labelled = V.assigned(spark, sf).filter("segment_id <> -1").select("posting_id")
    assert {r.id for r in frame(spark, sf).select("id").collect()} == {r.posting_id for r in labelled.collect()}
    rows = spark.createDataFrame([(1, "a", "n2", 0, "s"), (2, "a", "n2", 0, "s"), (3, "a", "n2", -1, "s")], "id int, job_type string, payment_group string, segment_id int, segment_key string")
    attributes = spark.createDataFrame([(1, "x", None), (3, "x", "y"), (4, "x", "y")], "id int, place string, topic string")
    assert [(r.id, r.place, r.topic) for r in MD.training_frame(rows, attributes, ["place", "topic"]).collect()] == [(1, "x", MISSING)]
