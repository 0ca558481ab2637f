"""Classifiers and assignment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segloom.config import AXES, CELL, MISSING
from segloom.operators import assigning as A
from segloom.operators import models as MD
from segloom.operators import ranking as R
from segloom.operators import report as RP
from segloom.operators import stats as S
from segloom.operators import textmodels as T
from segloom.operators.joins import attach_categories
from segloom.plans import views as V
from segloom.plans.registry import query
from segloom.plans.scalars_queries import DENSITY_SQL
from segloom.plans.stats_queries import rounded
from segloom.runtime import beside, cut, scratch_path
from segloom.sources.sinks import ensure_columns
from segloom.streaming import assign_stream as ST

CELLS = "job_type, payment_group"
ASSIGNED = ("v_assigned",)
LABELED = ("v_labeled",)
_CLEAN: dict[tuple[str, str], tuple] = {}
_LINES: dict[tuple[str, str], DataFrame] = {}


def assigned(spark, sf):
    return V.assigned(spark, sf).withColumnRenamed("posting_id", "id")


def frame(spark, sf):
    rows = assigned(spark, sf)
    attributes = V.lines(spark, sf).withColumnRenamed("posting_id", "id")
    return MD.training_frame(rows, attributes)


@query(
    "training_frame",
    "SELECT posting_id AS id, job_type, payment_group, segment_id, segment_key, place, purpose, topic, treatment, career, continuity FROM v_assigned WHERE segment_id <> -1",
    ASSIGNED,
)
def training_frame(spark, sf):
    return frame(spark, sf)


@query(
    "cell_gates",
    f"""SELECT {CELLS}, count(*) AS n_train, count(DISTINCT segment_id) AS n_classes, CASE WHEN count(*) < 500 THEN 'too_few_samples' WHEN count(DISTINCT segment_id) < 2 THEN 'single_segment' ELSE 'train' END AS decision
        FROM (SELECT {CELLS}, CASE WHEN job_type = 'photo' THEN 0 ELSE segment_id END AS segment_id FROM v_assigned WHERE segment_id <> -1) GROUP BY ALL""",
    ASSIGNED,
)
def cell_gates(spark, sf):
    rows = assigned(spark, sf).filter("segment_id <> -1")
    one = F.when(F.col("job_type") == "photo", 0).otherwise(F.col("segment_id"))
    return MD.cell_gate(rows.withColumn("segment_id", one), min_rows=500)


@query("forest_scores")
def forest_scores(spark, sf):
    """Held-out scores of one forest per cell on the noisy labels."""
    _, _, held_out = MD.train_cells(frame(spark, sf))
    held_out = cut(held_out)
    scores = MD.score_summary(MD.class_report(MD.confusion(held_out, CELL, weight="n"), CELL), CELL)
    shares = MD.confidence_buckets(held_out, CELL, weight="n").drop("n")
    return rounded(scores.join(shares, [*CELL]), "accuracy", "macro_f1", "weighted_f1", "ge_09", "ge_07", "lt_05")


@query(
    "class_report",
    f"""WITH c AS (SELECT {CELLS}, raw_cluster_id AS y, type_code AS p, count(*) AS n FROM v_labeled WHERE raw_cluster_id <> -1 GROUP BY ALL),
        r AS (SELECT {CELLS}, label, sum(t) AS support, sum(q) AS predicted, sum(h) AS hits FROM (SELECT {CELLS}, y AS label, n AS t, 0 AS q, CASE WHEN y = p THEN n ELSE 0 END AS h FROM c
          UNION ALL SELECT {CELLS}, p, 0, n, 0 FROM c) GROUP BY ALL)
        SELECT {CELLS}, label, CAST(support AS BIGINT) AS support, CAST(predicted AS BIGINT) AS predicted, CAST(hits AS BIGINT) AS hits, round(coalesce(hits / nullif(predicted, 0), 0), 6) AS "precision",
        round(coalesce(hits / nullif(support, 0), 0), 6) AS recall, round(coalesce(2.0::DOUBLE * hits / nullif(support + predicted, 0), 0), 6) AS f1 FROM r""",
    LABELED,
)
def class_report(spark, sf):
    rows = V.labeled(spark, sf).filter("raw_cluster_id <> -1")
    return rounded(MD.class_report(MD.confusion(rows, CELL, "raw_cluster_id", "type_code"), CELL), "precision", "recall", "f1")


@query(
    "score_summary",
    f"""WITH c AS (SELECT raw_cluster_id AS y, type_code AS p FROM v_labeled WHERE raw_cluster_id <> -1),
        f AS (SELECT k, 2.0::DOUBLE * count(*) FILTER (y = k AND p = k) / (count(*) FILTER (y = k) + count(*) FILTER (p = k)) AS f1, count(*) FILTER (y = k) AS s FROM c, (SELECT DISTINCT y AS k FROM c) GROUP BY k)
        SELECT (SELECT count(*) FROM c) AS n, round((SELECT avg(CAST(y = p AS INT)) FROM c), 6) AS accuracy, round(avg(f1), 6) AS macro_f1, round(sum(f1 * s) / sum(s), 6) AS weighted_f1 FROM f""",
    LABELED,
)
def score_summary(spark, sf):
    rows = V.labeled(spark, sf).filter("raw_cluster_id <> -1")
    report = MD.class_report(MD.confusion(rows, (), "raw_cluster_id", "type_code"))
    return rounded(MD.score_summary(report), "accuracy", "macro_f1", "weighted_f1")


@query(
    "confidence_buckets",
    f"""SELECT {CELLS}, count(*) AS n, round(avg(CAST(c >= 0.9 AS INT)), 6) AS ge_09, round(avg(CAST(c >= 0.7 AS INT)), 6) AS ge_07, round(avg(CAST(c < 0.5 AS INT)), 6) AS lt_05
        FROM (SELECT {CELLS}, (posting_id % 100) / 100 AS c FROM v_cells) GROUP BY ALL""",
    ("v_cells",),
)
def confidence_buckets(spark, sf):
    rows = V.cells(spark, sf).withColumn("confidence", (F.col("posting_id") % 100) / 100)
    return rounded(MD.confidence_buckets(rows, CELL), "ge_09", "ge_07", "lt_05")


@query(
    "segment_catalog",
    f"""SELECT *, CAST(sum(n) OVER c AS BIGINT) AS n_train, count(*) OVER c AS n_segments, 'v2.1-tune' AS version
        FROM (SELECT {CELLS}, segment_id, min(segment_key) AS segment_key, count(*) AS n FROM v_assigned WHERE segment_id <> -1 GROUP BY ALL) WINDOW c AS (PARTITION BY {CELLS})""",
    ASSIGNED,
)
def segment_catalog(spark, sf):
    return RP.segment_catalog(V.assigned(spark, sf))


def written_lines(spark, sf):
    """The line view as a written table, its joins made once in a session for each table: training and assigning read it."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _LINES:
        _LINES[key] = cut(V.lines(spark, sf).select("posting_id", "l_orderkey", *CELL, "type_code", *AXES))
    return _LINES[key]


def trained_lines(spark, sf):
    """Line rows of the cells that have a model; photo cells of one group are left out."""
    return written_lines(spark, sf).filter("job_type <> '' AND NOT (job_type = 'photo' AND payment_group = 'n3')")


def clean_models(spark, sf):
    """Forests that reproduce the purpose classes, and their catalogue; photo cells of one group are left out.

    Trained once in a session for each table; the queries that assign load the saved models.
    """
    key = (spark.sparkContext.applicationId, sf)
    if key not in _CLEAN:
        rows = trained_lines(spark, sf).withColumnRenamed("posting_id", "id")
        rows = rows.withColumns({"segment_id": F.col("type_code"), "segment_key": F.concat(F.lit("class"), F.col("type_code"))})
        rows = rows.select("id", *CELL, "segment_id", "segment_key", *AXES)
        models, _, _ = MD.train_cells(rows, written=True)
        path = scratch_path(spark, "models")
        models.save(spark, path)
        _CLEAN[key] = (MD.CellModels.load(spark, path), cut(RP.segment_catalog(rows)))
    return _CLEAN[key]


TRAINED = f"""SELECT {CELLS}, job_type || '_' || payment_group AS cell, count(DISTINCT type_code) AS n_classes FROM v_lines
  WHERE job_type <> '' AND NOT (job_type = 'photo' AND payment_group = 'n3') GROUP BY {CELLS} HAVING count(*) >= 5 AND count(DISTINCT type_code) >= 2"""


@query("trained_cells", f"SELECT cell, n_classes, 200::BIGINT AS n_trees FROM ({TRAINED})", ("v_lines",))
def trained_cells(spark, sf):
    """Training of the forests that the assigning queries use: trees and classes per cell."""
    models, _ = clean_models(spark, sf)
    trees = models.all_trees(spark).groupBy(F.col("_cell").alias("cell")).agg(F.count("*").alias("n_trees"))
    classes = spark.createDataFrame([(c, len(ids)) for c, ids in models.classes.items()], "cell string, n_classes long")  # a row per cell
    return trees.join(classes, "cell")


def queued_lines(spark, sf):
    """All line rows with the outcome of their extraction, from the written table: the assignment reads them for the tuples and for the join."""
    return written_lines(spark, sf).select(*CELL, *AXES, (F.col("l_orderkey") % 50 != 0).alias("ok"))


@query(
    "assigned_statuses",
    f"""WITH t AS ({TRAINED}), s AS (SELECT v.job_type, v.payment_group, CASE WHEN v.job_type = '' THEN 'invalid_recruit_type' WHEN l_orderkey % 50 = 0 THEN 'phase3_fail'
          WHEN {DENSITY_SQL} < 1 THEN 'info_poor' WHEN t.cell IS NULL THEN 'no_rf_model' ELSE 'ok' END AS status
          FROM v_lines v LEFT JOIN t ON t.job_type = v.job_type AND t.payment_group = v.payment_group)
        SELECT {CELLS}, status, count(*) AS n, count(*) FILTER (status IN ('info_poor', 'no_rf_model')) AS n_poor_id, count(*) FILTER (status = 'ok') AS n_segment FROM s GROUP BY ALL""",
    ("v_lines",),
)
def assigned_statuses(spark, sf):
    """Outcomes of the same assignment: rows per status, and how many have a segment or the info-poor id."""
    models, catalog = clean_models(spark, sf)
    out = MD.assign(queued_lines(spark, sf), models, catalog, ok="ok")
    segment = F.col("segment_id") >= 0
    return out.groupBy(*CELL, "status").agg(
        F.count("*").alias("n"), F.count_if(F.col("segment_id") == -1).alias("n_poor_id"), F.count_if(segment & F.col("segment_key").isNotNull()).alias("n_segment")
    )


@query("assigned_rows")
def assigned_rows(spark, sf):
    """Outcome of the assignment of all line rows, also those of unsupported types."""
    models, catalog = clean_models(spark, sf)
    out = MD.assign(queued_lines(spark, sf), models, catalog, ok="ok")
    return rounded(
        out.groupBy(*CELL, "status", "segment_id", "segment_key").agg(F.count("*").alias("n"), F.avg("confidence").alias("confidence")), "confidence", digits=4
    )


@query("cluster_predictions")
def cluster_predictions(spark, sf):
    """Predicted clusters with the size and dominant career of their profile."""
    models, _ = clean_models(spark, sf)
    rows = trained_lines(spark, sf).select(*CELL, "type_code", *AXES)  # read by the profiles and by the tuples
    profiles = S.cluster_profiles(rows, "type_code", {"career": ["any", "senior", MISSING]}, CELL)
    docs = S.profile_documents(profiles, [*CELL, "type_code"]).withColumnRenamed("type_code", "cluster")
    tuples = S.compress(rows, CELL, AXES)
    out = MD.cluster_predict(models.predict(tuples), docs)
    return out.groupBy(*CELL, "predicted_id", "cluster_size", F.col("dominant_values")["career"].alias("career")).agg(F.sum("n").alias("n"))


@query(
    "rf_agreement",
    f"""WITH a AS (SELECT job_type || '_' || payment_group AS cell, segment_id, CASE WHEN posting_id % 20 = 0 THEN 'info_poor' ELSE 'ok' END AS status, type_code AS p FROM v_assigned)
        SELECT cell, count(*) FILTER (j) AS n_judged, count(*) FILTER (j AND segment_id = p) AS n_match, count(*) FILTER (status = 'info_poor') AS n_poor,
        count(*) FILTER (status = 'info_poor' AND segment_id = -1) AS n_poor_match, round(count(*) FILTER (j AND segment_id = p) * 100.0::DOUBLE / greatest(count(*) FILTER (j), 1), 6) AS match_pct,
        round(count(*) FILTER (status = 'info_poor' AND segment_id = -1) * 100.0::DOUBLE / greatest(count(*) FILTER (status = 'info_poor'), 1), 6) AS poor_match_pct
        FROM (SELECT *, status = 'ok' AND segment_id <> -1 AS j FROM a) GROUP BY GROUPING SETS ((cell), ())""",
    ASSIGNED,
)
def rf_agreement(spark, sf):
    from segloom.operators.quality import agreement

    rows = assigned(spark, sf)
    status = F.when(F.col("id") % 20 == 0, "info_poor").otherwise("ok")
    predicted = rows.select("id", status.alias("status"), F.col("type_code").alias("predicted_id"))
    return rounded(agreement(rows.select("id", *CELL, "segment_id"), predicted), "match_pct", "poor_match_pct")


def text_split(spark, sf):
    return cut(R.split_train_test(V.texts(spark, sf), "y"))


@query("text_baseline_char")
def text_baseline_char(spark, sf):
    """Held-out scores of the character n-gram classifier on whole texts."""
    rows = text_split(spark, sf)
    model = T.train_text_model(rows.filter("NOT is_test"), kind="char", balanced=True, vocabulary=T.VOCABULARY)
    report = MD.class_report(MD.confusion(model.score(rows.filter("is_test")), (), "y"))
    return rounded(MD.score_summary(report), "accuracy", "macro_f1", "weighted_f1")


@query("text_baseline_word")
def text_baseline_word(spark, sf):
    """Held-out scores of the word n-gram classifier on whole texts."""
    rows = text_split(spark, sf)
    model = T.train_text_model(rows.filter("NOT is_test"), kind="word", balanced=False, vocabulary=T.VOCABULARY)
    report = MD.class_report(MD.confusion(model.score(rows.filter("is_test")), (), "y"))
    return rounded(MD.score_summary(report), "accuracy", "macro_f1", "weighted_f1")


@query("scored_texts")
def scored_texts(spark, sf):
    """Classes of all documents by a model of the labelled ones, with class names."""
    rows = V.texts(spark, sf)
    model = T.train_text_model(rows, kind="word", balanced=False, vocabulary=T.VOCABULARY)
    names = rows.select(F.col("y").alias("segment_id")).distinct().withColumn("name", F.concat(F.lit("class "), F.col("segment_id")))
    scored = T.score_text(V.table(spark, sf, "documents").select("doc_id", "text"), model, names)
    return scored.select("doc_id", "predicted_id", "name", "confidence")



@query(
    "chosen_models",
    """WITH b AS (SELECT lang AS job_type, round(avg(CAST(y = 2 AS INT)), 6) AS f FROM v_texts WHERE lang <> 'de' GROUP BY 1), c AS (SELECT lang AS job_type, round(avg(CAST(y >= 2 AS INT)), 6) AS f FROM v_texts GROUP BY 1)
       SELECT job_type, c.f AS challenger_f1, b.f AS baseline_f1, CASE WHEN b.f IS NULL OR c.f >= b.f + 0.05::DOUBLE THEN 'challenger' ELSE 'baseline' END AS adopted, round(c.f - b.f, 6) AS macro_f1_gain
       FROM c LEFT JOIN b USING (job_type)""",
    ("v_texts",),
)
def chosen_models(spark, sf):
    """Choice between two score tables per language, taken from the labels."""
    rows = V.texts(spark, sf).withColumnRenamed("lang", "job_type")

    def table(hit):
        return rows.groupBy("job_type").agg(F.round(F.avg(hit.cast("int")), 6).alias("macro_f1"))

    baseline = table(F.col("y") == 2).filter("job_type <> 'de'")
    return MD.choose_model(baseline, table(F.col("y") >= 2))


def posting_attributes(spark, sf):
    """Attributes of a posting: the profile of the first line of the order with its id."""
    from segloom.operators.joins import dedup_by_id

    first = dedup_by_id(written_lines(spark, sf).select(F.col("l_orderkey").alias("id"), "posting_id", *AXES), "id", ["posting_id"])
    return first.drop("posting_id").withColumn("ok", F.col("id") % 19 != 0)


def posting_lists(spark, sf):
    posts = V.postings(spark, sf).select("id")
    return attach_categories(posts, V.posting_categories(spark, sf), V.categories(spark, sf), distinct_pairs=True).select("id", "categories")


@query("batch_assignment")
def batch_assignment(spark, sf):
    """Assignment of the whole queue: outcomes of the batch."""
    models, catalog = clean_models(spark, sf)
    table = ensure_columns(V.postings(spark, sf))
    result = A.batch_assign(table, posting_lists(spark, sf), posting_attributes(spark, sf), models, catalog, limit=None)
    return result.results.groupBy("job_type", "payment_group", "status").agg(F.count("*").alias("n"))


@query("batch_summary")
def batch_summary(spark, sf):
    models, catalog = clean_models(spark, sf)
    table = ensure_columns(V.postings(spark, sf))
    result = A.batch_assign(table, posting_lists(spark, sf), posting_attributes(spark, sf), models, catalog, limit=None)
    left = result.snapshot.agg(F.count_if(F.col("segment_id").isNull()).alias("n_still_unassigned"))
    return beside(result.summary(), left)


STREAM_SCHEMA = "id long, title string, content string, payment int, job_type string"


@query("streamed_assignment")
def streamed_assignment(spark, sf):
    """The same assignment over postings that arrive as files."""
    models, catalog = clean_models(spark, sf)
    source, sink = scratch_path(spark, "arriving"), scratch_path(spark, "streamed")
    V.postings(spark, sf).filter("is_deleted = 0 AND is_expired = 0").select("id", "title", "content", "payment", "job_type").repartition(4).write.parquet(source)
    stream = ST.read_posting_stream(spark, source, STREAM_SCHEMA, max_files=2)
    job = ST.assign_stream(stream, cut(posting_lists(spark, sf)), cut(posting_attributes(spark, sf)), models, cut(catalog), sink, f"{sink}/checkpoint")
    job.awaitTermination()
    rows = ST.read_sink(spark, f"{sink}/assigned", "id long, segment_id int, segment_version string, segment_confidence float, batch_id int")
    return rows.groupBy("segment_id", "segment_version").agg(F.count("*").alias("n"))
