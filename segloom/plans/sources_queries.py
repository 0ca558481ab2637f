"""Scans and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from segloom.plans import views as V
from segloom.plans.registry import query
from segloom.runtime import scratch_path
from segloom.sources import readers, sinks

POSTS = ("v_postings",)


@query("postings_scan", "SELECT doc_id AS id, text AS content, lang AS job_type, n_chars AS payment FROM documents")
def postings_scan(spark, sf):
    names = {"id": "doc_id", "content": "text", "job_type": "lang", "payment": "n_chars"}
    return readers.read_postings(spark, f"{sf}/documents.parquet", names)


JSONL = "id long, title string, job_type string, payment int, tags array<string>, llm_result struct<kind: string, n: int>"


@query(
    "jsonl_round_trip",
    """SELECT id, title, job_type, payment, lang || ',' || source AS tags, lang AS kind, CAST(length(content) AS INT) AS n FROM v_postings""",
    POSTS,
)
def jsonl_round_trip(spark, sf):
    path = scratch_path(spark, "jsonl")
    rows = V.postings(spark, sf).select(
        "id", "title", "job_type", "payment", F.array("lang", "source").alias("tags"),
        F.struct(F.col("lang").alias("kind"), F.length("content").alias("n")).alias("llm_result"),
    )
    sinks.write_json_lines(rows, path)
    back = readers.read_jsonl(spark, path, JSONL)
    return back.select("id", "title", "job_type", "payment", F.array_join("tags", ",").alias("tags"), "llm_result.kind", "llm_result.n")


@query("csv_round_trip", "SELECT id, content, payment FROM v_postings", POSTS)
def csv_round_trip(spark, sf):
    path = scratch_path(spark, "csv")
    rows = V.postings(spark, sf).select("id", "title", "content", "payment", "lang")
    rows.write.option("header", True).option("quote", '"').option("escape", '"').option("quoteAll", True).option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(path)
    schema = "id long, title string, content string, payment int, lang string"
    return readers.read_csv(spark, path, schema, ["id", "content", "payment"])


@query(
    "written_assignments",
    "SELECT posting_id AS id, job_type, payment_group, segment_id, segment_key FROM v_assigned",
    ("v_assigned",),
)
def written_assignments(spark, sf):
    path = scratch_path(spark, "assignments")
    rows = V.assigned(spark, sf).select(F.col("posting_id").alias("id"), "job_type", "payment_group", "segment_id", "segment_key")
    sinks.write_assignments(rows, path)
    return readers.read_assignments(spark, path).select("id", "job_type", "payment_group", "segment_id", "segment_key")


@query(
    "written_catalogue_json",
    """SELECT payment_group || '_' || job_type AS cell, CAST(segment_id AS VARCHAR) AS segment, min(segment_key) AS segment_key, count(*) AS n
       FROM v_assigned WHERE segment_id <> -1 GROUP BY ALL""",
    ("v_assigned",),
)
def written_catalogue_json(spark, sf):
    from segloom.operators.report import catalog_document, segment_catalog

    path = scratch_path(spark, "catalogue")
    sinks.write_json_lines(catalog_document(segment_catalog(V.assigned(spark, sf))), path)
    back = readers.read_jsonl(spark, path, "cell string, segments map<string, struct<segment_key: string, n: long>>")
    return back.select("cell", F.explode("segments").alias("segment", "s")).select("cell", "segment", "s.segment_key", "s.n")


@query(
    "fetched_texts",
    """SELECT id, coalesce(title, '') AS title, coalesce(content, '') AS content FROM v_postings WHERE id IN (SELECT doc_id FROM labels)""",
    POSTS,
)
def fetched_texts(spark, sf):
    return readers.fetch_texts(V.postings(spark, sf), V.table(spark, sf, "labels").withColumnRenamed("doc_id", "id"))


MERGED_SQL = """SELECT p.id, CASE WHEN l.doc_id IS NULL THEN CASE WHEN p.id % 3 = 0 THEN 7 END ELSE l.quality END AS segment_id,
   CASE WHEN l.doc_id IS NULL THEN CASE WHEN p.id % 3 = 0 THEN 'v1' END ELSE 'v2' END AS segment_version,
   CASE WHEN l.doc_id IS NULL THEN CASE WHEN p.id % 3 = 0 THEN 0.5 END ELSE 0.25 END::DOUBLE AS segment_confidence,
   CASE WHEN l.doc_id IS NOT NULL THEN '2026-01-02' END AS assigned_on
   FROM v_postings p LEFT JOIN labels l ON p.id = l.doc_id"""


def stored_and_new(spark, sf):
    """Postings of which a third is assigned, and the updates of the labelled ones."""
    old = F.col("id") % 3 == 0
    target = V.postings(spark, sf).select(
        "id", F.when(old, 7).alias("segment_id"), F.when(old, "v1").alias("segment_version"), F.when(old, 0.5).alias("segment_confidence")
    )
    updates = V.table(spark, sf, "labels").select(
        F.col("doc_id").alias("id"), F.col("quality").alias("segment_id"), F.lit("v2").alias("segment_version"), F.lit(0.25).alias("segment_confidence")
    )
    return target, updates


def assigned_on(merged):
    return merged.select(
        "id", "segment_id", "segment_version", F.col("segment_confidence").cast("double").alias("segment_confidence"),
        F.date_format("segment_assigned_at", "yyyy-MM-dd").alias("assigned_on"),
    )


MERGED_AT = "2026-01-02 03:04:05"


@query("merged_assignments", MERGED_SQL, POSTS)
def merged_assignments(spark, sf):
    target, updates = stored_and_new(spark, sf)
    return assigned_on(sinks.merge_assignments(target, updates, at=F.lit(MERGED_AT)))


@query("merged_buckets", MERGED_SQL, POSTS)
def merged_buckets(spark, sf):
    """The same on a stored table of which only the buckets with updated ids are rewritten."""
    target, updates = stored_and_new(spark, sf)
    path = scratch_path(spark, "assignments")
    sinks.write_bucketed(target, path, buckets=64)
    sinks.merge_into(spark, path, updates, at=F.lit(MERGED_AT), buckets=64)
    return assigned_on(sinks.read_bucketed(spark, path))


@query(
    "ensured_columns",
    "SELECT id, lang AS segment_version, CAST(NULL AS INT) AS segment_id, CAST(NULL AS DOUBLE) AS segment_confidence FROM v_postings",
    POSTS,
)
def ensured_columns(spark, sf):
    rows = V.postings(spark, sf).select("id", F.col("lang").alias("segment_version"))
    out = sinks.ensure_columns(rows)
    return out.select("id", "segment_version", "segment_id", F.col("segment_confidence").cast("double").alias("segment_confidence"))


@query(
    "update_plan",
    """WITH plan AS (SELECT p.id, l.quality AS segment_id FROM v_postings p LEFT JOIN labels l ON p.id = l.doc_id),
       shown AS (SELECT id, segment_id FROM plan WHERE segment_id IS NOT NULL ORDER BY id LIMIT 3)
       SELECT (SELECT count(*) FROM plan WHERE segment_id IS NOT NULL) AS n_update, (SELECT count(*) FROM plan WHERE segment_id IS NULL) AS n_skipped,
       (SELECT string_agg(id || ':' || segment_id, ',' ORDER BY id) FROM shown) AS sample""",
    POSTS,
)
def update_plan(spark, sf):
    labels = V.table(spark, sf, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("segment_id"))
    return sinks.update_summary(sinks.update_plan(V.postings(spark, sf).select("id"), labels))


