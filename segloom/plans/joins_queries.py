"""Joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from segloom.operators import joins as J
from segloom.plans import views as V
from segloom.plans.registry import query

CATS = ("v_categories", "v_posting_categories")
NAMES = """names AS (SELECT b.job_posting_id AS id, string_agg(c.name, '|' ORDER BY c.category_id) AS cats
  FROM v_posting_categories b JOIN v_categories c USING (category_id) GROUP BY 1)"""


def orders(spark, sf):
    return V.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), (F.col("o_orderkey") % 5).cast("int").alias("code"))


def categorised(spark, sf, how="left"):
    return J.attach_categories(orders(spark, sf), V.posting_categories(spark, sf), V.categories(spark, sf), how=how, distinct_pairs=True)


@query(
    "posting_categories",
    f"WITH {NAMES} SELECT o_orderkey AS id, coalesce(cats, '') AS categories FROM orders LEFT JOIN names ON id = o_orderkey",
    CATS,
)
def posting_categories(spark, sf):
    return categorised(spark, sf).select("id", F.array_join("categories", "|").alias("categories"))


@query(
    "repeated_categories",
    """SELECT o_orderkey AS id, coalesce(string_agg(name, '|' ORDER BY category_id), '') AS categories FROM orders
       LEFT JOIN (SELECT l_orderkey, p_size AS category_id FROM lineitem JOIN part ON l_partkey = p_partkey) ON l_orderkey = o_orderkey
       LEFT JOIN v_categories USING (category_id) GROUP BY 1""",
    CATS,
)
def repeated_categories(spark, sf):
    rows = J.attach_categories(orders(spark, sf), V.line_categories(spark, sf), V.categories(spark, sf))
    return rows.select("id", F.array_join("categories", "|").alias("categories"))


@query(
    "phase1_signals",
    f"""WITH {NAMES} SELECT doc_id AS id, concat_ws('|', lang, source, CASE WHEN cats IS NOT NULL THEN '카테고리:' || replace(cats, '|', '|카테고리:') END) AS all_signals
        FROM documents JOIN orders ON o_orderkey = doc_id LEFT JOIN names ON names.id = doc_id""",
    CATS,
)
def phase1_signals(spark, sf):
    phase1 = V.table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.array("lang", "source").alias("keywords"))
    merged = J.merge_phase1(phase1, categorised(spark, sf))
    return merged.select("id", F.array_join("all_signals", "|").alias("all_signals"))


@query(
    "unmatched_postings",
    "SELECT count(*) AS n_skipped FROM orders WHERE o_orderkey NOT IN (SELECT doc_id FROM documents)",
)
def unmatched_postings(spark, sf):
    docs = V.table(spark, sf, "documents").withColumnRenamed("doc_id", "id")
    return J.unmatched(orders(spark, sf), docs).agg(F.count("*").alias("n_skipped"))


TYPES = """types AS (SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'model' WHEN 'AUTOMOBILE' THEN 'beauty' WHEN 'MACHINERY' THEN '' END AS t FROM customer
  WHERE c_custkey % 7 <> 0)"""


def types(spark, sf):
    kind = F.when(F.col("c_mktsegment") == "BUILDING", "model").when(F.col("c_mktsegment") == "AUTOMOBILE", "beauty").when(F.col("c_mktsegment") == "MACHINERY", "")
    return V.table(spark, sf, "customer").filter("c_custkey % 7 <> 0").select(F.col("c_custkey").alias("o_custkey"), kind.alias("job_type"))


@query(
    "type_lookup",
    f"WITH {TYPES} SELECT o_orderkey, t AS job_type FROM orders JOIN types ON c_custkey = o_custkey WHERE t <> ''",
)
def type_lookup(spark, sf):
    rows = V.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return J.map_lookup(rows, types(spark, sf), "o_custkey", "job_type").select("o_orderkey", "job_type")


@query(
    "type_lookup_report",
    f"WITH {TYPES} SELECT count(*) FILTER (coalesce(t, '') <> '') AS n_mapped, count(*) FILTER (coalesce(t, '') = '') AS n_dropped FROM orders LEFT JOIN types ON c_custkey = o_custkey",
)
def type_lookup_report(spark, sf):
    rows = V.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return J.lookup_report(rows, types(spark, sf), "o_custkey", "job_type")


# labels without a text: every third id is shifted out of the id range
LABELS = "lab AS (SELECT CASE WHEN doc_id % 3 = 0 THEN doc_id + 10000000 ELSE doc_id END AS id, quality FROM labels)"


def shifted_labels(spark, sf):
    key = F.col("doc_id")
    return V.table(spark, sf, "labels").select(F.when(key % 3 == 0, key + 10000000).otherwise(key).alias("id"), "quality")


@query(
    "labels_with_texts",
    f"WITH {LABELS} SELECT id, quality, coalesce(text, '') AS text, CAST(doc_id IS NOT NULL AS INT) AS text_found FROM lab LEFT JOIN documents ON doc_id = id",
)
def labels_with_texts(spark, sf):
    texts = V.table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")
    rows = J.join_labels_text(shifted_labels(spark, sf), texts)
    return rows.withColumn("text_found", F.col("text_found").cast("int"))


@query(
    "assignments_with_attributes",
    """SELECT d.id, d.segment, a.lang AS inner_lang FROM (SELECT o_orderkey AS id, o_orderpriority AS segment FROM orders) d
       LEFT JOIN (SELECT doc_id, lang FROM documents) a ON a.doc_id = d.id WHERE d.id % 2 = 0 OR a.doc_id IS NOT NULL""",
)
def assignments_with_attributes(spark, sf):
    rows = V.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("segment"))
    attributes = V.table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("inner_lang"))
    even = J.join_attributes(rows.filter("id % 2 = 0"), attributes, how="left")
    odd = J.join_attributes(rows.filter("id % 2 <> 0"), attributes)
    return J.union_cells(even, odd)


@query("pending_rows", "SELECT doc_id AS id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def pending_rows(spark, sf):
    work = V.table(spark, sf, "documents").select(F.col("doc_id").alias("id"))
    return J.pending(work, V.table(spark, sf, "labels").withColumnRenamed("doc_id", "id"))


@query("rows_by_id_list", "SELECT doc_id AS id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def rows_by_id_list(spark, sf):
    rows = V.table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "source")
    return J.by_id_list(rows, V.table(spark, sf, "labels").withColumnRenamed("doc_id", "id"))


@query(
    "deduplicated_rows",
    """SELECT l_orderkey AS id, l_linenumber, l_partkey, l_suppkey FROM lineitem
       QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) = 1""",
)
def deduplicated_rows(spark, sf):
    rows = V.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id"), "l_linenumber", "l_partkey", "l_suppkey")
    return J.dedup_by_id(rows, "id", ["l_linenumber", "l_partkey", "l_suppkey"])


@query(
    "union_of_cells",
    """SELECT job_type, payment_group, CASE WHEN place = '불명확' THEN 'poor' ELSE 'rest' END AS part, count(*) AS n FROM v_cells GROUP BY ALL""",
    ("v_cells",),
)
def union_of_cells(spark, sf):
    cells = V.cells(spark, sf).select("job_type", "payment_group", "place")
    poor = cells.filter("place = '불명확'").withColumn("part", F.lit("poor"))
    rest = cells.filter("place <> '불명확'").withColumn("part", F.lit("rest"))
    return J.union_cells(poor, rest).groupBy("job_type", "payment_group", "part").agg(F.count("*").alias("n"))


@query(
    "category_conflicts",
    f"WITH {NAMES} SELECT o_orderkey AS id, CAST(coalesce(regexp_matches(cats, '(^|[|])(웨딩|커플|한복)($|[|])'), FALSE) AS INT) AS conflict FROM orders LEFT JOIN names ON id = o_orderkey",
    CATS,
)
def category_conflicts(spark, sf):
    return categorised(spark, sf).select("id", J.conflicts("categories", ("웨딩", "커플", "한복")).cast("int").alias("conflict"))


@query("sorted_ids", "SELECT doc_id AS id, row_number() OVER (ORDER BY doc_id) AS position FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def sorted_ids(spark, sf):
    # the order is a column: rank within a range-partitioned block plus the rows before the block
    rows = J.by_id_list(V.table(spark, sf, "documents").select(F.col("doc_id").alias("id")), V.table(spark, sf, "labels").withColumnRenamed("doc_id", "id"))
    from segloom.operators.ranking import global_position

    return global_position(rows, "id", "position")
