"""Grades, gates, differences, report tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from segloom.config import AXES, CELL, KEY_AXES
from segloom.operators import quality as Q
from segloom.operators import report as RP
from segloom.operators import stats as S
from segloom.plans import views as V
from segloom.plans.registry import query
from segloom.plans.scalars_queries import WS
from segloom.plans.stats_queries import METRICS, SEGMENTS, dominant_sql, key_sql, long_sql, rounded

CELLS = "job_type, payment_group"
ASSIGNED = ("v_assigned",)
SLUG = "job_type || '_' || payment_group"
GRADED = f"""graded AS (SELECT *, CASE WHEN segment_id = -1 OR {SLUG} IN ('beauty_pay', 'photo_pay', 'photo_n3') THEN 'D' WHEN n < 30 OR pct_cell > 40 THEN 'C'
  WHEN n >= 50 AND pct_cell <= 25 AND (purpose_top >= 0.7 OR topic_top >= 0.7) THEN 'A' ELSE 'B' END AS grade,
  CASE WHEN segment_id = -1 THEN 'info_poor' WHEN {SLUG} IN ('beauty_pay', 'photo_pay', 'photo_n3') THEN 'small_cell'
  ELSE concat_ws(',', CASE WHEN n < 30 THEN 'micro' END, CASE WHEN pct_cell > 40 THEN 'catch_all' END) END AS flags FROM segs)"""


def graded(spark, sf):
    return Q.grade(S.segment_table(V.assigned(spark, sf)))


@query("segment_grades", f"WITH {SEGMENTS}, {GRADED} SELECT {CELLS}, segment_id, segment_key, n, round(pct_cell, 6) AS pct_cell, grade, flags FROM graded", ASSIGNED)
def segment_grades(spark, sf):
    out = graded(spark, sf).select(*CELL, "segment_id", "segment_key", "n", "pct_cell", "grade", F.array_join("flags", ",").alias("flags"))
    return rounded(out, "pct_cell")


@query(
    "stop_check",
    f"""WITH {SEGMENTS}, {GRADED}, {METRICS}, g AS (SELECT count(*) FILTER (segment_id <> -1 AND grade = 'A' AND {SLUG} = 'model_n2') AS focus_a,
        count(*) FILTER (segment_id <> -1 AND grade IN ('A', 'B')) * 100.0::DOUBLE / count(*) FILTER (segment_id <> -1) AS ab_pct FROM graded),
        k AS (SELECT *, CAST(focus_max_pct <= 30 AS INT) AS ok_focus_max, CAST(focus_a >= 10 AS INT) AS ok_focus_a, CAST(n_micro <= 3 AS INT) AS ok_micro,
        CAST(catch_all_cells <= 0 AS INT) AS ok_catch_all, CAST(n_poor <= 120 AS INT) AS ok_poor, CAST(ab_pct >= 75 AS INT) AS ok_ab FROM m, g)
        SELECT * REPLACE (round(ab_pct, 6) AS ab_pct), CAST(ok_focus_max + ok_focus_a + ok_micro + ok_catch_all + ok_poor + ok_ab = 6 AS INT) AS passed FROM k""",
    ASSIGNED,
)
def stop_check(spark, sf):
    out = Q.stop_check(graded(spark, sf))
    flags = [c for c in out.columns if c.startswith("ok_")] + ["passed"]
    return rounded(out.withColumns({c: F.col(c).cast("int") for c in flags}), "ab_pct")


@query(
    "grade_distribution",
    f"WITH {SEGMENTS}, {GRADED} SELECT {CELLS}, " + ", ".join(f"count(*) FILTER (grade = '{g}') AS n_{g.lower()}" for g in "ABCD") + " FROM graded WHERE segment_id <> -1 GROUP BY ALL",
    ASSIGNED,
)
def grade_distribution(spark, sf):
    return Q.grade_distribution(graded(spark, sf))


@query("weak_segments", f"WITH {SEGMENTS}, {GRADED} SELECT {CELLS}, segment_id, n, grade FROM graded WHERE segment_id <> -1 AND grade IN ('C', 'D')", ASSIGNED)
def weak_segments(spark, sf):
    return Q.weak_segments(graded(spark, sf)).select(*CELL, "segment_id", "n", "grade")


# --- differences between two assignments ------------------------------------------

VB = ("v_assign_b",)
KEYED = """mv AS (SELECT posting_id AS id, a_id, b_id, 'k' || (a_id // 2) AS a_key, 'k' || (b_id // 2) AS b_key, CASE WHEN b_id = -1 THEN 'k' || (a_id // 2) <> 'k' || (b_id // 2) ELSE a_id <> b_id END AS moved
  FROM v_assign_b WHERE posting_id % 3 <> 0)"""


def moves(spark, sf):
    rows = V.second_assignment(spark, sf).withColumnRenamed("posting_id", "id")

    def side(c):
        half = F.when(F.col(c) < 0, 0).otherwise(F.floor(F.col(c) / 2)).cast("int")  # integer division towards zero
        return rows.select("id", F.col(c).alias("segment_id"), F.concat(F.lit("k"), half).alias("segment_key"))

    return Q.assignment_moves(side("a_id"), side("b_id"), rows.filter("id % 3 <> 0"))


@query(
    "assignment_diff",
    f"WITH {KEYED} SELECT count(*) FILTER (NOT moved) AS n_same, count(*) FILTER (moved) AS n_moved, count(*) FILTER (b_id = -1) AS n_info_poor FROM mv",
    VB,
)
def assignment_diff(spark, sf):
    return Q.move_summary(moves(spark, sf))


@query("move_pairs", f"WITH {KEYED} SELECT a_key AS src_key, b_key AS dst_key, count(*) AS n FROM mv WHERE moved GROUP BY ALL ORDER BY n DESC, 1, 2 LIMIT 15", VB)
def move_pairs(spark, sf):
    return Q.move_pairs(moves(spark, sf), 15)


@query(
    "move_ends",
    f"WITH {KEYED} SELECT 'source' AS side, a_key AS segment_key, count(*) AS n FROM mv GROUP BY ALL UNION ALL SELECT 'destination', b_key, count(*) FROM mv GROUP BY ALL",
    VB,
)
def move_ends(spark, sf):
    return Q.move_ends(moves(spark, sf))




@query(
    "move_examples",
    f"""WITH {KEYED}, r AS (SELECT *, CAST(row_number() OVER (PARTITION BY a_key, b_key ORDER BY id) AS INT) AS rank FROM mv WHERE moved QUALIFY rank <= 3),
        t AS (SELECT v.posting_id AS id, trim(regexp_replace(d.text, '[\\s\\x0b]+', ' ', 'g')) AS x FROM v_labeled v JOIN documents d ON d.doc_id = v.l_orderkey)
        SELECT a_key AS src_key, b_key AS dst_key, rank, r.id, CASE WHEN length(x) > 100 THEN substr(x, 1, 100) || '...' ELSE x END AS preview FROM r LEFT JOIN t USING (id)""",
    VB,
)
def move_examples(spark, sf):
    documents = V.table(spark, sf, "documents").select(F.col("doc_id").alias("l_orderkey"), "text")
    texts = V.labeled(spark, sf).select(F.col("posting_id").alias("id"), "l_orderkey").join(documents, "l_orderkey")
    return Q.move_examples(moves(spark, sf), texts).select("src_key", "dst_key", "rank", "id", "preview")


# --- nested views and report tables --------------------------------------------------

VIEW_KEYS = dominant_sql("(SELECT * FROM v_assigned WHERE segment_id <> -1)", CELLS + ", segment_id", KEY_AXES)


def post_frame(spark, sf):
    """Title, content and category of the document behind each posting."""
    rows = V.assigned(spark, sf).select("posting_id", F.col("l_orderkey").alias("doc_id"))
    documents = V.table(spark, sf, "documents").select("doc_id", "text", "lang")
    joined = rows.join(documents, "doc_id", "left")
    return joined.select("posting_id", F.split("text", "\n")[0].alias("title"), F.col("text").alias("content"), F.array("lang").alias("categories"))


@query(
    "segment_view",
    f"""WITH {SEGMENTS}, {GRADED}, mk AS (SELECT {CELLS}, segment_id, '(' || replace({key_sql()}, '|', ', ') || ')' AS merge_key FROM ({VIEW_KEYS})),
        f AS (SELECT {CELLS}, segment_id, posting_id, l_orderkey, row_number() OVER (PARTITION BY {CELLS}, segment_id ORDER BY posting_id) AS r FROM v_assigned QUALIFY r <= 30),
        d AS (SELECT doc_id, lang, nullif(trim(string_split(text, chr(10))[1], e' \t\n\r'), '') AS t, nullif(trim(text, e' \t\n\r'), '') AS c FROM documents),
        p AS (SELECT {CELLS}, segment_id, CAST(count(*) AS INT) AS posts_shown, string_agg(posting_id || ':' || coalesce(lang, '') || ':' || md5(concat_ws(chr(10), t, c)), ',' ORDER BY r) AS posts FROM f LEFT JOIN d ON doc_id = l_orderkey GROUP BY ALL)
        SELECT job_type, payment_group, payment_group || '_' || job_type AS cell_key, CAST(sum(n) OVER (PARTITION BY {CELLS}) AS BIGINT) AS cell_count, segment_id, segment_key, grade, merge_key, n AS post_count, posts_shown, posts
        FROM graded LEFT JOIN mk USING (job_type, payment_group, segment_id) JOIN p USING (job_type, payment_group, segment_id)""",
    ASSIGNED,
)
def segment_view(spark, sf):
    """Segments with their first posts; the posts' texts as digests."""
    rows = RP.segment_view(V.assigned(spark, sf), post_frame(spark, sf), cap=30, key="posting_id")
    shown = F.transform("posts", lambda p: F.concat_ws(":", p["id"].cast("string"), F.coalesce(p["categories"][0], F.lit("")), F.md5(p["text"])))
    return rows.drop("version").withColumn("posts", F.array_join(shown, ","))


COUNTS = f"SELECT *, n / sum(n) OVER (PARTITION BY {CELLS}, segment_id, axis) AS share, row_number() OVER (PARTITION BY {CELLS}, segment_id, axis ORDER BY n DESC, value) AS rank FROM ({long_sql('v_assigned', CELLS + ', segment_id', AXES)})"


# Shares are written with one digit, halves to the even one as Java's formatter does; counts that leave a half are settled by the exact share.
_PCT = "format('{:,.1f}', round_even(share * 100, 1))"
SHOWN = f"""string_agg(CASE WHEN rank = 1 AND value <> '불명확' AND share >= 0.7 THEN '**' || value || ': ' || {_PCT} || '%**' ELSE value || ': ' || {_PCT} || '%' END, ', ' ORDER BY rank) FILTER (rank <= 8)
        || CASE WHEN count(*) > 8 THEN ', … (외 ' || (count(*) - 8) || '값)' ELSE '' END"""


@query(
    "axis_distributions",
    f"""SELECT {CELLS}, segment_id, axis, count(*) FILTER (rank > 3) AS n_more, CAST(bool_or(rank = 1 AND value <> '불명확' AND share >= 0.7) AS INT) AS has_bold,
        string_agg(value, ',' ORDER BY rank) FILTER (rank <= 3) AS top_values FROM ({COUNTS}) GROUP BY {CELLS}, segment_id, axis""",
    ASSIGNED,
)
def axis_distributions(spark, sf):
    out = RP.axis_distribution(V.assigned(spark, sf), [*CELL, "segment_id"], AXES, top=3)
    # the values of the formatted line "v: p%, v: p% … "
    bare = F.regexp_replace(F.regexp_replace("shown", ", … .*$", ""), r"\*\*|: [0-9.]+%", "")
    return out.select(*CELL, "segment_id", "axis", "n_more", F.col("has_bold").cast("int").alias("has_bold"), F.regexp_replace(bare, ", ", ",").alias("top_values"))


@query(
    "report_lines",
    f"""WITH t AS (SELECT {CELLS}, segment_id, min(segment_key) AS k, count(*) AS n FROM v_assigned GROUP BY ALL),
        c AS (SELECT {CELLS}, sum(n) AS n, coalesce(sum(n) FILTER (segment_id = -1), 0) AS p, count(*) FILTER (segment_id <> -1) AS s FROM t GROUP BY ALL)
        SELECT {CELLS}, -2 AS segment_id, 0 AS part, '[' || job_type || ' x ' || payment_group || '] rows ' || n || ', info-poor ' || p || ', raw ' || s || ', segments ' || s AS line FROM c
        UNION ALL SELECT {CELLS}, segment_id, 1, 'segment ' || segment_id || ' ' || k || ': ' || n FROM t
        UNION ALL SELECT {CELLS}, segment_id, 2, 'sources ' || segment_id || ':' || n FROM t WHERE segment_id <> -1
        UNION ALL SELECT {CELLS}, segment_id, 3, axis || ' ' || {SHOWN} FROM ({COUNTS}) GROUP BY {CELLS}, segment_id, axis""",
    ASSIGNED,
)
def report_lines(spark, sf):
    return RP.report_lines(V.assigned(spark, sf)).select(*CELL, "segment_id", "part", "line")


@query(
    "written_report",
    f"""WITH t AS (SELECT DISTINCT {CELLS}, segment_id FROM v_assigned), x AS (SELECT count(*) AS n, count(*) FILTER (segment_id <> -1) AS s, count(DISTINCT ({CELLS})) AS c FROM t)
        SELECT 'segment' AS word, n FROM x UNION ALL SELECT 'sources', s FROM x UNION ALL SELECT '[' || job_type, count(DISTINCT payment_group) FROM t GROUP BY job_type
        UNION ALL SELECT axis, x.n FROM x, unnest([{', '.join(f"'{a}'" for a in AXES)}]) AS a(axis)""",
    ASSIGNED,
)
def written_report(spark, sf):
    """The text report, written and read back: number of lines per first word."""
    from segloom.runtime import scratch_path

    path = scratch_path(spark, "report")
    RP.write_report(V.assigned(spark, sf), path)
    return spark.read.text(path).groupBy(F.split("value", " ")[0].alias("word")).agg(F.count("*").alias("n"))


@query(
    "segment_examples",
    f"""WITH {SEGMENTS}, {GRADED}, f AS (SELECT {CELLS}, segment_id, posting_id, l_orderkey, row_number() OVER (PARTITION BY {CELLS}, segment_id ORDER BY posting_id) AS r FROM v_assigned QUALIFY r <= 3),
        t AS (SELECT doc_id, CASE WHEN length(t) > 100 THEN substr(t, 1, 100) || '...' ELSE t END AS preview FROM (SELECT doc_id, trim(regexp_replace(coalesce(text, ''), '{WS}', ' ', 'g')) AS t FROM documents)),
        e AS (SELECT {CELLS}, segment_id, string_agg(posting_id || '=' || coalesce(preview, ''), ',' ORDER BY r) AS examples FROM f LEFT JOIN t ON doc_id = l_orderkey GROUP BY ALL)
        SELECT {CELLS}, segment_id, n, grade, examples FROM graded JOIN e USING (job_type, payment_group, segment_id)""",
    ASSIGNED,
)
def segment_examples(spark, sf):
    rows = V.assigned(spark, sf)
    documents = V.table(spark, sf, "documents").select(F.col("doc_id").alias("l_orderkey"), "text")
    texts = rows.select("posting_id", "l_orderkey").join(documents, "l_orderkey", "left").select("posting_id", "text")
    out = RP.segment_examples(rows, texts, key="posting_id")
    shown = F.array_join(F.transform("examples", lambda e: F.concat(e["id"].cast("string"), F.lit("="), F.coalesce(e["preview"], F.lit("")))), ",")
    return out.select(*CELL, "segment_id", "n", "grade", shown.alias("examples"))
