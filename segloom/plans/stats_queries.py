"""Aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segloom.config import AXES, CELL, DENSITY_AXES, HYBRID, KEY_AXES, MISSING, VERSION
from segloom.functions import text as X
from segloom.operators import merge as MG
from segloom.operators import signals as G
from segloom.operators import stats as S
from segloom.plans import views as V
from segloom.plans.registry import query
from segloom.runtime import cut

M = MISSING
LINES = ("v_lines",)
LABELED = ("v_labeled",)
ASSIGNED = ("v_assigned",)
CELLS = "job_type, payment_group"


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


def long_sql(source: str, by: str, axes) -> str:
    """Rows per (by, axis, value) of the source."""
    return " UNION ALL ".join(
        f"SELECT {by}, '{a}' AS axis, CAST({a} AS VARCHAR) AS value, count(*) AS n FROM {source} GROUP BY ALL" for a in axes
    )


def top_sql(source: str, by: str, axes) -> str:
    """Top value per (by, axis) with its count and the total."""
    return f"""SELECT *, sum(n) OVER (PARTITION BY {by}, axis) AS total FROM ({long_sql(source, by, axes)})
      QUALIFY row_number() OVER (PARTITION BY {by}, axis ORDER BY n DESC, value) = 1"""


def dominant_sql(source: str, by: str, axes, threshold=0.70, missing_is_value=False) -> str:
    first = "" if missing_is_value else f"WHEN value = '{M}' THEN '{M}' "
    dom = f"CASE {first}WHEN n / total >= {threshold} THEN value ELSE '{HYBRID}' END"
    wide = ", ".join(f"max(CASE WHEN axis = '{a}' THEN {dom} END) AS dom_{a}" for a in axes)
    return f"SELECT {by}, CAST(max(total) AS BIGINT) AS n, {wide} FROM ({top_sql(source, by, axes)}) GROUP BY ALL"


@query(
    "value_counts",
    f"""SELECT {CELLS}, axis, value, n, round(n / sum(n) OVER (PARTITION BY {CELLS}, axis), 6) AS share,
        CAST(row_number() OVER (PARTITION BY {CELLS}, axis ORDER BY n DESC, value) AS INT) AS rank FROM ({long_sql('v_lines', CELLS, AXES)}) QUALIFY rank <= 4""",
    LINES,
)
def value_counts(spark, sf):
    return rounded(S.value_counts(V.lines(spark, sf), CELL, AXES, 4), "share")


@query("dominant_values", dominant_sql("(SELECT * FROM v_labeled WHERE raw_cluster_id <> -1)", CELLS + ", raw_cluster_id", KEY_AXES), LABELED)
def dominant_values(spark, sf):
    return S.dominants(V.labeled(spark, sf).filter("raw_cluster_id <> -1"), [*CELL, "raw_cluster_id"])


@query(
    "dominant_values_first_version",
    dominant_sql("v_labeled", "raw_cluster_id", ("purpose", "place", "topic"), 0.60, True),
    LABELED,
)
def dominant_values_first_version(spark, sf):
    return S.dominants(V.labeled(spark, sf), ["raw_cluster_id"], ("purpose", "place", "topic"), 0.60, missing_is_value=True)


def key_sql(topic="dom_topic"):
    def named(a):
        return f"CASE WHEN dom_{a} NOT IN ('{HYBRID}', '{M}') THEN dom_{a} END"

    parts = f"dom_purpose, dom_place, {topic}, CASE WHEN job_type <> 'photo' THEN {named('treatment')} END, {named('career')}, {named('continuity')}"
    return f"array_to_string(list_filter([{parts}], lambda p: p IS NOT NULL), '|')"


INFO = dominant_sql("(SELECT * FROM v_labeled WHERE raw_cluster_id <> -1)", CELLS + ", raw_cluster_id", KEY_AXES)
COARSE = key_sql(f"CASE WHEN dom_topic NOT IN ('{HYBRID}', '{M}') THEN dom_topic END")


@query("cluster_info", f"SELECT *, {key_sql()} AS merge_key, {COARSE} AS coarse_key FROM ({INFO})", LABELED)
def cluster_info(spark, sf):
    info = MG.cluster_info(V.labeled(spark, sf), "raw_cluster_id")
    return info.withColumns({k: F.array_join(k, "|") for k in ("merge_key", "coarse_key")})


@query(
    "unclear_stats",
    f"""WITH c AS ({long_sql('v_cells', 'job_type', AXES)}), d AS (SELECT * FROM c WHERE NOT (axis = 'treatment' AND job_type = 'photo'))
        SELECT axis, job_type, CAST(grouping(job_type) AS INT) AS overall, CAST(sum(n) FILTER (value = '{M}') AS BIGINT) AS n_missing, CAST(sum(n) AS BIGINT) AS n_rows,
        round(sum(n) FILTER (value = '{M}') * 100.0::DOUBLE / sum(n), 6) AS missing_pct, CAST(sum(n) FILTER (value = '{M}') * 100.0::DOUBLE / sum(n) >= 30 AS INT) AS flagged
        FROM d GROUP BY GROUPING SETS ((axis), (axis, job_type))""",
    ("v_cells",),
)
def unclear_stats(spark, sf):
    out = S.unclear_stats(V.cells(spark, sf), AXES, defined={"treatment": ("model", "beauty")})
    return rounded(out, "missing_pct").withColumn("flagged", F.col("flagged").cast("int"))


@query(
    "unclear_limits",
    f"""SELECT axis, CAST(sum(n) FILTER (value = '{M}') AS BIGINT) AS n_missing, CAST(sum(n) AS BIGINT) AS n_rows,
        CAST(sum(n) FILTER (value = '{M}') * 100.0::DOUBLE / sum(n) >= CASE axis WHEN 'place' THEN 70 WHEN 'purpose' THEN 50 WHEN 'topic' THEN 85 WHEN 'treatment' THEN 72 ELSE 50 END AS INT) AS over_limit
        FROM ({long_sql('v_lines', '1 AS one', AXES)}) GROUP BY axis""",
    LINES,
)
def unclear_limits(spark, sf):
    return S.unclear_limits(V.lines(spark, sf)).select("axis", "n_missing", "n_rows", F.col("over_limit").cast("int").alias("over_limit"))


@query(
    "parse_success",
    r"""SELECT t AS job_type, k AS post_kind, grouping(t, k) AS level, count(*) AS n_rows, count(*) FILTER (ok) AS n_ok, count(*) FILTER (NOT ok) AS n_fail, round(count(*) FILTER (ok) * 100.0::DOUBLE / count(*), 6) AS ok_pct
        FROM (SELECT CAST(id % 3 AS VARCHAR) AS t, CASE id % 5 WHEN 0 THEN '구인글' WHEN 1 THEN '지원글' END AS k, coalesce(json_valid(nullif(regexp_extract(raw_text, '\{[^{}]*\}'), '')), FALSE) AS ok FROM v_responses)
        GROUP BY GROUPING SETS ((t), (), (t, k), (k))""",
    ("v_responses",),
)
def parse_success(spark, sf):
    kind = F.col("id") % 5
    rows = V.responses(spark, sf).select(
        (F.col("id") % 3).cast("string").alias("job_type"),
        F.when(kind == 0, "구인글").when(kind == 1, "지원글").alias("post_kind"),
        X.extract_json_object("raw_text").isNotNull().alias("ok"),
    )
    return rounded(S.parse_success(rows, kind="post_kind"), "ok_pct")


# --- signals: words of the title as keywords, the language as category ----------

WORDS = r"""words AS (SELECT id, lang, unnest(string_split_regex(title, '[\s\x0b]+')) AS w FROM v_postings),
occ AS (SELECT id, w AS signal FROM words WHERE w <> '' UNION ALL SELECT id, '카테고리:' || lang FROM v_postings),
freq AS (SELECT signal, count(*) AS n, (SELECT count(*) FROM v_postings) AS n_posts FROM occ GROUP BY 1)"""
POSTS = ("v_postings",)


def signal_rows(spark, sf):
    words = F.filter(F.split("title", X.WHITE_SPACE), lambda w: w != "")
    return V.postings(spark, sf).select("id", "lang", X.all_signals(words, F.array("lang")).alias("all_signals"))


@query("signal_freq", f"WITH {WORDS} SELECT signal, n, n_posts, round(n / n_posts, 6) AS share FROM freq", POSTS)
def signal_freq(spark, sf):
    return rounded(G.signal_freq(signal_rows(spark, sf)), "share")


# keywords map to a Hangul form, to a Latin form (which falls back), or not at all
NORM = """norm AS (SELECT DISTINCT w AS keyword, CASE WHEN length(w) % 3 = 0 THEN '묶음' || left(w, 1) ELSE 'group' || left(w, 1) END AS canonical
  FROM words WHERE length(w) % 3 <> 2 AND w <> '')"""


def norm_map(spark, sf):
    word = F.col("keyword")
    words = signal_rows(spark, sf).select(F.explode("all_signals").alias("keyword")).filter(~word.startswith("카테고리:")).distinct()
    size = F.length(word) % 3
    target = F.concat(F.when(size == 0, F.lit("묶음")).otherwise(F.lit("group")), F.left(word, F.lit(1)))
    return words.filter(size != 2).select("keyword", target.alias("canonical"))


NORMED = f"""{WORDS}, {NORM}, nfreq AS (SELECT CASE WHEN signal LIKE '카테고리:%' THEN signal
  WHEN regexp_matches(canonical, '[가-힣]') THEN canonical ELSE signal END AS s, sum(n) AS n, n_posts FROM freq LEFT JOIN norm ON keyword = signal GROUP BY 1, 3)"""


@query("normalized_freq", f"WITH {NORMED} SELECT s AS signal, CAST(n AS BIGINT) AS n, n_posts, round(n / n_posts, 6) AS share FROM nfreq", POSTS)
def normalized_freq(spark, sf):
    out = G.normalized_freq(G.signal_freq(signal_rows(spark, sf)), norm_map(spark, sf))
    return rounded(out, "share")


@query(
    "freq_candidates",
    f"""WITH {NORMED}, t AS (SELECT unnest([0.003, 0.005, 0.01, 0.02, 0.03])::DOUBLE AS threshold)
        SELECT threshold, count(*) AS n_signals, count(*) FILTER (NOT starts_with(s, '카테고리:')) AS n_keywords, count(*) FILTER (starts_with(s, '카테고리:')) AS n_categories
        FROM nfreq, t WHERE n >= n_posts * threshold GROUP BY 1""",
    POSTS,
)
def freq_candidates(spark, sf):
    freq = G.normalized_freq(G.signal_freq(signal_rows(spark, sf)), norm_map(spark, sf))
    return G.candidate_summary(G.freq_candidates(freq))


# keyword clusters: words by first letter (lower case); small ones are noise
CLUSTERS = "occ AS (SELECT id, lang AS job_type, w AS keyword FROM words WHERE w <> ''), cl AS (SELECT DISTINCT keyword, ascii(lower(left(keyword, 1))) AS cluster_id FROM occ)"
WORDS_ONLY = r"words AS (SELECT id, lang, unnest(string_split_regex(title, '[\s\x0b]+')) AS w FROM v_postings)"


def occurrences(spark, sf):
    rows = V.postings(spark, sf).select("id", F.col("lang").alias("job_type"), F.split("title", X.WHITE_SPACE).alias("keywords"))
    return G.explode_keywords(rows, ["id", "job_type"])


def keyword_clusters(found):
    code = F.ascii(F.lower(F.left("keyword", F.lit(1))))
    return found.select("keyword", code.alias("cluster_id")).distinct()


@query(
    "coverage_gates",
    f"""WITH {WORDS_ONLY}, {CLUSTERS}, tot AS (SELECT lang AS job_type, count(*) AS total FROM v_postings GROUP BY 1),
        kw AS (SELECT cluster_id, keyword, count(*) AS n FROM occ JOIN cl USING (keyword) GROUP BY ALL),
        shape AS (SELECT cluster_id, count(*) AS n_keywords, max(n) / sum(n) AS max_share FROM kw GROUP BY 1),
        hit AS (SELECT cluster_id, job_type, count(DISTINCT id) AS hit FROM occ JOIN cl USING (keyword) GROUP BY ALL),
        rate AS (SELECT s.cluster_id, t.job_type, coalesce(hit, 0) AS hit, total FROM shape s CROSS JOIN tot t LEFT JOIN hit h ON h.cluster_id = s.cluster_id AND h.job_type = t.job_type),
        cov AS (SELECT cluster_id, CAST(sum(hit) AS BIGINT) AS n_hit, sum(hit) / sum(total) AS coverage, max(hit / total) - min(hit / total) AS spread FROM rate GROUP BY 1)
        SELECT cluster_id, n_keywords, round(max_share, 6) AS max_keyword_share, n_hit, round(coverage, 6) AS coverage, round(spread, 6) AS spread,
        CASE WHEN n_keywords < 5 THEN 'noise' WHEN coverage < 0.05 THEN 'coverage_low' WHEN max_share >= 0.9 THEN 'low_discrimination'
          WHEN spread > 0.15 THEN 'type_imbalance' ELSE 'pass' END AS verdict FROM shape JOIN cov USING (cluster_id)""",
    POSTS,
)
def coverage_gates(spark, sf):
    posts = V.postings(spark, sf).select("id", F.col("lang").alias("job_type"))
    found = cut(occurrences(spark, sf))  # the texts are taken apart once
    out = G.coverage_gates(keyword_clusters(found), found, posts)
    return rounded(out, "max_keyword_share", "coverage", "spread").select(
        "cluster_id", "n_keywords", "max_keyword_share", "n_hit", "coverage", "spread", "verdict"
    )


@query(
    "representative_keywords",
    f"""WITH {WORDS_ONLY}, {CLUSTERS} SELECT cluster_id, keyword, n, CAST(row_number() OVER (PARTITION BY cluster_id ORDER BY n DESC, keyword) AS INT) AS rank
        FROM (SELECT cluster_id, keyword, count(*) AS n FROM occ JOIN cl USING (keyword) GROUP BY ALL) QUALIFY rank <= 10""",
    POSTS,
)
def representative_keywords(spark, sf):
    found = cut(occurrences(spark, sf))
    return G.representative_keywords(keyword_clusters(found), found).select("cluster_id", "keyword", "n", "rank")


@query(
    "dimension_summary",
    """SELECT p_partkey // 20 AS threshold, count(*) AS signal_count, CAST(count(*) FILTER (kept) AS INT) AS n_kept, CAST(count(*) FILTER (NOT kept) AS INT) AS n_removed,
       coalesce(string_agg(p_name, ',' ORDER BY p_partkey) FILTER (kept), '') AS kept_names FROM (SELECT *, p_partkey % 2 = 0 AND p_partkey % 3 <> 0 AS kept FROM part) GROUP BY 1""",
)
def dimension_summary(spark, sf):
    key = F.col("p_partkey")
    item = F.struct(key.alias("key"), F.col("p_name").alias("name"), (key % 2 == 0).alias("is_useful"), (key % 3 == 0).alias("is_redundant"))
    # some twenty dimensions for a threshold, however large the table
    results = V.table(spark, sf, "part").groupBy(F.floor(key / 20).alias("threshold"))
    return G.dimension_summary(results.agg(F.count("*").alias("signal_count"), F.sort_array(F.collect_list(item)).alias("dimensions")))


# --- segments -------------------------------------------------------------------

SEGMENTS = f"""tops AS ({top_sql('v_assigned', CELLS + ', segment_id', DENSITY_AXES)}),
seg AS (SELECT {CELLS}, segment_id, CAST(max(total) AS BIGINT) AS n, {', '.join(f"max(n / total) FILTER (axis = '{a}') AS {a}_top" for a in DENSITY_AXES)} FROM tops GROUP BY ALL),
segs AS (SELECT *, CASE WHEN segment_id = -1 THEN '정보 부족형' ELSE 'seg' || segment_id END AS segment_key,
  n * 100.0::DOUBLE / sum(n) FILTER (segment_id <> -1) OVER (PARTITION BY {CELLS}) AS pct_cell FROM seg)"""


@query(
    "segment_rows",
    f"""WITH {SEGMENTS} SELECT {CELLS}, segment_id, segment_key, n, round(pct_cell, 1) AS pct_cell, round(purpose_top, 3) AS purpose_top, round(place_top, 3) AS place_top
        FROM segs WHERE segment_id <> -1""",
    ASSIGNED,
)
def segment_rows(spark, sf):
    return S.segment_rows(V.assigned(spark, sf), 3).select(*CELL, "segment_id", "segment_key", "n", "pct_cell", "purpose_top", "place_top")


METRICS = """m AS (SELECT count(*) FILTER (segment_id <> -1) AS n_segments, CAST(sum(n) FILTER (segment_id = -1) AS BIGINT) AS n_poor, count(*) FILTER (segment_id <> -1 AND n < 30) AS n_micro,
  (SELECT count(*) FROM (SELECT job_type, payment_group, max(round(pct_cell, 1)) AS x FROM segs WHERE segment_id <> -1 GROUP BY ALL)
    WHERE x > 40 AND job_type || '_' || payment_group IN ('model_n2','beauty_n2','photo_n2','model_pay')) AS catch_all_cells,
  max(n) FILTER (segment_id <> -1 AND job_type = 'model' AND payment_group = 'n2') AS focus_max,
  count(*) FILTER (segment_id <> -1 AND job_type = 'model' AND payment_group = 'n2') AS focus_segments,
  round(max(n) FILTER (segment_id <> -1 AND job_type = 'model' AND payment_group = 'n2') * 100.0::DOUBLE / sum(n) FILTER (segment_id <> -1 AND job_type = 'model' AND payment_group = 'n2'), 1) AS focus_max_pct
  FROM segs)"""


@query("catalogue_metrics", f"WITH {SEGMENTS}, {METRICS} SELECT * FROM m", ASSIGNED)
def catalogue_metrics(spark, sf):
    return S.catalogue_metrics(S.segment_table(V.assigned(spark, sf)))


@query(
    "catalogue_metrics_fixed_total",
    f"WITH {SEGMENTS}, {METRICS} SELECT n_segments, focus_max, round(focus_max * 100.0::DOUBLE / 4908, 1) AS focus_max_pct FROM m",
    ASSIGNED,
)
def catalogue_metrics_fixed_total(spark, sf):
    out = S.catalogue_metrics(S.segment_table(V.assigned(spark, sf)), focus_total=4908)
    return out.select("n_segments", "focus_max", "focus_max_pct")


@query(
    "cell_summary",
    f"""WITH t AS (SELECT {CELLS}, segment_id, count(*) AS n FROM v_assigned GROUP BY ALL)
        SELECT {CELLS}, CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(n) FILTER (segment_id = -1) AS BIGINT) AS n_poor, count(*) FILTER (segment_id <> -1) AS n_raw, count(*) FILTER (segment_id <> -1) AS n_segments,
        min(n) FILTER (segment_id <> -1) AS min_size, quantile_cont(n, 0.5) FILTER (segment_id <> -1) AS median_size, max(n) FILTER (segment_id <> -1) AS max_size, CAST(count(*) FILTER (segment_id <> -1) = 1 AS INT) AS single_segment
        FROM t GROUP BY ALL""",
    ASSIGNED,
)
def cell_summary(spark, sf):
    return S.cell_summary(V.assigned(spark, sf)).withColumn("single_segment", F.col("single_segment").cast("int"))


def purity_sql(by):
    return f"""SELECT round(sum(p * n) / sum(n), 6) AS purity, count(*) AS n_segments FROM (SELECT {by}, max(total) AS n, sum(n / total) / 4 AS p
      FROM ({top_sql('(SELECT * FROM v_assigned WHERE segment_id <> -1)', by, DENSITY_AXES)}) GROUP BY {by})"""


@query("purity", purity_sql(CELLS + ", segment_id"), ASSIGNED)
def purity(spark, sf):
    return rounded(S.purity(V.assigned(spark, sf)), "purity")


@query("pooled_purity", purity_sql("segment_id"), ASSIGNED)
def pooled_purity(spark, sf):
    return rounded(S.purity(V.assigned(spark, sf), by=["segment_id"]), "purity")


@query(
    "assignment_stats",
    """SELECT v AS version, count(*) AS n_rows, count(segment_id) AS n_assigned, count(*) FILTER (segment_id = -1) AS n_poor, count(*) FILTER (segment_id IS NULL) AS n_unassigned,
       round(coalesce(avg(conf), 0), 4) AS avg_confidence FROM (SELECT CASE WHEN l.doc_id IS NULL THEN '미배정(NULL version)' ELSE 'v2.1-tune' END AS v,
       CASE WHEN l.doc_id % 5 = 0 THEN -1 ELSE quality END AS segment_id, CASE WHEN l.doc_id IS NOT NULL THEN (p.id % 64) / 64.0::DOUBLE END AS conf
       FROM v_postings p LEFT JOIN labels l ON p.id = l.doc_id WHERE is_deleted = 0 AND is_expired = 0) GROUP BY GROUPING SETS ((v), ())""",
    POSTS,
)
def assignment_stats(spark, sf):
    return rounded(S.assignment_stats(assigned_postings(spark, sf)), "avg_confidence", digits=4)


def assigned_postings(spark, sf):
    """Postings of which the labelled ones carry a segment."""
    from segloom.sources.sinks import merge_assignments

    key = F.col("doc_id")
    updates = V.table(spark, sf, "labels").select(
        key.alias("id"),
        F.when(key % 5 == 0, -1).otherwise(F.col("quality")).alias("segment_id"),
        F.lit(VERSION).alias("segment_version"),
        ((key % 64) / 64.0).alias("segment_confidence"),
    )
    return merge_assignments(V.postings(spark, sf), updates)


DOMAIN = {"place": ["A", "R", "Z", M], "career": [M, "senior", "any"]}


def _domain_sql():
    rows = [f"('{a}', '{v}', {i})" for a, values in DOMAIN.items() for i, v in enumerate(values)]
    return f"(VALUES {', '.join(rows)}) AS d(axis, value, ord)"


@query(
    "cluster_profiles",
    f"""WITH c AS ({long_sql('v_labeled', 'raw_cluster_id', DOMAIN)}), s AS (SELECT raw_cluster_id, count(*) AS size FROM v_labeled GROUP BY 1)
        SELECT s.raw_cluster_id, size, d.axis, d.value, coalesce(n, 0) AS n, round(coalesce(n, 0) / size, 6) AS share,
        CAST(row_number() OVER (PARTITION BY s.raw_cluster_id, d.axis ORDER BY round(coalesce(n, 0) / size, 6) DESC, ord) = 1 AS INT) AS is_dominant
        FROM s CROSS JOIN {_domain_sql()} LEFT JOIN c ON c.raw_cluster_id = s.raw_cluster_id AND c.axis = d.axis AND c.value = d.value""",
    LABELED,
)
def cluster_profiles(spark, sf):
    out = S.cluster_profiles(V.labeled(spark, sf), "raw_cluster_id", DOMAIN)
    return out.select("raw_cluster_id", "size", "axis", "value", "n", "share", F.col("is_dominant").cast("int").alias("is_dominant"))


@query(
    "profile_documents",
    f"""WITH c AS ({long_sql('v_labeled', 'raw_cluster_id', DOMAIN)}) SELECT raw_cluster_id, sum(n) FILTER (axis = 'career')::BIGINT AS size,
        round(coalesce(sum(n) FILTER (value = 'senior'), 0) / sum(n) FILTER (axis = 'career'), 6) AS senior_share,
        arg_max(value, n) FILTER (axis = 'career') AS career
        FROM c GROUP BY 1""",
    LABELED,
)
def profile_documents(spark, sf):
    docs = S.profile_documents(S.cluster_profiles(V.labeled(spark, sf), "raw_cluster_id", DOMAIN), ["raw_cluster_id"])
    return docs.select(
        "raw_cluster_id", "size", F.col("attributes")["career"]["senior"].alias("senior_share"), F.col("dominant_values")["career"].alias("career")
    )


CATS = ("v_categories", "v_posting_categories")


@query(
    "category_top",
    """WITH o AS (SELECT o_orderkey, o_orderpriority AS seg FROM orders), t AS (SELECT seg, count(*) AS n_rows FROM o GROUP BY 1)
       SELECT seg, name AS category, count(*) AS n, n_rows, round(count(*) * 100.0::DOUBLE / n_rows, 6) AS pct,
       CAST(row_number() OVER (PARTITION BY seg ORDER BY count(*) DESC, name) AS INT) AS rank
       FROM o JOIN v_posting_categories ON job_posting_id = o_orderkey JOIN v_categories USING (category_id) JOIN t USING (seg) GROUP BY seg, name, n_rows QUALIFY rank <= 3""",
    CATS,
)
def category_top(spark, sf):
    from segloom.operators.joins import attach_categories

    orders = V.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("seg"))
    rows = attach_categories(orders, V.posting_categories(spark, sf), V.categories(spark, sf), distinct_pairs=True)
    return rounded(S.category_top(rows, ["seg"], 3), "pct")


LABEL_SQL = f"""WITH c AS (SELECT *, n / sum(n) OVER (PARTITION BY {CELLS}, raw_cluster_id, axis) AS share FROM ({long_sql('v_labeled', CELLS + ', raw_cluster_id', KEY_AXES)})),
 b AS (SELECT * FROM c WHERE value <> '{M}' QUALIFY row_number() OVER (PARTITION BY {CELLS}, raw_cluster_id, axis ORDER BY n DESC, value) = 1),
 p AS (SELECT *, list_position([{', '.join(f"'{a}'" for a in KEY_AXES)}], axis) AS pos FROM b WHERE share >= 0.25),
 v AS (SELECT {CELLS}, raw_cluster_id, value, min(pos) AS pos FROM p GROUP BY ALL),
 u AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY {CELLS}, raw_cluster_id ORDER BY pos) <= 3)
SELECT DISTINCT l.job_type, l.payment_group, l.raw_cluster_id, coalesce(label, '(속성 혼재·불명확 다수)') AS label FROM v_labeled l
 LEFT JOIN (SELECT {CELLS}, raw_cluster_id, string_agg(value, ' · ' ORDER BY pos) AS label FROM u GROUP BY ALL) x USING (job_type, payment_group, raw_cluster_id)"""


@query("suggested_labels", LABEL_SQL, LABELED)
def suggested_labels(spark, sf):
    return S.suggest_label(V.labeled(spark, sf), [*CELL, "raw_cluster_id"])


MOVED_KEY = "CASE WHEN raw_cluster_id = -1 THEN -1 ELSE raw_cluster_id // 2 END"


@query(
    "segment_sources",
    f"""SELECT {CELLS}, segment_id, min(k) AS segment_key, CAST(sum(n) AS BIGINT) AS n, string_agg(raw_cluster_id || ':' || n, ',' ORDER BY raw_cluster_id) AS sources
        FROM (SELECT {CELLS}, {MOVED_KEY} AS segment_id, 'm' || {MOVED_KEY} AS k, raw_cluster_id, count(*) AS n FROM v_labeled WHERE raw_cluster_id <> -1 GROUP BY ALL) GROUP BY {CELLS}, segment_id""",
    LABELED,
)
def segment_sources(spark, sf):
    raw = F.col("raw_cluster_id")
    merged = F.when(raw == -1, -1).otherwise(F.floor(raw / 2).cast("int"))
    rows = V.labeled(spark, sf).withColumns({"segment_id": merged, "segment_key": F.concat(F.lit("m"), merged.cast("string"))})
    out = S.segment_sources(rows)
    return out.withColumn("sources", F.array_join(F.transform("sources", lambda s: F.concat_ws(":", s["cluster"], s["n"])), ","))


@query(
    "text_quality",
    """SELECT lang AS job_type, count(*) AS n_rows, count(*) FILTER (length(t) = 0) AS n_empty, CAST(max(length(t)) AS INT) AS max_chars
       FROM (SELECT lang, CASE WHEN id % 10 = 0 THEN '' ELSE content END AS t FROM v_postings) GROUP BY 1""",
    POSTS,
)
def text_quality(spark, sf):
    rows = V.postings(spark, sf).select(F.col("lang").alias("job_type"), F.when(F.col("id") % 10 != 0, F.col("content")).alias("text"))
    return S.text_quality(rows)
