"""Predicates, projections, text, JSON and array functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from segloom.config import DENSITY_AXES, HYBRID, JOB_TYPES, MISSING
from segloom.functions import columns as C
from segloom.functions import text as X
from segloom.operators.ranking import renumber
from segloom.operators.typed import typed_padding
from segloom.plans import views as V
from segloom.plans.registry import query

POSTS = ("v_postings",)
M = MISSING


def sql_missing(a):
    return f"({a} IS NULL OR trim({a}) = '{M}')"


@query("active_postings", "SELECT id, job_type, payment FROM v_postings WHERE is_deleted = 0 AND is_expired = 0", POSTS)
def active_postings(spark, sf):
    return V.postings(spark, sf).filter(C.active()).select("id", "job_type", "payment")


@query(
    "eligible_postings",
    """SELECT id, title, content, job_type, payment FROM v_postings WHERE is_deleted = 0 AND is_expired = 0
       AND created_at >= DATE '2025-07-01' AND content IS NOT NULL AND length(trim(content)) > 10""",
    POSTS,
)
def eligible_postings(spark, sf):
    rows = V.postings(spark, sf)
    return rows.filter(C.eligible("2025-07-01")).select("id", "title", "content", "job_type", "payment")


@query(
    "payment_groups",
    "SELECT id, CASE coalesce(payment, 0) WHEN -2 THEN 'n2' WHEN -3 THEN 'n3' ELSE 'pay' END AS payment_group FROM v_postings",
    POSTS,
)
def payment_groups(spark, sf):
    return V.postings(spark, sf).select("id", C.payment_group("payment").alias("payment_group"))


@query(
    "job_types",
    """SELECT id, CASE WHEN lower(trim(job_type)) IN ('model','beauty','photo') THEN lower(trim(job_type)) ELSE '' END AS job_type,
       CASE WHEN lower(trim(job_type)) IN ('model','beauty','photo') THEN 'ok' ELSE 'invalid_recruit_type' END AS status FROM v_postings""",
    POSTS,
)
def job_types(spark, sf):
    return V.postings(spark, sf).select("id", C.job_type_norm("job_type").alias("job_type"), C.job_type_status("job_type").alias("status"))


FLAT = r"regexp_extract(raw_text, '\{[^{}]*\}')"
PARSED = f"CASE WHEN {FLAT} <> '' AND json_valid({FLAT}) THEN {FLAT} END"


@query(
    "ok_rows",
    f"""SELECT id, id % 3 AS kind, CAST(id % 3 = 0 OR id % 3 = 1 AND obj IS NOT NULL AS INT) AS kept_when_absent_is_true,
        CAST(id % 3 <> 0 AND obj IS NOT NULL AND id % 3 = 1 AS INT) AS kept_when_absent_is_false FROM (SELECT id, {PARSED} AS obj FROM v_responses)""",
    ("v_responses",),
)
def ok_rows(spark, sf):
    # a third of the rows lacks the flag, a third has false, the rest tells whether the response parses
    parsed = X.extract_json_object("raw_text").isNotNull()
    kind = F.col("id") % 3
    rows = V.responses(spark, sf).select("id", kind.alias("kind"), F.when(kind == 1, parsed).when(kind == 2, False).alias("ok"))
    return rows.select(
        "id", "kind", C.is_ok("ok", True).cast("int").alias("kept_when_absent_is_true"), C.is_ok("ok", False).cast("int").alias("kept_when_absent_is_false")
    )


@query(
    "posting_kind",
    f"""SELECT id, CAST(json_extract_string(obj, '$.k') AS INT) AS k FROM (SELECT id, {PARSED} AS obj FROM v_responses)
        WHERE obj IS NOT NULL AND CAST(json_extract_string(obj, '$.k') AS INT) % 2 = 0""",
    ("v_responses",),
)
def posting_kind(spark, sf):
    result = F.from_json(X.extract_json_object("raw_text"), "k int")
    rows = V.responses(spark, sf).select("id", F.struct(F.when(result["k"] % 2 == 0, X.POST_KIND).otherwise(X.APPLY_KIND).alias("kind"), result["k"].alias("k")).alias("llm_result"))
    return rows.filter((F.col("llm_result.kind") == X.POST_KIND) & F.col("llm_result.k").isNotNull()).select("id", "llm_result.k")


@query("attribute_columns", f"SELECT posting_id, place, purpose, '{M}' AS topic FROM v_lines", ("v_lines",))
def attribute_columns(spark, sf):
    attrs = F.map_filter(
        F.create_map(F.lit("장소"), F.col("place"), F.lit("목적"), F.col("purpose")), lambda _, v: v != MISSING
    ).alias("attributes")
    rows = V.lines(spark, sf).select("posting_id", attrs)
    return rows.select("posting_id", *C.attrs_to_columns("attributes", {"place": "장소", "purpose": "목적", "topic": "주제"}))


@query(
    "explicit_flags",
    f"SELECT posting_id, CAST({sql_missing('place')} AS INT) AS place_missing, CAST(NOT {sql_missing('topic')} AS INT) AS topic_explicit FROM v_lines",
    ("v_lines",),
)
def explicit_flags(spark, sf):
    return V.lines(spark, sf).select(
        "posting_id", C.is_missing("place").cast("int").alias("place_missing"), C.is_explicit("topic").cast("int").alias("topic_explicit")
    )


DENSITY_SQL = " + ".join(f"CASE WHEN {sql_missing(a)} THEN 0 ELSE 1 END" for a in DENSITY_AXES)


@query("info_density", f"SELECT posting_id, {DENSITY_SQL} AS info_density FROM v_lines", ("v_lines",))
def info_density(spark, sf):
    return V.lines(spark, sf).select("posting_id", C.info_density().alias("info_density"))


@query(
    "density_labels",
    f"""SELECT posting_id, CASE WHEN s <= 1 THEN '정보 부족형' WHEN s <= 3 THEN '부분 정보형' ELSE '충분 정보형' END AS wide_label,
        CASE WHEN s < 1 THEN '정보 부족형' WHEN s <= 3 THEN '부분 정보형' ELSE '충분 정보형' END AS label
        FROM (SELECT posting_id, {DENSITY_SQL} AS s FROM v_lines)""",
    ("v_lines",),
)
def density_labels(spark, sf):
    rows = V.lines(spark, sf).withColumn("s", C.info_density())
    return rows.select("posting_id", C.density_label("s").alias("wide_label"), C.density_label("s", 0).alias("label"))


@query(
    "split_info_poor",
    f"""SELECT posting_id, CASE WHEN {DENSITY_SQL} < 1 THEN -1 END AS segment_id, CASE WHEN {DENSITY_SQL} < 1 THEN '정보 부족형' END AS segment_key
        FROM v_cells""",
    ("v_cells",),
)
def split_info_poor(spark, sf):
    rows = V.cells(spark, sf).withColumn("poor", C.info_density() < 1)
    return rows.select("posting_id", F.when(F.col("poor"), -1).alias("segment_id"), F.when(F.col("poor"), "정보 부족형").alias("segment_key"))


K_DOMAIN = tuple(str(k) for k in range(0, 100, 3))
K_SQL = ",".join(f"'{k}'" for k in K_DOMAIN)
K_OF = f"SELECT id, json_extract_string({PARSED}, '$.k') AS k FROM v_responses"


def k_map(spark, sf):
    return V.responses(spark, sf).select("id", F.from_json(X.extract_json_object("raw_text"), "map<string,string>").alias("attrs"))


@query("normalized_values", f"SELECT id, CASE WHEN k IN ({K_SQL}) THEN k ELSE '{M}' END AS k, '{M}' AS other FROM ({K_OF})", ("v_responses",))
def normalized_values(spark, sf):
    rows = k_map(spark, sf).select("id", C.normalize_map("attrs", {"k": K_DOMAIN, "other": ("x",)}).alias("a"))
    return rows.select("id", F.col("a")["k"].alias("k"), F.col("a")["other"].alias("other"))


@query(
    "normalized_fallback",
    f"SELECT id, CASE WHEN k IN ({K_SQL}) THEN k ELSE '{K_DOMAIN[-1]}' END AS last_value, CASE WHEN k IN ({K_SQL}) THEN k ELSE '{M}' END AS sentinel FROM ({K_OF})",
    ("v_responses",),
)
def normalized_fallback(spark, sf):
    k = F.try_element_at("attrs", F.lit("k"))
    padded = F.concat(F.lit(" "), k, F.lit("　"))
    return k_map(spark, sf).select(
        "id", C.in_domain_or_last(padded, list(K_DOMAIN)).alias("last_value"), C.in_domain_or_last(padded, [*K_DOMAIN, MISSING]).alias("sentinel")
    )


@query(
    "validated_records",
    f"SELECT id, CAST(coalesce(k IN ({K_SQL}), FALSE) AS INT) AS ok, CASE WHEN k IN ({K_SQL}) THEN k END AS k FROM ({K_OF})",
    ("v_responses",),
)
def validated_records(spark, sf):
    domain = {"k": K_DOMAIN}
    rows = k_map(spark, sf)
    return rows.select("id", C.record_is_valid("attrs", domain).cast("int").alias("ok"), F.try_element_at(C.validated("attrs", domain), F.lit("k")).alias("k"))


@query(
    "typed_padding",
    f"""SELECT posting_id, place, CASE WHEN job_type IN ('model','photo') THEN topic ELSE '__해당없음__' END AS topic,
        CASE WHEN job_type = 'beauty' THEN treatment ELSE '__해당없음__' END AS treatment FROM v_cells""",
    ("v_cells",),
)
def typed_padding_query(spark, sf):
    defined = {"place": JOB_TYPES, "topic": ("model", "photo"), "treatment": ("beauty",)}
    return typed_padding(V.cells(spark, sf), defined).select("posting_id", "place", "topic", "treatment")


@query(
    "renumbered",
    """SELECT posting_id, CASE WHEN old = -1 THEN -1 ELSE CAST(dense_rank() OVER (PARTITION BY job_type, payment_group, old = -1 ORDER BY old) - 1 AS INT) END AS segment_id
       FROM (SELECT *, CASE WHEN raw_cluster_id = -1 THEN -1 ELSE raw_cluster_id * 7 + 3 END AS old FROM v_labeled)""",
    ("v_labeled",),
)
def renumbered(spark, sf):
    raw = F.col("raw_cluster_id")
    rows = V.labeled(spark, sf).withColumn("segment_id", F.when(raw == -1, -1).otherwise(raw * 7 + 3))
    return renumber(rows).select("posting_id", "segment_id")


# --- text ---------------------------------------------------------------------

WS = r"[\s\x0b]+"


@query("collapsed_text", f"SELECT id, trim(regexp_replace(coalesce(content, ''), '{WS}', ' ', 'g')) AS text FROM v_postings", POSTS)
def collapsed_text(spark, sf):
    return V.postings(spark, sf).select("id", X.collapse_ws("content").alias("text"))


BOTH_SQL = f"concat_ws(' ', nullif(trim(regexp_replace(title, '{WS}', ' ', 'g')), ''), nullif(trim(regexp_replace(content, '{WS}', ' ', 'g')), ''))"


@query("training_text", f"SELECT id, {BOTH_SQL} AS text, substr({BOTH_SQL}, 1, 512) AS model_input FROM v_postings", POSTS)
def training_text(spark, sf):
    return V.postings(spark, sf).select(
        "id", X.training_text("title", "content").alias("text"), X.training_text("title", "content", 512).alias("model_input")
    )


@query(
    "text_previews",
    f"""SELECT id, CASE WHEN length(t) > 100 THEN substr(t, 1, 100) || '...' ELSE t END AS preview
        FROM (SELECT id, trim(regexp_replace(content, '{WS}', ' ', 'g')) AS t FROM v_postings)""",
    POSTS,
)
def text_previews(spark, sf):
    return V.postings(spark, sf).select("id", X.preview("content", 100).alias("preview"))


MARKS = ("야외", "스튜디오", "레이어드컷", "After", "신부")


@query(
    "any_marker",
    "SELECT id, CAST(" + " OR ".join(f"contains(txt, '{m}')" for m in MARKS) + " AS INT) AS found FROM v_rule_text",
    ("v_rule_text",),
)
def any_marker(spark, sf):
    return V.rule_text(spark, sf).select("id", X.any_marker(X.full_text("title", "content"), MARKS).cast("int").alias("found"))


LONGEST = sorted(MARKS + ("컷", "염색", "촬영", "스튜"), key=len, reverse=True)


@query(
    "markers_found",
    "SELECT id, CASE WHEN len(f) = 0 THEN '-' ELSE array_to_string(f[1:4], ', ') END AS markers FROM (SELECT id, list_filter(["
    + ", ".join(f"'{m}'" for m in LONGEST)
    + "], lambda m: contains(txt, m)) AS f FROM v_rule_text)",
    ("v_rule_text",),
)
def markers_found(spark, sf):
    marks = MARKS + ("컷", "염색", "촬영", "스튜")
    return V.rule_text(spark, sf).select("id", X.markers_found(X.full_text("title", "content"), marks).alias("markers"))


@query(
    "regex_rules",
    r"""SELECT id, CAST(regexp_matches(txt, '(?i)before\s*after') AS INT) AS before_after, CAST(regexp_matches(txt, '(?i)실내\s*촬영|야외\s*촬영') AS INT) AS shoot,
        CAST(regexp_matches(txt, '(?i)(^|[^\p{L}\p{M}\p{N}_])the($|[^\p{L}\p{M}\p{N}_])') AS INT) AS the_word FROM v_rule_text""",
    ("v_rule_text",),
)
def regex_rules(spark, sf):
    text = X.full_text("title", "content")
    return V.rule_text(spark, sf).select(
        "id",
        X.matches(text, r"before\s*after").cast("int").alias("before_after"),
        X.matches(text, r"실내\s*촬영|야외\s*촬영").cast("int").alias("shoot"),
        X.matches(text, r"\bthe\b").cast("int").alias("the_word"),
    )


@query(
    "script_flags",
    "SELECT id, CAST(regexp_matches(content, '[가-힣]') AS INT) AS hangul, CAST(regexp_matches(content, '[\\x{4E00}-\\x{9FFF}\\x{3400}-\\x{4DBF}\\x{F900}-\\x{FAFF}]') AS INT) AS cjk FROM (SELECT id, txt AS content FROM v_rule_text)",
    ("v_rule_text",),
)
def script_flags(spark, sf):
    text = X.full_text("title", "content")
    return V.rule_text(spark, sf).select("id", X.has_hangul(text).cast("int").alias("hangul"), X.has_cjk(text).cast("int").alias("cjk"))


# Every response as it is, and in shapes that it may have besides; the first object's last `k` counts.
SHAPES = (
    "raw_text",
    "concat('{\"k\": 0, \"k\": ', v, '}')",
    "concat('{\"a\": NaN, \"k\": ', v, ', \"b\": -Infinity}')",
    "concat('x {bad} {\"n\": {\"m\": [1, {\"k\": -1}]}, \"k\": ', v, '} {\"k\": -2}')",
    "concat('```JSON', chr(10), '{\"k\": ', v, ', \"t\": \"}{\"}', chr(10), '``` {\"k\": -3}')",
    "concat('[1, 2, ', v, ']')",
    "concat('{\"k\": ', v)",
    "''",
)


@query(
    "json_objects",
    f"""SELECT id, shape, CASE shape WHEN 0 THEN json_extract_string({PARSED}, '$.k') WHEN 1 THEN v WHEN 2 THEN v WHEN 3 THEN v WHEN 4 THEN v END AS k
        FROM (SELECT id, raw_text, regexp_extract(raw_text, '[0-9]+') AS v FROM v_responses), (SELECT CAST(unnest(range({len(SHAPES)})) AS INT) AS shape)""",
    ("v_responses",),
)
def json_objects(spark, sf):
    rows = V.responses(spark, sf).withColumn("v", F.regexp_extract("raw_text", "[0-9]+", 0))
    rows = rows.select("id", F.posexplode(F.array(*[F.expr(text) for text in SHAPES])).alias("shape", "text"))
    return rows.select("id", "shape", F.get_json_object(X.extract_json_object("text"), "$.k").alias("k"))


@query(
    "repaired_tails",
    r"""SELECT id, regexp_replace(trim(t), '\]\]\s*$', ']}') AS text FROM (
        SELECT id, '{"a": [' || raw_text || CASE WHEN id % 2 = 0 THEN ']] ' ELSE ']}' END AS t FROM v_responses)""",
    ("v_responses",),
)
def repaired_tails(spark, sf):
    tail = F.when(F.col("id") % 2 == 0, "]] ").otherwise("]}")
    text = F.concat(F.lit('{"a": ['), F.col("raw_text"), tail)
    return V.responses(spark, sf).select("id", X.repair_tail(text).alias("text"))


KINDS = ("구인글", " 구 인 ", "모집", "촬영구인", "지원글", "지원", "기타글", "지원글구인")
DOMS = ("헤어", "메이크업샵", " 스nap ", "뷰티", "인물 스냅")


def _case(expr, values):
    return f"CASE {expr} " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


@query(
    "normalized_phase1",
    f"""WITH src AS (SELECT id, {_case('id % 8', KINDS)} AS kind, {_case('id % 5', DOMS)} AS dom, regexp_replace(raw_text, '[:{{}}]', ',', 'g') AS kw FROM v_responses),
        known AS (SELECT id, dom, kw, regexp_replace(kind, '\\s+', '', 'g') AS s FROM src),
        named AS (SELECT id, kw, CASE WHEN s IN ('구인글','구인','모집','리크루트') OR (s LIKE '%구인' AND NOT contains(s, '지원글')) THEN '구인글'
            WHEN s IN ('지원글','지원') THEN '지원글' END AS kind,
            CASE WHEN trim(dom) IN ('헤어','메이크업','스냅','기타') THEN trim(dom) WHEN contains(dom, '스') AND contains(lower(dom), 'nap') THEN '스냅'
            WHEN contains(dom, '헤어') THEN '헤어' WHEN contains(dom, '메이크업') THEN '메이크업' WHEN contains(dom, '스냅') THEN '스냅' ELSE '기타' END AS domain FROM known)
        SELECT id, kind, CASE WHEN kind IS NOT NULL THEN domain END AS domain,
        CASE WHEN kind = '지원글' THEN '' WHEN kind = '구인글' THEN array_to_string((list_filter(list_transform(string_split_regex(kw, '[,，]'),
          lambda w: trim(w, ' ' || chr(9) || chr(10) || chr(13))), lambda w: w <> ''))[1:5], '|') END AS keywords FROM named""",
    ("v_responses",),
)
def normalized_phase1(spark, sf):
    def pick(n, values):
        out = F.lit(None).cast("string")
        for i, v in enumerate(values):
            out = F.when(F.col("id") % n == i, v).otherwise(out)
        return out

    words = F.split(F.regexp_replace("raw_text", "[:{}]", ","), "[,，]")
    rows = V.responses(spark, sf).select("id", X.normalize_phase1(pick(8, KINDS), pick(5, DOMS), words).alias("r"))
    return rows.select("id", "r.kind", "r.domain", F.array_join("r.keywords", "|").alias("keywords"))


@query(
    "keyword_occurrences",
    r"""SELECT id, lang, keyword FROM (SELECT id, lang, trim(unnest(string_split_regex(title, '[\s\x0b]+'))) AS keyword FROM v_postings) WHERE keyword <> ''""",
    POSTS,
)
def keyword_occurrences(spark, sf):
    from segloom.operators.signals import explode_keywords

    rows = V.postings(spark, sf).select("id", "lang", F.split("title", X.WHITE_SPACE).alias("keywords"))
    return explode_keywords(rows, ["id", "lang"])


def _name_sql(parts, skip):
    listed = ", ".join(parts)
    skipped = ", ".join(f"'{s}'" for s in skip)
    return f"array_to_string(list_filter([{listed}], lambda p: p NOT IN ({skipped})), '·')"


PLAIN = _name_sql(("purpose", "place", "topic"), (MISSING, HYBRID, ""))
KEPT = _name_sql(("purpose", "topic"), (MISSING, ""))


@query(
    "segment_names",
    f"""SELECT posting_id, CASE WHEN {PLAIN} = '' THEN '기타' ELSE {PLAIN} END AS name,
        CASE WHEN {KEPT} = '' THEN '장소미기재' ELSE {KEPT} || '·장소미기재' END AS no_place
        FROM (SELECT posting_id, place, topic, CASE WHEN purpose = 'SMALL' THEN '{HYBRID}' ELSE purpose END AS purpose FROM v_lines)""",
    ("v_lines",),
)
def segment_names(spark, sf):
    rows = V.lines(spark, sf).withColumn("purpose", F.when(F.col("purpose") == "SMALL", HYBRID).otherwise(F.col("purpose")))
    return rows.select(
        "posting_id", X.display_name(["purpose", "place", "topic"]).alias("name"),
        X.display_name(["purpose", "topic"], keep_hybrid=True, place_missing=True).alias("no_place"),
    )


@query(
    "ordered_names",
    f"""SELECT posting_id, CASE WHEN n = '' THEN '미분류' ELSE n END AS name FROM (SELECT posting_id, array_to_string(list_filter([
        CASE WHEN topic <> '{M}' THEN topic END, CASE WHEN place <> '{M}' THEN place END], lambda p: p IS NOT NULL), ' - ') AS n FROM v_lines)""",
    ("v_lines",),
)
def ordered_names(spark, sf):
    values = F.map_filter(F.create_map(F.lit("place"), F.col("place"), F.lit("topic"), F.col("topic")), lambda _, v: v != MISSING)
    return V.lines(spark, sf).select("posting_id", X.ordered_name(values, ["topic", "absent", "place"]).alias("name"))


KEY_SQL = f"concat(CASE WHEN purpose = 'SMALL' THEN '{HYBRID}' ELSE purpose END, '·', CASE WHEN place = 'A' THEN '{HYBRID}' ELSE place END, '·', topic)"


@query(
    "hybrid_keys",
    f"""SELECT posting_id, CAST(purpose = 'SMALL' AND place = 'A' AS INT) AS both_hybrid, CAST(contains({KEY_SQL}, '{M}') AS INT) AS mentions_missing FROM v_lines""",
    ("v_lines",),
)
def hybrid_keys(spark, sf):
    purpose = F.when(F.col("purpose") == "SMALL", HYBRID).otherwise(F.col("purpose"))
    place = F.when(F.col("place") == "A", HYBRID).otherwise(F.col("place"))
    rows = V.lines(spark, sf).select("posting_id", F.concat_ws("·", purpose, place, "topic").alias("key"))
    return rows.select("posting_id", X.is_hybrid_key("key").cast("int").alias("both_hybrid"), X.mentions_missing("key").cast("int").alias("mentions_missing"))


@query("trimmed_evidence", "SELECT id, substr(title, 1, 200) AS title, substr(content, 1, 200) AS content FROM v_postings", POSTS)
def trimmed_evidence(spark, sf):
    evidence = F.create_map(F.lit("title"), F.col("title"), F.lit("content"), F.col("content"))
    rows = V.postings(spark, sf).select("id", X.trim_evidence(evidence).alias("e"))
    return rows.select("id", F.col("e")["title"].alias("title"), F.col("e")["content"].alias("content"))


