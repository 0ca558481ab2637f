"""Rule corrections."""

from __future__ import annotations

from pyspark.sql import functions as F

from segloom.config import MISSING
from segloom.functions import text as X
from segloom.operators import rules as R
from segloom.operators import stats as S
from segloom.plans import views as V
from segloom.plans.registry import query

VIEW = ("v_rule_text",)
M = MISSING


def _any(words):
    return "(" + " OR ".join(f"contains(txt, '{w}')" for w in words) + ")"


def _cat(names):
    return "list_has_any(cats, [" + ", ".join(f"'{n}'" for n in names) + "])"


def _re(pattern, flags="(?i)"):
    # word boundaries only know ASCII letters here; the alternative with them never decides a row
    return f"regexp_matches(txt, '{flags}{pattern.replace('|' + chr(92) + 'b스튜' + chr(92) + 'b', '')}')"


GUARD = f"CASE WHEN treatment = '펌' AND NOT {_any(R.PERM_EVIDENCE)} THEN '{M}' ELSE treatment END"
HAIR_FIT = f"(treatment = '{M}' AND {_cat(['헤어'])})"
HAIR = f"CASE WHEN {HAIR_FIT} AND NOT {_any(R.TREATMENT_MARKERS)} THEN '{R.GENERIC_HAIR}' ELSE treatment END"
SNAP_IN = _re(R.SNAP_TEXT)
HIGH = _cat(R.SNAP_CATEGORIES)
PORTRAIT = _cat([R.PORTRAIT_CATEGORY])
VETO = f"({_cat(R.TOPIC_CONFLICT_CATEGORIES)} OR {_re(R.TOPIC_CONFLICT_TEXT, '')} OR ({_cat(['프로필'])} AND NOT {SNAP_IN} AND NOT {HIGH} AND NOT {PORTRAIT}))"
ALLOWED = {
    "full": "TRUE",
    "tier1_only": "FALSE",
    "tier2_body_snap": SNAP_IN,
    "tier2_conditional": f"({SNAP_IN} OR {_re(R.PORTFOLIO_TEXT)})",
}


def snap_sql(tier):
    return f"CASE WHEN topic <> '{M}' OR {VETO} THEN topic WHEN {HIGH} OR {SNAP_IN} OR ({PORTRAIT} AND {ALLOWED[tier]}) THEN '스냅' ELSE topic END"


PURPOSE = f"""CASE WHEN purpose <> '{M}' THEN purpose WHEN {_re(R.BEFORE_AFTER_TEXT)} THEN '비포애프터'
 WHEN {_cat(['프로필'])} OR {_re(R.PROFILE_TEXT)} THEN '프로필·증명사진' WHEN {_cat(R.BEAUTY_CATEGORIES)} OR {_re(R.BEAUTY_TEXT)} THEN '뷰티·메이크업'
 WHEN {_cat(R.FASHION_CATEGORIES)} OR {_re(R.FASHION_TEXT)} THEN '패션·룩북·화보' WHEN {_re(R.PORTFOLIO_TEXT)} THEN '포트폴리오' ELSE purpose END"""
STUDIO = f"({_cat(['스튜디오'])} OR {_re(R.STUDIO_TEXT)})"
PLACE = f"""CASE WHEN place <> '{M}' OR ({STUDIO} AND {_re(R.OUTDOOR_TEXT)}) OR ({_re(R.HOME_TEXT)} AND ({STUDIO} OR {_re(R.OUTDOOR_TEXT)})) THEN place
 WHEN {_cat(['스튜디오'])} THEN '스튜디오' WHEN {_re(R.OUTDOOR_TEXT)} THEN '야외' WHEN {_re(R.HOME_TEXT)} THEN '홈스냅' WHEN {_re(R.STUDIO_TEXT)} THEN '스튜디오' ELSE place END"""


def text_rows(spark, sf):
    return V.rule_text(spark, sf).withColumn("txt", X.full_text("title", "content"))


@query("guarded_values", f"SELECT id, {GUARD} AS treatment FROM v_rule_text", VIEW)
def guarded_values(spark, sf):
    return text_rows(spark, sf).select("id", R.guard_unsupported(F.col("treatment"), F.col("txt")).alias("treatment"))


@query("generic_hair", f"SELECT id, {HAIR} AS treatment FROM v_rule_text", VIEW)
def generic_hair(spark, sf):
    return text_rows(spark, sf).select("id", R.fill_generic_hair(F.col("treatment"), F.col("categories"), F.col("txt")).alias("treatment"))


@query(
    "topic_snap",
    "SELECT id, " + ", ".join(f"{snap_sql(t)} AS {t}" for t in R.TIERS) + " FROM v_rule_text",
    VIEW,
)
def topic_snap(spark, sf):
    return text_rows(spark, sf).select(
        "id", *[R.fill_topic_snap(F.col("topic"), F.col("categories"), F.col("txt"), t).alias(t) for t in R.TIERS]
    )


@query("filled_purpose", f"SELECT id, {PURPOSE} AS purpose FROM v_rule_text", VIEW)
def filled_purpose(spark, sf):
    return text_rows(spark, sf).select("id", R.fill_purpose(F.col("purpose"), F.col("categories"), F.col("txt")).alias("purpose"))


@query("filled_place", f"SELECT id, {PLACE} AS place FROM v_rule_text", VIEW)
def filled_place(spark, sf):
    return text_rows(spark, sf).select("id", R.fill_place(F.col("place"), F.col("categories"), F.col("txt")).alias("place"))


ALL = f"SELECT id, {HAIR} AS treatment, {snap_sql(R.DEFAULT_TIER)} AS topic, {PURPOSE} AS purpose, {PLACE} AS place FROM v_rule_text"


@query("all_rules", ALL, VIEW)
def all_rules(spark, sf):
    return R.apply_rules(V.rule_text(spark, sf)).select("id", "treatment", "topic", "purpose", "place")


@query(
    "rule_impact",
    f"""SELECT count(*) FILTER ({HAIR_FIT}) AS n_eligible, count(*) FILTER ({HAIR_FIT} AND NOT {_any(R.TREATMENT_MARKERS)}) AS n_applied,
        count(*) FILTER ({HAIR_FIT} AND {_any(R.TREATMENT_MARKERS)}) AS n_skipped_text FROM v_rule_text""",
    VIEW,
)
def rule_impact(spark, sf):
    return R.rule_impact(V.rule_text(spark, sf))


def _tier_sql(tier):
    return f"""SELECT '{tier}' AS tier, count(*) AS n_rows, count(*) FILTER (treatment = '{M}' AND topic = '{M}' AND purpose = '{M}' AND place = '{M}') AS n_poor,
      count(*) FILTER (topic = '스냅') AS n_snap, count(*) FILTER (topic = '{M}') AS n_topic_missing,
      count(*) FILTER (topic = '스냅' AND id % 4 = 0) AS focus_snap, count(*) FILTER (topic = '{M}' AND id % 4 = 0) AS focus_topic_missing
      FROM (SELECT id, {HAIR} AS treatment, {snap_sql(tier)} AS topic, {PURPOSE} AS purpose, {PLACE} AS place FROM v_rule_text)"""


@query(
    "tier_comparison",
    "SELECT *, round(n_poor * 100.0::DOUBLE / n_rows, 6) AS poor_pct, round(n_topic_missing * 100.0::DOUBLE / n_rows, 6) AS topic_missing_pct FROM ("
    + " UNION ALL ".join(_tier_sql(t) for t in R.TIERS)
    + ")",
    VIEW,
)
def tier_comparison(spark, sf):
    out = R.tier_comparison(V.rule_text(spark, sf), focus=F.col("id") % 4 == 0)
    return out.withColumns({"poor_pct": F.round("poor_pct", 6), "topic_missing_pct": F.round("topic_missing_pct", 6)})


@query("tier_grid")
def tier_grid(spark, sf):
    """All tiers with the catalogue each of them leads to."""
    from segloom.functions.columns import job_type_norm, payment_group
    from segloom.plans.segment import tier_grid as grid

    cells = V.postings(spark, sf).select("id", job_type_norm("job_type").alias("job_type"), payment_group("payment").alias("payment_group"))
    rows = V.rule_text(spark, sf).join(cells, "id").withColumns({"career": F.lit(M), "continuity": F.lit(M)})
    out = grid(rows)
    return out.withColumns({"poor_pct": F.round("poor_pct", 6), "topic_missing_pct": F.round("topic_missing_pct", 6)})


@query(
    "hallucination_stats",
    f"""SELECT count(*) AS n_value, count(*) FILTER (id % 24 = 12 OR NOT {_any(R.PERM_EVIDENCE)}) AS n_without_evidence FROM v_rule_text WHERE treatment = '펌'""",
    VIEW,
)
def hallucination_stats(spark, sf):
    rows = V.rule_text(spark, sf)
    # some rows have no text at all
    texts = rows.filter("id % 24 <> 12").select("id", "title", "content")
    return S.hallucination_stats(rows.select("id", "treatment"), texts)


AXES4 = ("place", "purpose", "topic", "treatment")


def _missing_pct(source, axis):
    return f"(SELECT round(count(*) FILTER ({axis} = '{M}') * 100.0::DOUBLE / count(*), 6) FROM {source})"


LIMITS = {a: v for a, v in S.UNCLEAR_LIMITS.items() if a in AXES4}


@query(
    "compared_runs",
    f"WITH fixed AS ({ALL})\n"
    + " UNION ALL ".join(
        f"SELECT '{a}' AS axis, round({v} * 100.0::DOUBLE, 6) AS limit_pct, {_missing_pct('v_rule_text', a)} AS pct_raw, {_missing_pct('fixed', a)} AS pct_fixed, "
        f"CAST({_missing_pct('fixed', a)} < {v} * 100.0::DOUBLE AS INT) AS passed"
        for a, v in LIMITS.items()
    ),
    VIEW,
)
def compared_runs(spark, sf):
    rows = V.rule_text(spark, sf)
    runs = {"raw": rows, "fixed": R.apply_rules(rows)}
    out = S.compare_runs(runs, AXES4, LIMITS)
    return out.select(
        "axis", F.round("limit_pct", 6).alias("limit_pct"), F.round("pct_raw", 6).alias("pct_raw"),
        F.round("pct_fixed", 6).alias("pct_fixed"), F.col("passed").cast("int").alias("passed"),
    )
