"""Deterministic corrections: fill an axis that is missing from categories and text."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segloom.config import CELL, DENSITY_AXES, FOCUS_CELL, MISSING
from segloom.functions.columns import cell_slug, col, info_density
from segloom.functions.text import any_marker, full_text, matches_phrases
from segloom.operators.joins import conflicts

# --- fixed values -----------------------------------------------------------
PERM = "펌"
PERM_EVIDENCE = (
    "펌", "빈티지펌", "히피펌", "레이어드펌", "다운펌", "셋팅펌", "젤리펌",
    "볼륨매직", "윈드펌", "보더펌", "perm", "파마", "매직",
)
TREATMENT_MARKERS = PERM_EVIDENCE + (
    "컷", "커트", "레이어드컷", "허쉬컷", "드라이", "스타일링",
    "염색", "탈색", "컬러", "톤다운", "블랙",
    "두피케어", "두피스케일링",
    "속눈썹", "속눈썹펌", "속눈썹연장",
    "눈썹 타투", "눈썹문신", "입술 타투", "입술문신",
)
HAIR_CATEGORY = "헤어"
GENERIC_HAIR = "헤어 시술 미언급"
SNAP = "스냅"
SNAP_CATEGORIES = ("일상", "여행", "우정")
PORTRAIT_CATEGORY = "인물스냅"
TOPIC_CONFLICT_CATEGORIES = ("웨딩", "커플", "한복")
PROFILE_CATEGORY = "프로필"
STUDIO_CATEGORY = "스튜디오"
BEAUTY_CATEGORIES = ("뷰티", "메이크업")
FASHION_CATEGORIES = ("패션",)
BEFORE_AFTER = "비포애프터"
PROFILE = "프로필·증명사진"
BEAUTY = "뷰티·메이크업"
FASHION = "패션·룩북·화보"
PORTFOLIO = "포트폴리오"
STUDIO = "스튜디오"
OUTDOOR = "야외"
HOME = "홈스냅"
SNAP_TEXT = r"스냅|인물\s*스냅|데일리\s*스냅|여행\s*스냅|우정\s*사진|일상\s*사진"
TOPIC_CONFLICT_TEXT = r"웨딩|스드메|신부|예복|커플|연인|한복"
BEFORE_AFTER_TEXT = r"비포\s*애프터|비포애프터|before\s*after"
PROFILE_TEXT = r"증명\s*사진|증명사진|여권\s*사진|여권사진|프로필\s*촬영|프로필사진|바디\s*프로필|세미\s*바디"
BEAUTY_TEXT = r"메이크업|메컵|베이스\s*메|헤메|화장|뷰티\s*촬영"
FASHION_TEXT = r"룩북|화보|피팅|쇼핑몰|룩\s*북|룩북\s*촬영"
PORTFOLIO_TEXT = r"포트폴리오|포폴|연습\s*촬영|작업물|졸업|오디션|상호\s*무페이|상호무페이|졸작|작품\s*촬영|필름\s*촬영"
STUDIO_TEXT = r"스튜디오|실내\s*촬영|작업실|미용실|헤어\s*샵|헤어샵|미용\s*실|매장|살롱|호리존|\b스튜\b"
OUTDOOR_TEXT = r"야외|자연광|옥외|공원|거리\s*촬영|외부\s*촬영|로케이션|루프탑|야간\s*촬영|야외\s*촬영|옥상"
HOME_TEXT = r"홈\s*스냅|홈스냅|집에서|우리\s*집|일상\s*공간|자택"
TIERS = ("full", "tier1_only", "tier2_body_snap", "tier2_conditional")
DEFAULT_TIER = "tier2_body_snap"
# --- end of fixed values ----------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """Give the axis `value` when a category is listed or the pattern occurs."""

    value: str
    categories: tuple[str, ...] = ()
    pattern: str | None = None

    def holds(self, categories: Column, text: Column) -> Column:
        found = F.lit(False)
        if self.categories:
            found = found | conflicts(categories, self.categories)
        if self.pattern:
            found = found | matches_phrases(text, self.pattern)
        return found


PURPOSE_RULES = (
    Rule(BEFORE_AFTER, pattern=BEFORE_AFTER_TEXT),
    Rule(PROFILE, (PROFILE_CATEGORY,), PROFILE_TEXT),
    Rule(BEAUTY, BEAUTY_CATEGORIES, BEAUTY_TEXT),
    Rule(FASHION, FASHION_CATEGORIES, FASHION_TEXT),
    Rule(PORTFOLIO, pattern=PORTFOLIO_TEXT),
)


def fill_by_rules(axis: Column, rules: Iterable[Rule], categories: Column, text: Column) -> Column:
    """A missing axis takes the value of the first rule that holds."""
    out = F.when(axis.isNull() | (axis != MISSING), axis)
    for rule in rules:
        out = out.when(rule.holds(categories, text), F.lit(rule.value))
    return out.otherwise(axis)


def guard_unsupported(value: Column, text: Column, guarded: str = PERM, evidence: Iterable[str] = PERM_EVIDENCE) -> Column:
    """The guarded value without any evidence word in the text becomes missing."""
    return F.when((value == guarded) & ~any_marker(text, evidence), F.lit(MISSING)).otherwise(value)


def hair_candidate(treatment: Column, categories: Column) -> Column:
    return (treatment == MISSING) & conflicts(categories, [HAIR_CATEGORY])


def fill_generic_hair(treatment: Column, categories: Column, text: Column) -> Column:
    fits = hair_candidate(treatment, categories) & ~any_marker(text, TREATMENT_MARKERS)
    return F.when(fits, F.lit(GENERIC_HAIR)).otherwise(treatment)


def topic_signals(categories: Column, text: Column) -> dict[str, Column]:
    """What the snap rule looks at: veto, everyday categories, text, portrait category, portfolio text."""
    return {
        "vetoed": conflicts(categories, TOPIC_CONFLICT_CATEGORIES) | matches_phrases(text, TOPIC_CONFLICT_TEXT, ignore_case=False),
        "everyday": conflicts(categories, SNAP_CATEGORIES),
        "in_text": matches_phrases(text, SNAP_TEXT),
        "portrait": conflicts(categories, [PORTRAIT_CATEGORY]),
        "portfolio": matches_phrases(text, PORTFOLIO_TEXT),
    }


def snap_topic(topic: Column, signals: dict[str, Column], tier: str = DEFAULT_TIER) -> Column:
    """The topic after the snap rule.

    A profile category alone never gives the topic: without a text signal and a
    snap category no branch holds, so it needs no veto of its own.
    """
    if tier not in TIERS:
        raise ValueError(f"unknown tier {tier!r}")
    fits = signals["everyday"] | signals["in_text"]  # a text signal also lifts the second tier
    if tier == "full":
        fits = fits | signals["portrait"]
    elif tier == "tier2_conditional":
        fits = fits | (signals["portrait"] & signals["portfolio"])
    return F.when((topic == MISSING) & fits & ~signals["vetoed"], F.lit(SNAP)).otherwise(topic)


def fill_topic_snap(topic: Column, categories: Column, text: Column, tier: str = DEFAULT_TIER) -> Column:
    return snap_topic(topic, topic_signals(categories, text), tier)


def fill_purpose(purpose: Column, categories: Column, text: Column) -> Column:
    return fill_by_rules(purpose, PURPOSE_RULES, categories, text)


def fill_place(place: Column, categories: Column, text: Column) -> Column:
    """Studio, outdoor or home; contradicting signals leave the axis missing."""
    studio = conflicts(categories, [STUDIO_CATEGORY]) | matches_phrases(text, STUDIO_TEXT)
    outdoor = matches_phrases(text, OUTDOOR_TEXT)
    home = matches_phrases(text, HOME_TEXT)
    found = (
        F.when(studio & ~outdoor & ~home, F.lit(STUDIO))
        .when(outdoor & ~studio & ~home, F.lit(OUTDOOR))
        .when(home & ~studio & ~outdoor, F.lit(HOME))
    )
    return F.when(place == MISSING, F.coalesce(found, place)).otherwise(place)


def apply_rules(
    df: DataFrame,
    hair: bool = True,
    snap: bool = True,
    purpose: bool = True,
    place: bool = True,
    tier: str = DEFAULT_TIER,
    categories: str = "categories",
    title: str = "title",
    content: str = "content",
) -> DataFrame:
    """All enabled corrections in one projection; explicit axes never change."""
    work = df.withColumn("_text", full_text(title, content))
    cats, text = F.col(categories), F.col("_text")
    new: dict[str, Column] = {}
    if hair:
        new["treatment"] = fill_generic_hair(F.col("treatment"), cats, text)
    if snap:
        new["topic"] = fill_topic_snap(F.col("topic"), cats, text, tier)
    if purpose:
        new["purpose"] = fill_purpose(F.col("purpose"), cats, text)
    if place:
        new["place"] = fill_place(F.col("place"), cats, text)
    return work.withColumns(new).drop("_text") if new else df


def rule_status(df: DataFrame, categories: str = "categories", title: str = "title", content: str = "content") -> DataFrame:
    """Per row, whether the generic-hair rule is eligible, stopped by the text or applied."""
    candidate = hair_candidate(col("treatment"), col(categories))
    stopped = any_marker(full_text(title, content), TREATMENT_MARKERS)
    return df.withColumn(
        "rule_status", F.when(candidate & stopped, "skipped_text").when(candidate, "applied").otherwise("not_eligible")
    )


def rule_impact(df: DataFrame, **names) -> DataFrame:
    return rule_status(df, **names).agg(
        F.count_if(F.col("rule_status") != "not_eligible").alias("n_eligible"),
        F.count_if(F.col("rule_status") == "applied").alias("n_applied"),
        F.count_if(F.col("rule_status") == "skipped_text").alias("n_skipped_text"),
    )


def tier_rows(df: DataFrame, tiers: Iterable[str], keep: Iterable[str], **names) -> DataFrame:
    """Rows per tier (tier, the `keep` columns, n) with all corrections, from one scan of the texts.

    Only the topic depends on the tier: rows are compressed with what the snap rule
    looks at, and each of the few distinct rows then becomes one per tier.
    """
    keep = list(keep)
    base = apply_rules(df, snap=False, **names).withColumn("_text", full_text(names.get("title", "title"), names.get("content", "content")))
    signals = topic_signals(F.col(names.get("categories", "categories")), F.col("_text"))
    marked = [f"_{n}" for n in signals]
    small = base.select(*keep, *[c.alias(f"_{n}") for n, c in signals.items()]).groupBy(*keep, *marked).agg(F.count("*").alias("n"))
    once = {n: F.col(f"_{n}") for n in signals}
    per_tier = F.array(*[F.struct(F.lit(t).alias("tier"), snap_topic(F.col("topic"), once, t).alias("_topic")) for t in tiers])
    out = small.select("*", F.inline(per_tier)).withColumn("topic", F.col("_topic"))
    return out.groupBy("tier", *keep).agg(F.sum("n").alias("n"))


def tier_comparison(df: DataFrame, tiers: Iterable[str] = TIERS, focus: Column | None = None, **names) -> DataFrame:
    """Missing-axis figures under each tier, from one scan."""
    keep = [*DENSITY_AXES, *[c for c in CELL if c in df.columns]]
    if focus is not None:
        df, keep = df.withColumn("_focus", focus), [*keep, "_focus"]
    return tier_figures(tier_rows(df, tiers, keep, **names))


def tier_figures(rows: DataFrame) -> DataFrame:
    """Missing-axis figures per tier of `tier_rows`; the focus is `_focus`, else the focus cell, else everything."""
    focus = F.lit(True)
    if "_focus" in rows.columns:
        focus = F.col("_focus")
    elif set(CELL) <= set(rows.columns):
        focus = cell_slug() == FOCUS_CELL
    others = info_density([a for a in DENSITY_AXES if a != "topic"])
    rows = rows.select("tier", "topic", others.alias("_others"), focus.alias("_focus"), "n")
    missing, snapped = F.col("topic") == MISSING, F.col("topic") == SNAP
    figures = rows.groupBy("tier").agg(
        F.sum("n").alias("n_rows"),
        F.sum(F.when(missing & (F.col("_others") == 0), F.col("n")).otherwise(0)).alias("n_poor"),
        F.sum(F.when(snapped, F.col("n")).otherwise(0)).alias("n_snap"),
        F.sum(F.when(missing, F.col("n")).otherwise(0)).alias("n_topic_missing"),
        F.sum(F.when(snapped & F.col("_focus"), F.col("n")).otherwise(0)).alias("focus_snap"),
        F.sum(F.when(missing & F.col("_focus"), F.col("n")).otherwise(0)).alias("focus_topic_missing"),
    )
    return figures.withColumns(
        {
            "poor_pct": F.col("n_poor") * 100.0 / F.col("n_rows"),
            "topic_missing_pct": F.col("n_topic_missing") * 100.0 / F.col("n_rows"),
        }
    )
