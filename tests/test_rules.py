import itertools

import pytest
from pyspark.sql import functions as F

from segloom.config import MISSING
from segloom.operators import rules as R

AXES = "treatment string, topic string, purpose string, place string, categories array<string>, title string, content string"


def rows(spark, values):
    base = {"treatment": MISSING, "topic": MISSING, "purpose": MISSING, "place": MISSING, "categories": [], "title": "", "content": ""}
    names = list(base)
    data = [(i, *[{**base, **v}[n] for n in names]) for i, v in enumerate(values)]
    return spark.createDataFrame(data, "i int, " + AXES)


def applied(spark, values, axis, **kw):
    return [r[0] for r in R.apply_rules(rows(spark, values), **kw).orderBy("i").select(axis).collect()]


def test_hair(spark):
    cases = [
        {"categories": ["헤어"]},
        {"categories": ["헤어"], "content": "레이어드컷 모델"},
        {"categories": ["일상"]},
        {"categories": ["헤어"], "treatment": "컷"},
    ]
    assert applied(spark, cases, "treatment") == ["헤어 시술 미언급", MISSING, MISSING, "컷"]


def test_guard(spark):
    df = rows(spark, [{"treatment": "펌"}, {"treatment": "펌", "title": "매직 모델"}, {"treatment": "컷"}])
    text = F.concat_ws(" ", "title", "content")
    got = [r[0] for r in df.orderBy("i").select(R.guard_unsupported(F.col("treatment"), text)).collect()]
    assert got == [MISSING, "펌", "컷"]


SNAP = [
    {"categories": ["일상"]},
    {"content": "인물　스냅"},
    {"categories": ["인물스냅"]},
    {"categories": ["인물스냅"], "content": "포폴 작업"},
    {"categories": ["인물스냅"], "content": "스냅"},
    {"categories": ["일상", "웨딩"]},
    {"categories": ["일상"], "content": "신부 예복"},
    {"categories": ["프로필"]},
    {"categories": ["프로필", "일상"]},
    {"categories": ["프로필"], "content": "스냅"},
    {"topic": "웨딩", "categories": ["일상"]},
    {"content": None, "title": None},
]


@pytest.mark.parametrize(
    ("tier", "portrait"),
    [("full", [1, 1, 1]), ("tier1_only", [0, 0, 1]), ("tier2_body_snap", [0, 0, 1]), ("tier2_conditional", [0, 1, 1])],
)
def test_snap_tiers(spark, tier, portrait):
    want = ["스냅", "스냅", *["스냅" if p else MISSING for p in portrait], MISSING, MISSING, MISSING, "스냅", "스냅", "웨딩", MISSING]
    assert applied(spark, SNAP, "topic", tier=tier) == want


def test_unknown_tier(spark):
    with pytest.raises(ValueError, match="tier"):
        R.apply_rules(rows(spark, [{}]), tier="tier9")


def test_purpose_priority(spark):
    texts = ["Before  After", "증명 사진", "메이크업", "룩 북", "졸업"]
    values = ["비포애프터", "프로필·증명사진", "뷰티·메이크업", "패션·룩북·화보", "포트폴리오"]
    pairs = list(itertools.combinations(range(5), 2))
    cases = [{"content": f"{texts[b]} {texts[a]}"} for a, b in pairs]
    assert applied(spark, cases, "purpose") == [values[a] for a, _ in pairs]
    assert applied(spark, [{"categories": ["메이크업"]}, {"categories": ["패션"]}, {"categories": ["프로필"]}], "purpose") == [
        "뷰티·메이크업", "패션·룩북·화보", "프로필·증명사진"
    ]


def test_place(spark):
    cases = [
        {"categories": ["스튜디오"]},
        {"content": "실내 촬영"},
        {"content": "옥상"},
        {"content": "우리 집"},
        {"content": "스튜디오와 야외"},
        {"content": "집에서, 야외"},
        {"categories": ["스튜디오"], "content": "자택"},
        {"content": "a 스튜 b"},
        {"content": "a스튜b"},
        {},
    ]
    assert applied(spark, cases, "place") == ["스튜디오", "스튜디오", "야외", "홈스냅", MISSING, MISSING, MISSING, "스튜디오", MISSING, MISSING]


def test_idempotent_and_explicit_axes_stay(spark, sf):
    from segloom.plans import views as V

    once = R.apply_rules(V.rule_text(spark, sf))
    twice = R.apply_rules(once)
    axes = ["id", "treatment", "topic", "purpose", "place"]
    assert once.select(axes).exceptAll(twice.select(axes)).count() == 0
    joined = V.rule_text(spark, sf).alias("a").join(once.alias("b"), "id")
    for axis in axes[1:]:
        assert joined.filter((F.col(f"a.{axis}") != MISSING) & (F.col(f"a.{axis}") != F.col(f"b.{axis}"))).count() == 0
