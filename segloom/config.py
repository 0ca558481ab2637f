"""Parameters of the segment jobs, and the values their results depend on."""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values -----------------------------------------------------------
MISSING = "불명확"
HYBRID = "혼재"
INFO_POOR_KEY = "정보 부족형"
INFO_POOR_KEY_ASSIGN = "정보부족"
PARTIAL_KEY = "부분 정보형"
FULL_KEY = "충분 정보형"
OTHER_KEY = "기타"
PLACE_MISSING_SUFFIX = "장소미기재"
SINGLE_ROW_KEY = "단일·부분정보"
NOT_APPLICABLE = "__해당없음__"
NAME_SEPARATOR = "·"
CATEGORY_PREFIX = "카테고리:"
INFO_POOR_ID = -1

JOB_TYPES = ("model", "beauty", "photo")
PAYMENT_GROUPS = ("n2", "n3", "pay")
SINGLE_SEGMENT_CELL = "photo_n3"
SMALL_CELLS = ("beauty_pay", "photo_pay", "photo_n3")
CATCH_ALL_CELLS = ("model_n2", "beauty_n2", "photo_n2", "model_pay")
FOCUS_CELL = "model_n2"
VERSION = "v2.1-tune"

# axis column -> attribute name in the extraction output
AXIS_NAMES = {
    "place": "촬영 장소",
    "purpose": "촬영 목적",
    "topic": "촬영 주제",
    "treatment": "시술 종류",
    "career": "경력 조건",
    "continuity": "작업 지속성",
}
CELL_RAW_K = {
    "model_n2": 16,
    "model_n3": 5,
    "model_pay": 7,
    "beauty_n2": 5,
    "beauty_n3": 3,
    "beauty_pay": 3,
    "photo_n2": 5,
    "photo_pay": 2,
}
TUNED_K_SCALE = {
    "model_n2": 1.5,
    "model_n3": 2.0,
    "model_pay": 1.5,
    "beauty_n2": 2.5,
    "beauty_n3": 2.0,
    "photo_n2": 2.0,
}
K_CAP = {
    "model_n2": 20,
    "model_n3": 10,
    "model_pay": 15,
    "beauty_n2": 10,
    "beauty_n3": 6,
    "beauty_pay": 5,
    "photo_n2": 10,
    "photo_n3": 1,
    "photo_pay": 3,
}
UNCLEAR_LIMITS = {
    "place": 0.70,
    "purpose": 0.50,
    "topic": 0.85,
    "treatment": 0.72,
    "career": 0.50,
    "continuity": 0.50,
}
GOWER_WEIGHTS = (1.0, 1.0, 3.0, 3.0, 0.0, 0.0)
PARTIAL_DISTANCE = 0.35
PARTIAL_WEIGHT = 0.5
SIGNAL_SHARES = (0.003, 0.005, 0.01, 0.02, 0.03)


@dataclass(frozen=True)
class Gates:
    """Limits of the grading and of the acceptance check."""

    micro_n: int = 30
    catch_all_pct: float = 40.0
    a_min_n: int = 50
    a_max_pct: float = 25.0
    dominant: float = 0.70
    focus_max_pct: float = 30.0
    focus_a_min: int = 10
    micro_max: int = 3
    catch_all_max: int = 0
    poor_max: int = 120
    ab_pct_min: float = 75.0
    low_confidence: float = 0.7


# --- end of fixed values ----------------------------------------------------

CELL = ("job_type", "payment_group")
AXES = ("place", "purpose", "topic", "treatment", "career", "continuity")
DENSITY_AXES = AXES[:4]
# merge keys list the purpose first
KEY_AXES = ("purpose", "place", "topic", "treatment", "career", "continuity")


@dataclass(frozen=True)
class SegmentConfig:
    """Switches and thresholds of one catalogue build."""

    axes: tuple[str, ...] = AXES
    gower_weights: tuple[float, ...] = GOWER_WEIGHTS
    treatment_in_key: bool = True
    dominant_threshold: float = 0.70
    coarse_merge: bool = False
    raw_k: dict = field(default_factory=lambda: dict(CELL_RAW_K))
    raw_k_scale: float = 1.0
    cell_raw_k_scale: dict = field(default_factory=dict)
    min_segment_size: int = 10
    absorb_small: bool = True
    absorb_ambiguous: bool = False
    place_split: bool = False
    purpose_split: bool = False
    rename: bool = False
    split_min_segment: int = 1000
    split_min_missing_ratio: float = 0.25
    split_part_min_size: int = 30
    split_min_portfolio_ratio: float = 0.25
    split_requires_snap: bool = True


DEFAULT_CONFIG = SegmentConfig()
TUNED_CONFIG = SegmentConfig(cell_raw_k_scale=dict(TUNED_K_SCALE), min_segment_size=25)
COARSE_CONFIG = SegmentConfig(coarse_merge=True)

# The sets of variants that are compared.
WEIGHT_VARIANTS = {
    "v1_w1111_3axis": SegmentConfig(gower_weights=(1.0, 1.0, 1.0, 1.0, 0.0, 0.0), treatment_in_key=False),
    "v2_w1122_3axis": SegmentConfig(gower_weights=(1.0, 1.0, 2.0, 2.0, 0.0, 0.0), treatment_in_key=False),
    "v3_w1122_4axis": SegmentConfig(gower_weights=(1.0, 1.0, 2.0, 2.0, 0.0, 0.0)),
    "v4_w1133_4axis": SegmentConfig(gower_weights=(1.0, 1.0, 3.0, 3.0, 0.0, 0.0)),
}
DENSITY_VARIANTS = {
    "v5_dense_nocoarse": SegmentConfig(gower_weights=(1.0, 1.0, 2.0, 2.0, 0.0, 0.0)),
    "v6_dense_dom70": SegmentConfig(gower_weights=(1.0, 1.0, 2.0, 2.0, 0.0, 0.0), dominant_threshold=0.70),
    "v7_dense_k24": SegmentConfig(gower_weights=(1.0, 1.0, 2.0, 2.0, 0.0, 0.0), raw_k_scale=1.5),
}
EXTENDED_VARIANTS = {
    "v7_dense_k24": DENSITY_VARIANTS["v7_dense_k24"],
    "v8_dense_k32": SegmentConfig(gower_weights=(1.0, 1.0, 2.0, 2.0, 0.0, 0.0), raw_k_scale=2.0),
    "v9_dense_w1144": SegmentConfig(gower_weights=(1.0, 1.0, 4.0, 4.0, 0.0, 0.0), raw_k_scale=1.5),
    "v10_dense_split": SegmentConfig(
        gower_weights=(1.0, 1.0, 2.0, 2.0, 0.0, 0.0), raw_k_scale=1.5,
        split_min_segment=400, split_min_missing_ratio=0.18, split_part_min_size=20,
    ),
}
