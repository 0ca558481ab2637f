import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from segloom.config import HYBRID, MISSING
from segloom.functions import columns as C
from segloom.functions import text as X


def column(spark, values, name="v", kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {name} {kind}")


def results(df, expr):
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_missing_and_explicit(spark):
    df = column(spark, [None, MISSING, f" {MISSING}　", "", "x"])
    assert results(df, C.is_missing("v")) == [True, True, True, False, False]


def test_payment_group(spark):
    df = column(spark, [-2, -3, None, 0, 70000], kind="int")
    assert results(df, C.payment_group("v")) == ["n2", "n3", "pay", "pay", "pay"]
    assert results(column(spark, [-2.7, -3.2], kind="double"), C.payment_group("v")) == ["n2", "n3"]


def test_job_type(spark):
    df = column(spark, [" Model ", "PHOTO", "other", None])
    assert results(df, C.job_type_norm("v")) == ["model", "photo", "", ""]


def test_ok_default(spark):
    df = column(spark, [True, False, None], kind="boolean")
    assert results(df, C.is_ok("v", True)) == [True, False, True]
    assert results(df, C.is_ok("v", False)) == [True, False, False]


def test_density_bands(spark):
    df = column(spark, [0, 1, 3, 4], kind="int")
    assert results(df, C.density_label("v")) == ["정보 부족형", "정보 부족형", "부분 정보형", "충분 정보형"]
    assert results(df, C.density_label("v", 0)) == ["정보 부족형", "부분 정보형", "부분 정보형", "충분 정보형"]


def test_domains(spark):
    df = column(spark, ["a", " a ", "z", None])
    assert results(df, C.in_domain("v", ["a"])) == ["a", MISSING, MISSING, MISSING]
    assert results(df, C.in_domain_or_last("v", ["a", "b"])) == ["a", "a", "b", "b"]
    assert results(df, C.in_domain_or_last("v", [MISSING, "a"])) == ["a", "a", MISSING, MISSING]


def test_record_validation(spark):
    df = column(spark, [{"p": "1", "q": "x"}, {"p": "1"}, {"p": "2", "q": "x"}, None], kind="map<string,string>")
    domain = {"p": ["1"], "q": ["x", "y"]}
    assert results(df, C.record_is_valid("v", domain)) == [True, False, False, False]
    assert results(df, C.validated("v", domain)) == [{"p": "1", "q": "x"}, {}, {}, {}]


def test_white_space(spark):
    df = column(spark, ["a　  b\n\tc ", "\x1ca\x1f", None, ""])
    assert results(df, X.collapse_ws("v")) == ["a b c", "a", "", ""]
    assert results(df, C.stripped("v")) == ["a　  b\n\tc", "a", None, ""]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="a \t\n　 \x1c\x85é", max_size=12), min_size=1, max_size=20))
def test_white_space_like_python(spark, values):
    df = column(spark, values)
    assert results(df, X.collapse_ws("v")) == [re.sub(r"\s+", " ", v).strip() for v in values]


def test_training_text(spark):
    df = spark.createDataFrame([(0, " t ", "b  c"), (1, "", "b"), (2, "t", None), (3, None, " ")], "i int, t string, c string")
    assert results(df, X.training_text("t", "c")) == ["t b c", "b", "t", ""]
    emoji = spark.createDataFrame([(0, "😀😀", "x")], "i int, t string, c string")
    assert results(emoji, X.training_text("t", "c", 3)) == ["😀😀 "]


def test_preview(spark):
    assert results(column(spark, ["abcd", "abc", None]), X.preview("v", 3)) == ["abc...", "abc", ""]


def test_json_objects(spark):
    cases = {
        '{"a": 1}': '{"a": 1}',
        'x {"a": 1} y {"b": 2}': '{"a": 1}',
        '```json\n{"a": {"b": [1]}}\n```': '{"a": {"b": [1]}}',
        '```\n{"a": 1}\n```': '{"a": 1}',
        'before ```JSON {"a": "}"}``` after': '{"a": "}"}',
        '{broken {"a": 1}': '{"a": 1}',
        '{"a": {"b": 1}': '{"b": 1}',
        '{"a": 1': None,
        '{"a":1,"a":2}': '{"a": 2}',
        '{"a":1,"a":{"b":2}}': '{"a": {"b": 2}}',
        '{"a": NaN}': '{"a": "NaN"}',
        'x {"a": NaN, "b": {}}': '{"a": "NaN", "b": {}}',
        '{"a": [Infinity, -Infinity]}': '{"a": ["Infinity", "-Infinity"]}',
        "[1, 2]": None,
        "": None,
        None: None,
    }
    got = results(column(spark, list(cases)), X.extract_json_object("v"))
    assert got == list(cases.values())


def test_json_objects_of_every_response(spark, tmp_path):
    """Fenced, surrounded, bare and truncated responses, each as it is and in all shapes."""
    from segloom.plans.scalars_queries import json_objects

    events = [(i, '{"k": %d}' % (i + 10)) for i in range(16)]
    spark.createDataFrame(events, "event_id long, props string").write.parquet(str(tmp_path / "events.parquet"))
    want = []
    for i in range(16):
        k = str(i + 10)
        want += [(i, 0, None if i % 4 == 3 else k), *[(i, n, k) for n in (1, 2, 3, 4)], *[(i, n, None) for n in (5, 6, 7)]]
    got = json_objects(spark, str(tmp_path))
    assert sorted((r.id, r.shape, r.k) for r in got.collect()) == want


def test_repair(spark):
    assert results(column(spark, ['{"k": [1]] ', '{"k": [1]}']), X.repair_tail("v")) == ['{"k": [1]}', '{"k": [1]}']


def test_phase1(spark):
    rows = [
        (0, "모집", "스nap", ["a", " b ", "", "c", "d", "e", "f"]),
        (1, "지 원", "헤어샵", ["a"]),
        (2, "기타", "헤어", ["a"]),
        (3, "구인글", None, None),
    ]
    df = spark.createDataFrame(rows, "i int, k string, d string, w array<string>")
    got = results(df, X.normalize_phase1("k", "d", F.col("w")))
    assert [g and (g["kind"], g["domain"], g["keywords"]) for g in got] == [
        ("구인글", "스냅", ["a", "b", "c", "d", "e"]), ("지원글", "헤어", []), None, ("구인글", "기타", [])
    ]
    assert results(column(spark, ["a, b，c,,"]), X.keyword_list("v")) == [["a", "b", "c"]]


def test_names(spark):
    df = spark.createDataFrame([(0, "포트폴리오", MISSING, HYBRID, "펌"), (1, MISSING, HYBRID, MISSING, HYBRID)], "i int, a string, b string, c string, d string")
    parts = [F.col(c) for c in "abcd"]
    assert results(df, X.display_name(parts)) == ["포트폴리오·펌", "기타"]
    assert results(df, X.display_name(parts[:3], keep_hybrid=True)) == ["포트폴리오·혼재", "혼재"]
    assert results(df, X.display_name([F.col("a")], keep_hybrid=True, place_missing=True)) == ["포트폴리오·장소미기재", "장소미기재"]
    assert results(column(spark, ["혼재·혼재·x", "혼재·y"]), X.is_hybrid_key("v")) == [True, False]


def test_markers(spark):
    df = column(spark, ["레이어드컷 염색 속눈썹펌 매직", "none"])
    words = ["펌", "컷", "레이어드컷", "염색", "속눈썹펌", "매직"]
    assert results(df, X.markers_found(F.col("v"), words)) == ["레이어드컷, 속눈썹펌, 염색, 매직", "-"]


PATTERNS = [r"가나|가\s*다|나라", r"가\s*나|\b다\b|before\s*after", r"가나다|라", r"a[bc]|가"]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.text(alphabet="가나다라 　\x1cab", max_size=8), st.sampled_from(["Before AFTER", "before after"])), min_size=1, max_size=20))
def test_phrases_like_python(spark, values):
    df = column(spark, values)
    for pattern in PATTERNS:
        assert results(df, X.matches_phrases(F.col("v"), pattern)) == [bool(re.search(pattern, v, re.I)) for v in values]


def test_scripts(spark):
    df = column(spark, ["abc", "가", "漢", "豈"])
    assert results(df, X.has_hangul("v")) == [False, True, False, False]
    assert results(df, X.has_cjk("v")) == [False, False, True, True]
