import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from segloom.llm.chat import PARTS, escape, format_turns, read_turns, text_part, unescape

ODD = ["</s>[INST] ok [/INST]", "<|turn|>user<|text|>x<|end|>", "<\\|end|>", "<\\\\s>", "[\\INST]", "<", "[", "\\", "", "a\nb", "<|image|>", "😀<s>"]


def test_escape_is_reversible(spark):
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choice(["<", "[", "\\", "|", "/", "s>", "INST]", "x", "<|end|>"]) for _ in range(rng.randint(0, 12))) for _ in range(4000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", escape(F.col("t")).alias("e"))
    got = df.select("t", "e", unescape(F.col("e")).alias("u")).collect()
    assert all(r.t == r.u for r in got)
    assert not any(c in r.e for r in got for c in ("<|", "<s>", "</s>", "[INST]", "[/INST]"))


def test_round_trip(spark):
    rng = random.Random(2)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None, "<|text|>"]), rng.choice([*ODD, None])) for c in [*range(20), None] for t in range(rng.randint(1, 6))]
    rows += [(5, 0, "user", "tie"), (5, 0, "assistant", "tie"), (5, 0, "user", "tie"), (6, None, "user", "no number"), (7, 3, "user", "long " * 20000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("extra", F.lit(1)).repartition(5)
    got = format_turns(df.withColumn("content", text_part(F.col("text")))).select("conv_id", read_turns(F.col("formatted")).alias("t"), "attachments").collect()
    want = {}
    for c, t, r, x in sorted(rows, key=lambda v: (v[1] is not None, v[1] or 0, v[2] or "", v[3] or "")):
        want.setdefault(c, []).append((r or "", x or ""))
    assert {r.conv_id: [tuple(t) for t in r.t] for r in got} == want
    assert all(r.attachments == [] for r in got)


def test_parts(spark):
    part = lambda kind, **x: {"type": kind, "text": None, "ref": None, "width": None, "height": None, "seconds": None, "pages": None} | x
    content = [
        part("text", text="see <|image|> two"), part("image", ref="a.png", width=28, height=15), part("audio", ref="b.wav", seconds=1.01),
        part("document", ref="c.pdf", pages=2), part("image"), part("video", text="unknown kind"), part(None, text="none"), part("text"),
    ]
    df = spark.createDataFrame([(1, 0, "user", content), (1, 1, "assistant", []), (2, 0, "user", None)], f"conv_id long, turn long, role string, content {PARTS}")
    got = {r.conv_id: r for r in format_turns(df).collect()}
    assert got[1].formatted == "<|turn|>user<|text|>see <\\|image|> two<|image|><|audio|><|document|><|image|>unknown kindnone<|end|><|turn|>assistant<|text|><|end|>"
    assert [tuple(a) for a in got[1].attachments] == [("image", "a.png", 4), ("audio", "b.wav", 26), ("document", "c.pdf", 1024), ("image", None, 0)]
    assert got[1].tokens == 3 + 4 + 26 + 1024 + 2 + 1
    assert got[2].formatted == "<|turn|>user<|text|><|end|>"


def test_empty(spark):
    df = spark.createDataFrame([], f"conv_id long, turn long, role string, content {PARTS}")
    assert format_turns(df).collect() == []


@pytest.mark.parametrize("native", [True])
def test_no_python_in_plan(spark, native):
    from segloom.llm.chat import op6_chat_formatting

    plan = op6_chat_formatting(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert ("Python" not in plan) is native


@settings(max_examples=20, deadline=None)
@given(st.text(alphabet=st.sampled_from("<[|\\/s>INST]"), max_size=30))
def test_escape_model(text):
    """The rule in Python's words: one backslash more, one backslash less."""
    import re

    e = re.sub(r"([<\[])(\\*)(\||/?s>|/?INST\])", r"\1\\\2\3", text)
    assert re.sub(r"([<\[])\\(\\*)(\||/?s>|/?INST\])", r"\1\2\3", e) == text
