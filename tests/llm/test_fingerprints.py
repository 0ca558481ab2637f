import re

from pyspark.sql import functions as F

from segloom.llm.fingerprints import BINS, edited_pairs, fingerprint, likeness, op2_document_fingerprints, signature


def shingles(text):
    w = [x for x in re.split(r"[\x20\x09-\x0d]+", (text or "").lower()) if x]
    return {tuple(w)} if len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def test_estimates(spark, docs, rows):
    prints = docs.select("doc_id", fingerprint(F.col("text")).alias("f"))
    pairs = prints.alias("a").join(prints.alias("b"), F.col("a.doc_id") < F.col("b.doc_id")).select("a.doc_id", F.col("b.doc_id").alias("other"), likeness(F.col("a.f"), F.col("b.f")).alias("p"), (F.col("a.f") == F.col("b.f")).alias("same"))
    text = {r[0]: r[1] for r in rows}
    errors = []
    for r in pairs.collect():
        a, b = shingles(text[r.doc_id]), shingles(text[r.other])
        errors.append(abs(len(a & b) / len(a | b) - r.p))
        assert 0 <= r.p <= 1
        if a == b:
            assert r.same
    assert max(errors) < 0.2 and sum(errors) / len(errors) < 0.02


def test_all_bins_filled(docs):
    got = docs.select(signature(F.col("text")).alias("s"), "text").collect()
    assert all(len(r.s) == BINS and None not in r.s for r in got)
    by_text = {}
    for r in got:
        assert by_text.setdefault(r.text or "", r.s) == r.s
    # One shingle: all bins hold its value.
    assert all(len(set(r.s)) == 1 for r in got if len(shingles(r.text)) == 1)


def test_donors_are_independent(spark):
    """With a few shingles every filled bin serves some empty ones."""
    s = spark.createDataFrame([("a b c d e f g h",)], "t string").select(signature(F.col("t"))).first()[0]
    counts = sorted(s.count(v) for v in set(s))
    assert len(counts) == 4 and counts[0] > BINS / 12


def test_edited(docs, clashing, rows):
    order = sorted(rows)
    got = {r.doc_id: r for r in edited_pairs(docs).collect()}
    for (i, t, *_), (_, n, *_) in zip(order, order[1:] + order[:1], strict=True):
        t, n = t or "", n or ""
        k = len(t) // 4
        assert got[i].edited == t[: len(t) - k] + n[:k]
    assert edited_pairs(clashing.drop("_key", "_text", "_range")).count() == len(rows)


def test_odd_tables(spark, no_docs, docs):
    assert edited_pairs(no_docs).collect() == []
    one = spark.createDataFrame([(7, "abcdefgh")], "doc_id long, text string")
    assert [r.edited for r in edited_pairs(one).collect()] == ["abcdefab"]
    twice = spark.createDataFrame([(1, "abcd"), (1, "abcd"), (None, "wxyz"), (2, None), (2, "qrst")], "doc_id long, text string")
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.text, r.edited) for r in edited_pairs(twice).collect())
    assert len(got) == 5 and got[0] == (False, 0, "wxyz", "wxya") and got[1] == got[2]


def test_no_python_in_plan(spark, tmp_path):
    plan = op2_document_fingerprints(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
