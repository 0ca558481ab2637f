import re
from collections import Counter

import pytest

import __spark_entry__ as entry
import corpus_pipeline

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_registered():
    queries, sql = entry.queries(), entry.oracle_sql()
    for n in range(1, 14):
        assert sum(q.startswith(f"op{n}_") for q in queries) == 1
    assert queries["pipeline"] is corpus_pipeline.run
    assert {"op6_chat_formatting", "op10_line_dedup"} <= set(sql) <= set(queries)


@pytest.mark.parametrize("name", ["op6_chat_formatting", "op10_line_dedup"])
def test_same_rows_as_sql(spark, name):
    from compare import compare, connect

    same, _, message = compare(spark, connect("/root/testdata/sf0.001"), "/root/testdata/sf0.001", name, entry.queries()[name], entry.oracle_sql()[name])
    assert same, message


def test_stages(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    first = {r.doc_id: r.text for r in docs.collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, before, sf).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        if name != "SentencePiece":
            assert docs.columns == COLUMNS
        if name == "toxicity":
            left = {r.doc_id for r in docs.collect()}
            bad = re.compile(r"\b(idiot|loser|pathetic|scum|worthless|moron|trash|clown|disgusting|stupid)\b")
            assert len(left) > 0.85 * len(first)
            assert left >= {i for i, t in first.items() if not bad.search(t.lower())} - (set(first) - left) and left <= set(first)
        if name == "MinHash near-dedup":
            ids = [r.doc_id for r in docs.collect()]
            assert len(ids) == len(set(ids)) < before.count()
        if name == "mixing sources":
            size = Counter()
            for r in docs.collect():
                assert r.n_chars == len(r.text)
                size[r.source] += len(r.text.split())
            assert size
    assert set(docs.columns) == {"doc_id", "source", "ids", "n_ids"}


def test_stages_on_odd_rows(spark, docs, no_docs, clashing, rows, sf, tmp_path):
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        assert stage(spark, no_docs, sf).collect() == []
        got = stage(spark, clashing, sf)
        assert got.count() > 0
        if k < len(corpus_pipeline.STAGES) - 1:
            assert got.columns == clashing.columns
    kept = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, sf).collect()}
    assert {r[0] for r in rows if not (r[1] or "").split()} <= kept


def test_clashing_columns_keep_their_values(spark, sf):
    rows = [(i, f"text number {i} has some words\nand a second line {i}", lang, "s", 0, 99, 77) for i in range(30) for lang in ("en", "de")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n_lines int, n_dropped int")
    got = corpus_pipeline.drop_boilerplate(spark, df, sf).collect()
    assert len(got) == 60 and all((r.n_lines, r.n_dropped, r.n_chars) == (99, 77, len(r.text)) for r in got)
    mixed = corpus_pipeline.mix_sources(spark, df, sf).collect()
    assert {r.lang for r in mixed} == {"en", "de"} and all((r.n_lines, r.n_dropped) == (99, 77) for r in mixed)


def test_copies_stay_once(spark, sf):
    """A text that holds 30% of a source's rows leaves line dedup whole and near-dedup once."""
    copied = "first line of the copied text\nsecond line of it"
    rows = [(i, copied if i % 10 < 3 else f"own text number {i} with some words\nand line {i}", "en", "s", 0) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.drop_near_copies(spark, corpus_pipeline.drop_boilerplate(spark, df, sf), sf).collect()
    assert [r.doc_id for r in got if r.text == copied] == [0]
    assert not [r for r in got if not r.text] and len(got) == 141


def test_one_row_of_each_group_stays(spark, sf):
    """Copies without doc_id, repeated rows and a kept id's other text that is a copy of an earlier document."""
    one, two = "a text that comes several times in this table", "another text of some more words than seven"
    rows = [(None, one), (None, one), (2, two), (2, two), (5, "an own text with an id of its own"), (5, two)]
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    stay = corpus_pipeline.drop_near_copies(spark, df, sf)
    assert sorted((r.text, r.doc_id) for r in stay.collect()) == [(one, None), (rows[4][1], 5), (two, 2)]


def test_run(spark, sf):
    got = corpus_pipeline.run(spark, sf)
    assert got.count() > 100 and got.columns == ["doc_id", "source", "ids", "n_ids"]
