import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from segloom.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 1000), min_size=1, max_size=9))
def test_targets(sizes):
    weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    got = mixing.shared(sizes, weights, 1.5 * sum(sizes))
    assert sum(got) == pytest.approx(1.5 * sum(sizes))
    assert all(t <= 2 * n for t, n in zip(got, sizes, strict=True))
    free = [t / w for t, w, n in zip(got, weights, sizes, strict=True) if t < 2 * n]
    full = [t / w for t, w, n in zip(got, weights, sizes, strict=True) if 0 < t == 2 * n]
    assert not free or max(free) == pytest.approx(min(free))
    assert not free or not full or max(full) <= max(free) * (1 + 1e-9)


def test_permutation():
    for n in (1, 2, 3, 7, 64, 1000, 4097):
        for key in (1, 2):
            assert sorted(mixing.permuted(np.arange(n), n, key)) == list(range(n))
    assert (mixing.permuted(np.arange(1000), 1000, 1) != mixing.permuted(np.arange(1000), 1000, 2)).any()


@pytest.mark.parametrize("exact", [5e8, 100])
def test_shards_use_up_the_quotas(monkeypatch, exact):
    monkeypatch.setattr(mixing, "_EXACT", exact)
    quota = np.array([700, 0, 13, 2200, 1])
    size, shards = 100, 30
    found = [mixing.shard_counts(s, shards, quota, size, 5) for s in range(shards)]
    assert (sum(c for c, _ in found) == quota).all()
    start = np.zeros(5, int)
    for count, before in found:
        assert (before == start).all()
        start = start + count
    assert all(c.sum() == size for c, _ in found[:-1])


def test_counts_are_spread():
    quota = np.array([30_000, 10_000])
    first = [mixing.shard_counts(s, 40, quota, 1000, 5)[0][1] for s in range(40)]
    assert 240 < np.mean(first) < 260 and 5 < np.std(first) < 25  # a multinomial's spread is 14



def test_mixture(spark, docs, rows):
    mixed = mixing.mixed_documents(docs).collect()
    text = {r[0]: r[1] or "" for r in rows}
    taken = Counter()
    for r in mixed:
        assert r.text in text[r.doc_id] and r.n_chars == len(r.text)
        taken[r.doc_id] += len(WORD.findall(r.text))
    size = {i: len(WORD.findall(t)) for i, t in text.items()}
    assert all(taken[i] <= 2 * size[i] for i in size)
    again = mixing.mixed_documents(docs.repartition(7)).collect()
    assert sorted(map(tuple, mixed), key=repr) == sorted(map(tuple, again), key=repr)


def test_query(spark):
    got = mixing.op9_source_mixing(spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "source").collect()
    size = {r.doc_id: len(WORD.findall(r.text)) for r in docs}
    source = {r.doc_id: r.source for r in docs}
    whole = Counter()
    for i, n in size.items():
        whole[source[i]] += n
    names = sorted(whole)
    target = dict(zip(names, mixing.shared([whole[s] for s in names], [(5, 2, 1)[i % 3] for i in range(len(names))], 1.5 * sum(whole.values())), strict=True))
    taken, rows = Counter(), got.collect()
    assert got.dtypes == [("doc_id", "bigint"), ("size", "bigint"), ("source_size", "bigint"), ("target", "double"), ("taken", "bigint")]
    for r in rows:
        assert r.size == size[r.doc_id] and r.taken <= 2 * r.size and r.source_size == whole[source[r.doc_id]] and r.target == pytest.approx(target[source[r.doc_id]])
        taken[source[r.doc_id]] += r.taken
    assert len(rows) == len(docs)
    assert all(abs(taken[s] - target[s]) <= max(2 * mixing.BLOCK, 0.02 * target[s]) for s in names)


def test_odd_tables(spark, no_docs, clashing, rows):
    assert mixing.mixed_documents(no_docs).collect() == []
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert mixing.mixed_documents(blank).collect() == []
    got = mixing.mixed_documents(clashing)
    assert got.columns == clashing.columns and got.where("key = 'x' AND row = 'x'").count() == got.count() > 0
    twice = spark.createDataFrame([(1, "a b c", "s")] * 3 + [(None, "x y", None)], "doc_id long, text string, source string")
    got = Counter(tuple(r) for r in mixing.mixed_documents(twice).collect())
    assert got[(1, "a b c", "s")] <= 6 and sum(got.values()) > 0


def test_hot_source(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("w " * 40).alias("text"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 9)).alias("source"))
    sizes = mixing.sized(df)
    blocks = mixing.packed_blocks(sizes, mixing.source_plan(sizes))
    per = blocks.groupBy("number", "block").agg(F.sum("words").alias("n"))
    assert per.where(F.col("n") > mixing.BLOCK).count() == 0
    assert blocks.agg(F.sum("words")).first()[0] == 4000 * 40
    assert per.where(F.col("n") < mixing.BLOCK).groupBy("number").count().where("count > 1").count() == 0


def test_stretches(spark):
    texts = [" a\tb \n c", "a  b\x0bc\x0c", "é 𝒳\u00a0y $\\ \r", "a", " \n a b  c d ", "x" * 50 + " y" * 40]
    ranges = [[(0, 2), (2, 1)], [(0, 1), (1, 2)], [(0, 3), (1, 1)], [(0, 1)], [(1, 2)], [(0, 5), (7, 30)]]
    df = spark.createDataFrame(list(zip(texts, ranges, strict=True)), "text string, ranges array<struct<first: long, words: long>>")
    got = [r[0] for r in df.select(mixing.stretches(F.col("text"), F.col("ranges"))).collect()]
    for text, some, found in zip(texts, ranges, got, strict=True):
        spans = [m.span() for m in WORD.finditer(text)]
        assert found == [text if n == len(spans) else text[spans[a][0] : spans[a + n - 1][1]] for a, n in some]


def test_whole_texts_do_not_go_to_python(spark, docs):
    plan = mixing.mixed_documents(docs)._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan
