import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from segloom.llm import neardup
from segloom.llm.graph import components
from segloom.llm.textbytes import shingles


def words_of(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [w for w in re.split(r"[\x20\x09-\x0d]+", lower) if w]


def set_of(text, size):
    w = words_of(text)
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()


def brute(rows, size, percent):
    sets = [set_of(t, size) for _, t in rows]
    label = list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * len(a | sets[j]):
                label[find(i)] = find(j)
    smallest = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            r = find(i)
            smallest[r] = min(d, smallest.get(r, d))
    out = []
    for i, (d, _) in enumerate(rows):
        c = smallest.get(find(i)) if sets[i] else d
        out.append((d, len(sets[i]), c, d == c))
    return sorted(out, key=repr)


def got(df, **settings):
    return sorted((tuple(r) for r in neardup.near_classes(df, **settings).collect()), key=repr)


@pytest.mark.parametrize("size", [4, 5])
def test_brute_force(docs, rows, size):
    assert got(docs, size=size) == brute([r[:2] for r in rows], size, 80)


def test_odd_columns(clashing, rows):
    assert got(clashing, size=4) == brute([r[:2] for r in rows], 4, 80)


def test_chain_of_near_copies(spark, monkeypatch):
    """A chain whose ends differ is one component, also when nothing is found in rounds and blocks are small."""
    monkeypatch.setattr(neardup, "BLOCK", 4)
    rng = random.Random(6)
    text = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(120)]
    rows = []
    for i in range(40):
        rows.append((100 - i, " ".join(text)))
        for _ in range(2):
            text[rng.randrange(len(text))] = f"new{i}{rng.random()}"
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows, 5, 80)
    assert len({r[2] for r in want}) < 10
    assert got(df, size=5) == want
    monkeypatch.setattr(neardup, "ROUNDS", 1)
    monkeypatch.setattr(neardup, "BEST", 0)
    assert got(df, size=5) == want


def test_hot_copies(spark):
    rows = [(i, "the same text for a third of all rows here") for i in range(2000)] + [(i, f"own text number {i} and some words of {i}") for i in range(2000, 2050)]
    result = neardup.near_classes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert result.where("component_id = 0").count() == 2000 and result.where("kept").count() == 51


def test_odd_rows(spark, no_docs):
    assert neardup.near_classes(no_docs).collect() == []
    rows = [(None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (4, "other words than these here"), (None, None), (5, "\t"), (None, "lonely words are these ones too")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(df, size=5) == sorted([(None, 2, 4, False), (4, 2, 4, True), (4, 2, 4, True), (4, 1, 4, True), (None, 0, None, True), (5, 0, 5, True), (None, 2, None, True)], key=repr)


def test_null_and_repeated_ids(spark):
    """A class without doc_id links its near copies, and a chain runs over it; one row of each group stays."""
    rng = random.Random(8)
    text = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(120)]
    chain = []
    for i in range(3):
        chain.append(" ".join(text))
        for k in range(2):
            text[20 + 40 * k + 10 * i] = f"new{i}{k}"
    other = " ".join(f"other{i}" for i in range(100))
    rows = [(1, chain[0]), (None, chain[1]), (3, chain[2]), (None, other), (None, other + " end"), (None, other), (7, "a b c d e f"), (7, "a b c d e f"), (7, "k l m n o p"), (8, "k l m n o p"), (7, chain[0]), (None, " "), (9, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows, 5, 80)
    assert [r[2] for r in brute([rows[0], rows[2]], 5, 80)] == [1, 3]  # the ends are linked through the row without id only
    assert got(df, size=5) == want
    stay = [tuple(r) for r in neardup.survivors(df).collect()]
    assert sorted(map(repr, stay)) == sorted(map(repr, [(1, chain[0]), next(r for r in stay if r[1] and r[1].startswith("other")), (7, "a b c d e f"), (7, "k l m n o p"), (None, " "), (9, None)]))


def test_sequential_test_misses_little():
    """Pairs at the limit pass; pairs far below it are dropped early."""
    rng = np.random.default_rng(1)
    least = neardup.least_matches(80)
    for similarity, low, high in ((0.8, 0.999, 1), (0.9, 1, 1), (0.4, 0, 0.001)):
        a = rng.integers(0, 2**32, (4000, neardup.HASHES), dtype=np.uint32)
        b = np.where(rng.random(a.shape) < similarity, a, a + np.uint32(1))
        assert low <= neardup.passes(a, b, least).mean() <= high


def test_shingles_are_sets(rows):
    texts = [r[1] for r in rows]
    for size in (1, 4, 5):
        seen = {}
        for text, s in zip(texts, shingles(texts, size), strict=True):
            want = set_of(text, size)
            assert len(s) == len(want)
            assert seen.setdefault(frozenset(want), s.tobytes()) == s.tobytes()


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(1000, 1100)] + [(2000, i) for i in range(2001, 2400)] + [(5, 5)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    label = {x: x for pair in links for x in pair}
    for _ in range(200):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert found == {x: label[x] for x in linked}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
    assert components(spark.range(0).select(F.col("id").alias("a"), F.col("id").alias("b"))).count() == 0
