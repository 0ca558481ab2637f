import random

import numpy as np
import pytest

from segloom.llm import substrings


def brute(rows, length):
    """(doc_id, bytes, removed, spans, kept) by looking at every window; equal rows are one document."""
    seen, out, known = set(), [], {}
    for d, text in rows:
        if (d, text) in known:
            out.append(known[d, text])
            continue
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            w = raw[p : p + length]
            if w in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(w)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        known[d, text] = (d, len(raw), sum(gone), spans, bytes(b for b, g in zip(raw, gone, strict=True) if not g))
        out.append(known[d, text])
    return out


def by_id(got):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got.collect()), key=repr)


def test_construction_against_all_windows():
    rng = random.Random(2)
    for _ in range(300):
        length = rng.choice([1, 2, 3, 5])
        texts = [bytes(rng.choice(b"ab\xc3") for _ in range(rng.randint(length, length + 9))) for _ in range(rng.randint(1, 12))]
        places = np.array(rng.sample(range(0, 5000, 20), len(texts)))
        first = {}
        for t, p in zip(texts, places, strict=True):
            for o in range(len(t) - length + 1):
                first[t[o : o + length]] = min(first.get(t[o : o + length], 1 << 60), p + o)
        for t, p, flags in zip(texts, places, substrings.repeated_windows(texts, places, length), strict=True):
            assert flags.tolist() == [first[t[o : o + length]] < p + o for o in range(len(t) - length + 1)]


def test_rows_are_the_suffix_array():
    texts = [b"banana", b"ananas", b"nab"]
    by = sorted(range(3), key=lambda i: -len(texts[i]))
    sizes = np.array([len(texts[i]) for i in by])
    symbols = np.zeros((3, 6), np.uint8)
    for row, i in enumerate(by):
        symbols[row, 6 - len(texts[i]) :] = np.frombuffer(texts[i], np.uint8) + 1
    rows, prefixes = substrings.suffix_rows(symbols, sizes, 1)
    suffixes = sorted((texts[i][o:] + bytes([0]), row, o) for row, i in enumerate(by) for o in range(len(texts[i]) + 1))
    for k, (s, row, o) in enumerate(suffixes):
        if len(s) > 1:
            assert rows[row, o] == k
    for k in range(1, len(suffixes)):
        a, b = suffixes[k - 1][0][:-1], suffixes[k][0][:-1]
        assert prefixes[k] == next((n for n in range(min(len(a), len(b))) if a[n] != b[n]), min(len(a), len(b)))


def test_parts_hold_every_window_once():
    rng = np.random.default_rng(1)
    for data in (rng.integers(97, 100, 5000, dtype=np.uint8), np.full(130_000, 97, np.uint8), rng.integers(0, 255, 99, dtype=np.uint8), rng.integers(0, 255, 100, dtype=np.uint8)):
        start, count, *_ = substrings.parts(data)
        assert np.concatenate([np.arange(s, s + c) for s, c in zip(start, count, strict=True)] or [[]]).tolist() == list(range(max(0, len(data) - 99)))
        assert len(count) == 0 or count.max() <= 100 - 32 + 1


@pytest.fixture(scope="module")
def passages(rows):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdéf") for _ in range(rng.randint(1, 8)))
    shared = [" ".join(word() for _ in range(n)) for n in (20, 60, 200, 18)]
    out = [r[:2] for r in rows]
    for i in range(60):
        own = [" ".join(word() for _ in range(rng.randint(0, 40))) for _ in range(3)]
        out.append((1000 + i, own[0] + rng.choice(shared) + own[1] + rng.choice([*shared, ""]) + own[2]))
    return out


@pytest.mark.parametrize("hot", [8000, 2])
def test_brute_force(spark, passages, hot, monkeypatch):
    monkeypatch.setattr(substrings, "HOT", hot)
    monkeypatch.setattr(substrings, "COLLECTION", 3000)
    df = spark.createDataFrame(passages, "doc_id long, text string").repartition(5)
    assert by_id(substrings.without_repeats(df)) == sorted(brute(sorted(passages), 100), key=repr)


def test_other_lengths(spark, passages):
    df = spark.createDataFrame(passages[-30:], "doc_id long, text string")
    for length in (40, 150):
        assert by_id(substrings.without_repeats(df, length)) == sorted(brute(sorted(passages[-30:]), length), key=repr)
    with pytest.raises(ValueError, match="shorter"):
        substrings.without_repeats(df, 20)


def test_odd_rows(spark, no_docs, clashing, rows):
    assert substrings.without_repeats(no_docs).collect() == []
    assert by_id(substrings.without_repeats(clashing)) == sorted(brute(sorted(r[:2] for r in rows), 100), key=repr)
    text = " ".join(f"w{i}" for i in range(60))
    twice = [(None, text), (1, text), (1, text), (1, "x" + text), (2, None), (2, "")]
    got = by_id(substrings.without_repeats(spark.createDataFrame(twice, "doc_id long, text string")))
    assert len(got) == 6
    assert [g[2] for g in got if g[0] is None] == [0]
    size = len(text)
    assert sorted(g[2] for g in got if g[0] == 1) == [size, size, size]
    named = spark.createDataFrame([("b", text), ("a", text)], "doc_id string, text string")
    assert [(g[0], g[2]) for g in by_id(substrings.without_repeats(named))] == [("a", 0), ("b", size)]


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = substrings.op3_suffix_array_dedup(spark, "/root/testdata/sf0.001").select("doc_id", "n_bytes", "n_removed", "n_spans").collect()
    assert sorted(map(tuple, got)) == [x[:4] for x in brute(sorted(rows), 100)]
