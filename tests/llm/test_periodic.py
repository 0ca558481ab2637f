import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from segloom.llm import periodic


def brute_lyndon(x):
    """Distance to the next smaller suffix."""
    n = len(x)
    return [next((j for j in range(i + 1, n) if x[j:] < x[i:]), n) - i for i in range(n)]


def brute_runs(words):
    n, out = len(words), set()
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q) and not any((i, j + q) == (s, s + m) for s, m, _ in out):
                out.add((i, j + q - i, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def expected(doc_id, text):
    """The query's row, word by word."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + m for s, m, q in runs)]
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
    milli = 1000 * best[1] // best[2] if runs else None
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join(f"{s},{m},{q}\n" for s, m, q in runs), " ".join(kept))]
    return (doc_id, len(runs), *best, milli, *sha)


@pytest.mark.parametrize("seed", range(40))
def test_lyndon_array(seed):
    rng = random.Random(seed)
    for n in (0, 1, 2, 3, 10, 60):
        x = [rng.randrange(1 + seed % 5) for _ in range(n)]
        if seed % 3 == 0:
            x = (x[: 1 + n // 5] * n)[:n]
        kinds, ranks = np.unique(x, return_inverse=True)
        ranks = ranks.tolist()
        assert periodic.lyndon_array(ranks, len(kinds)) == brute_lyndon(ranks)
        back = [len(kinds) - 1 - r for r in ranks]
        assert periodic.lyndon_array(back, len(kinds)) == brute_lyndon(back)


@pytest.mark.parametrize("seed", range(25))
def test_runs(seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(12):
        words = []
        while len(words) < rng.randrange(1, 300):
            unit = [rng.randrange(2 + seed % 3) for _ in range(rng.randrange(1, 30))]
            words += (unit * rng.randrange(1, 9))[: rng.randrange(1, 200)]
        texts.append(words)
    texts += [[], [0], [1] * 24, [1] * 23, [1, 2] * 12, [1, 2] * 11 + [1], list(range(8)) * 3, list(range(9)) * 3, list(range(30)) * 2, [0] * 500]
    starts = np.cumsum([0, *map(len, texts)])
    got = periodic.runs(np.array(sum(texts, []), np.int64), starts)
    assert [tuple(r) for r in got.tolist()] == [(k, *r) for k, t in enumerate(texts) for r in brute_runs(t)]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is None, r[0] or 0, r))


def test_query_against_brute_force(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect() if len(r.text or "") < 6000]
    want = {d: expected(d, t) for d, t in docs}
    got = {r.doc_id: tuple(r) for r in periodic.op11_periodic_runs(spark, sf).collect()}
    assert {d: got[d] for d in want} == want
    assert sum(w[1] > 0 for w in want.values()) > 5


def test_odd_rows(spark, tmp_path, clashing, rows):
    extra = [(None, "a b " * 40, None, None, None), (9001, " \t\n", "en", None, 0), (9002, "x " * 100_000, "en", "s", 1), (9003, "é é " * 30, "en", "s", 1), (9004, "a b c\x0bd\x0ce\r" * 9, "en", "s", 1)]
    df = spark.createDataFrame(extra, "doc_id long, text string, lang string, source string, n_chars long")
    for name, table in (("one", clashing), ("two", df), ("three", df.limit(0)), ("four", df.unionAll(df))):
        table.write.parquet(str(tmp_path / name / "documents.parquet"))
    short = [(d, t) for d, t, *_ in rows if len(t or "") < 4000]
    got = {r[0]: r for r in rows_of(periodic.op11_periodic_runs(spark, str(tmp_path / "one")))}
    assert len(got) == len(rows) and all(got[d] == expected(d, t) for d, t in short)
    got = rows_of(periodic.op11_periodic_runs(spark, str(tmp_path / "two")))
    small = [expected(d, t) for d, t, *_ in extra if d != 9002]
    assert [r for r in got if r[0] != 9002] == sorted(small, key=lambda r: (r[0] is None, r[0] or 0))
    long = next(r for r in got if r[0] == 9002)
    assert long[:6] == (9002, 1, 0, 100_000, 1, 100_000_000)
    assert rows_of(periodic.op11_periodic_runs(spark, str(tmp_path / "three"))) == []
    assert rows_of(periodic.op11_periodic_runs(spark, str(tmp_path / "four"))) == sorted([*got, *got], key=lambda r: (r[0] is None, r[0] or 0, r))


def test_general_interface(spark):
    df = spark.createDataFrame([("u", "start " + "a b c " * 10 + "end")], "key string, body string")
    (row,) = periodic.with_runs(df, "key", "body").collect()
    assert (row.doc_id, row.n_words, [tuple(r) for r in row.runs], row.collapsed) == ("u", 32, [(1, 30, 3)], "start a b c end")
