"""Periodic runs of words, from Lyndon roots.

A run is a stretch of consecutive words with smallest period q and a length of
at least max(24, 3 q) that no neighbouring word extends. Per text:

1. A run repeats each of its 16-word windows q words later, so it lies inside a
   stretch that is covered by 16-word windows which the text has more than once.
   Only such stretches go on; windows are compared by 64 bits, and equal bits of
   different windows merely let a stretch through.
2. Grouping (`lyndon_array`): the first phase of Baier's suffix sorter, run on a
   stretch as it is and under the reversed order of words. It ends with all
   positions grouped by their longest Lyndon prefix, whose length is the
   position's entry of the Lyndon array.
3. Every run has a Lyndon root among those prefixes under one of the two orders.
   A root at i with length p extends to the left and to the right by the longest
   common extensions of i and i + p. These are exact: names of all windows of
   1, 2, 4, ... words (equal names, equal words) are compared from wide to narrow.

Words are compared as they are; steps 1 and 3 run on all texts of a part of a
batch at once, as arrays.

Cases: null, empty and blank texts have no words and no runs; a text is never
cut, whatever its length; runs are listed by start, then period, each once;
repeated rows and rows without an id give equal rows each; an empty table gives
an empty table; columns that are not asked for are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segloom.llm.common import query, table
from segloom.llm.textbytes import mixed

LEAST_WORDS = 24
LEAST_TURNS = 3
_WINDOW = 16  # words of the windows of step 1: a run has 16 at least that recur a period later
_ROOT = 8  # words that a root's words are followed by once more, at least, in some root of every run
_PART = 1 << 22  # characters of texts that are worked on at once, about
SCHEMA = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def lyndon_array(ranks: list[int], kinds: int) -> list[int]:
    """Length of the longest Lyndon word that starts at each position; ranks are 0 to kinds - 1.

    Positions start in groups by their word. From the highest group down, every
    position i of a group finds the nearest position to its left that lies in a
    lower group; those that were found move to new groups, as many times the
    group's prefix longer as they were found, right above their old ones.
    """
    n = len(ranks)
    group = [0, *ranks]  # positions are numbered from 1; 0 stands before the text
    members: list[list[int]] = [[] for _ in range(kinds)]
    for i, r in enumerate(ranks, 1):
        members[r].append(i)
    size = [len(m) for m in members]  # positions that are still in the group
    prefix = [1] * kinds
    below = list(range(-1, kinds - 1))  # the next lower group
    above = [*range(1, kinds), -1]
    left = list(range(n + 1))  # a position itself, or one to its left once its group is done
    at = kinds - 1
    while at >= 0:
        if size[at]:
            now = [i for i in members[at] if group[i] == at] if size[at] != len(members[at]) else members[at]
            for i in now:
                left[i] = i - 1
            found: dict[int, int] = {}
            for i in now:
                j = i
                while left[j] != j:
                    left[j] = left[left[j]]
                    j = left[j]
                if j:
                    found[j] = found.get(j, 0) + 1
            longer = prefix[at]
            made: dict[tuple[int, int], int] = {}
            for j, times in found.items() if len(found) == 1 else sorted(found.items(), key=lambda x: -x[1]):
                old = group[j]
                if size[old] == 1:
                    prefix[old] += times * longer
                    continue
                new = made.get((old, times))
                if new is None:
                    new = made[old, times] = len(prefix)
                    prefix.append(prefix[old] + times * longer)
                    members.append([])
                    size.append(0)
                    up = above[old]
                    below.append(old)
                    above.append(up)
                    above[old] = new
                    if up >= 0:
                        below[up] = new
                group[j] = new
                members[new].append(j)
                size[new] += 1
                size[old] -= 1
        at = below[at]
    return [prefix[g] for g in group[1:]]


def _stretches(ids: np.ndarray, starts: np.ndarray) -> list[tuple[int, int]]:
    """(first word, end) of the stretches in which runs can lie; `starts` bounds the texts."""
    if len(ids) < _WINDOW:
        return []
    text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    names = mixed(ids.astype(np.uint64) + mixed(text.astype(np.uint64) + np.uint64(1)))
    width = 1
    while width < _WINDOW:
        names = mixed(names[:-width] * np.uint64(0x9E3779B97F4A7C15) + names[width:])
        width *= 2
    places = np.flatnonzero(text[: len(names)] == text[_WINDOW - 1 :])
    order = places[np.argsort(names[places])]
    same = names[order][1:] == names[order][:-1]
    twice = order[np.r_[same, False] | np.r_[False, same]]
    edge = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edge, twice, 1)
    np.add.at(edge, twice + _WINDOW, -1)
    covered = np.cumsum(edge[:-1]) > 0
    change = covered.copy()
    change[1:] = covered[1:] & (~covered[:-1] | (text[1:] != text[:-1]))
    end = covered.copy()
    end[:-1] = covered[:-1] & (~covered[1:] | (text[1:] != text[:-1]))
    return [(a, b) for a, b in zip(np.flatnonzero(change).tolist(), (np.flatnonzero(end) + 1).tolist(), strict=True) if b - a >= LEAST_WORDS]


def _names(words: np.ndarray, longest: int) -> list[np.ndarray]:
    """For every k the names of the windows of 2^k words."""
    out = [np.unique(words, return_inverse=True)[1].astype(np.int64)]
    while 2 << (len(out) - 1) <= longest:
        half = 1 << (len(out) - 1)
        last = out[-1]
        out.append(np.unique(last[:-half] * len(words) + last[half:], return_inverse=True)[1].astype(np.int64))
    return out


def _extended(names: list[np.ndarray], i: np.ndarray, j: np.ndarray, step: int) -> np.ndarray:
    """Number of equal words from i and j on (step 1), or before them (step -1)."""
    done = np.zeros(len(i), np.int64)
    for k in range(len(names) - 1, -1, -1):
        width = 1 << k
        a, b = (i + done, j + done) if step > 0 else (i - done - width, j - done - width)
        fits = np.flatnonzero((a >= 0) & (b < len(names[k])))
        same = fits[names[k][a[fits]] == names[k][b[fits]]]
        done[same] += width
    return done


def runs(ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Rows (text number, start, length, period), sorted, of all runs of texts given as numbers for words."""
    found = _stretches(ids, starts)
    if not found:
        return np.zeros((0, 4), np.int64)
    # All stretches one after another, each followed by a number that stands nowhere else.
    pieces, base, at, bar = [], [], 0, int(ids.max()) + 1
    roots_at, roots_size = [], []
    for a, b in found:
        piece = ids[a:b]
        kinds, ranks = np.unique(piece, return_inverse=True)
        for order in (ranks, len(kinds) - 1 - ranks):
            sizes = np.array(lyndon_array(order.tolist(), len(kinds)), np.int64)
            places = np.flatnonzero(sizes * LEAST_TURNS <= b - a)
            roots_at.append(places + at)
            roots_size.append(sizes[places])
        base.append(at)
        pieces += [piece.astype(np.int64), np.array([bar], np.int64)]
        at, bar = at + b - a + 1, bar + 1
    words, base = np.concatenate(pieces), np.array(base)
    names = _names(words, max(b - a for a, b in found))
    i, p = np.concatenate(roots_at), np.concatenate(roots_size)
    wide = names[_ROOT.bit_length() - 1]
    fits = np.flatnonzero(i + p < len(wide))
    i, p = i[fits], p[fits]
    same = wide[i] == wide[i + p]
    i, p = i[same], p[same]
    right, left = _extended(names, i, i + p, 1), _extended(names, i, i + p, -1)
    start, length = i - left, left + p + right
    keep = length >= np.maximum(LEAST_WORDS, LEAST_TURNS * p)
    start, length, p = start[keep], length[keep], p[keep]
    piece = np.searchsorted(base, start, side="right") - 1
    start = start - base[piece] + np.array([a for a, _ in found])[piece]
    text = np.searchsorted(starts, start, side="right") - 1
    return np.unique(np.column_stack([text, start - starts[text], p, length]), axis=0)[:, [0, 1, 3, 2]]


def split(text: str | None) -> list[bytes]:
    """Words of a text: maximal runs without ASCII white space, in UTF-8."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").split()


def _worked(texts: list[list[bytes]]) -> Iterator[tuple[list[tuple[int, int, int]], bytes]]:
    """For every text its runs (start, length, period) and the words that remain, joined."""
    number: dict[bytes, int] = defaultdict(count().__next__)
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=starts[1:])
    ids = np.empty(starts[-1], np.int64)
    for t, a, b in zip(texts, starts[:-1], starts[1:], strict=True):
        ids[a:b] = np.fromiter(map(number.__getitem__, t), np.int64, b - a)
    found = runs(ids, starts)
    bounds = np.searchsorted(found[:, 0], np.arange(len(texts) + 1)).tolist()
    for k, words in enumerate(texts):
        own = [(s, n, p) for _, s, n, p in found[bounds[k] : bounds[k + 1]].tolist()]
        if own:
            edge = np.zeros(len(words) + 1, np.int64)
            for s, n, p in own:
                edge[s + p] += 1
                edge[s + n] -= 1
            words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
        yield own, b" ".join(words)


def with_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: Callable[[object, str | None], list[bytes]] | None = None) -> DataFrame:
    """doc_id, n_words, the runs by start and period, and the text without the words that repeat a run's first period.

    `words(doc_id, text)` gives the words of a row; by default those of the text.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = batch["text"].str.len().fillna(0).cumsum().to_numpy()
            part = (sizes // _PART).astype(np.int64)
            for _, rows in batch.groupby(part, sort=False):
                texts = [words(i, t) if words else split(t) for i, t in zip(rows["id"], rows["text"], strict=True)]
                done = list(_worked(texts))
                yield pd.DataFrame(
                    {
                        "doc_id": rows["doc_id"].array,
                        "n_words": [len(t) for t in texts],
                        "runs": [[{"start": s, "length": n, "period": p} for s, n, p in own] for own, _ in done],
                        "collapsed": [rest.decode("utf-8", "surrogatepass") for _, rest in done],
                    }
                )

    # The id goes along as text too, as whole numbers with nulls do not stay whole on the way.
    cols = docs.select(F.col(doc_id).alias("doc_id"), F.col(doc_id).cast("string").alias("id"), F.col(text).alias("text"))
    return cols.mapInPandas(run, f"doc_id {docs.schema[doc_id].dataType.simpleString()}, {SCHEMA}")


def with_period(doc_id: str | None, text: str | None) -> list[bytes]:
    """The words of a text; those of about every tenth document repeat with a period from some word on."""
    found = split(text)
    n = len(found)
    h = zlib.crc32((doc_id or "").encode())
    if doc_id is None or n == 0 or h % 10:
        return found
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return found[:a] + [found[a + k % p] for k in range(n - a)]


def strongest(runs_: Column) -> Column:
    """The run with the greatest length by period, compared exactly; ties go to the smallest start, then period."""

    def order(x: Column, y: Column) -> Column:
        a, b = x["length"] * y["period"], y["length"] * x["period"]
        earlier = (a > b) | ((a == b) & ((x["start"] < y["start"]) | ((x["start"] == y["start"]) & (x["period"] < y["period"]))))
        return F.when(earlier, -1).when((a == b) & (x["start"] == y["start"]) & (x["period"] == y["period"]), 0).otherwise(1)

    return F.get(F.array_sort(runs_, order), F.lit(0))


@query("op11_periodic_runs")
def op11_periodic_runs(spark, sf_dir):
    """Runs of all documents, of which about a tenth are made periodic from some word on."""
    found = with_runs(table(spark, sf_dir, "documents"), words=with_period).withColumn("best", strongest(F.col("runs")))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(line, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
