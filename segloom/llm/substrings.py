"""Exact substring dedup by a collection's suffix array, built column by column.

Texts are byte strings. A byte goes if a string of `length` bytes that covers it
also starts earlier (in a document with a smaller id, or earlier in the same
one). Matches never cross documents, and are judged on the input.

1. Texts are cut into overlapping parts that hold every window of `length` bytes
   exactly once: neighbouring windows with the same smallest `MER`-byte string (by
   hash) are one part, of 2 * length - MER bytes at most. Equal windows have the same
   smallest string, so they can only meet among the parts of one such string, and
   parts whose string occurs once hold no repeated window.
2. Equal parts enter once, with their first place; all windows of a later one are
   repeated. The different parts of a string are cut in two, windows that begin far
   before the string and the others, which have more bytes in common, and once more equal
   ones enter once, and those that share theirs with no other stay out.
3. What is left forms collections. A collection's Burrows-Wheeler transform and common prefixes are built from the
   parts' ends: each round inserts one symbol per part, at the place that the
   symbol's rank in the transform gives, and the common prefixes of its neighbours
   follow from the smallest one between equal symbols. Both are read from and written
   to sequential files, one after the other; the files belong to one attempt of one
   task, have no name, and are gone with it.
4. Runs of the suffix array with common prefixes of `length` or more are equal
   windows; all but the earliest are repeated.

Collections are bounded (`COLLECTION` bytes). Where too many different parts share a
string (a phrase in a large share of all documents, with different
surroundings), every window is a part of its own, equal ones again entering once,
so that no group grows with a hot phrase.

Cases: null text is empty text; texts shorter than `length` keep all; repeated
rows (doc_id and text) are one document, given more than once; other rows of a
doc_id follow each other by a hash of their text; a null doc_id comes first;
periodic texts are parts of a window each; an empty table gives an empty table;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segloom.llm.common import query, row_key, running_start, table
from segloom.llm.textbytes import _BASE, _BASE_INVERSE, _powers, mixed
from segloom.runtime import cut

LENGTH = 100
MER = 32
CHUNK = 60_000  # windows that are looked at together; below 2^16
COLLECTION = 1_000_000  # bytes, about
HOT = 4_000  # different parts of one string that are compared in one collection

_TABLE = np.random.default_rng(23).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FORTH, _BACK = _powers(_BASE, CHUNK + 4 * LENGTH), _powers(_BASE_INVERSE, CHUNK + 4 * LENGTH)


def _prefix_sums(data: np.ndarray) -> np.ndarray:
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_TABLE[data] * _FORTH[: len(data)], out=total[1:])
    return total


def _hashes(total: np.ndarray, start: np.ndarray, size) -> np.ndarray:
    return mixed((total[start + size] - total[start]) * _BACK[start])


def parts(data: np.ndarray, length: int = LENGTH, mer: int = MER) -> tuple[np.ndarray, ...]:
    """(start, windows, smallest string's place from the start, its hash, digest) of a text's parts, in order."""
    found = []
    last = len(data) - length  # the last window's start
    for at in range(0, last + 1, CHUNK):
        some = data[at : at + CHUNK + length - 1]
        windows = len(some) - length + 1
        total = _prefix_sums(some)
        mers = _hashes(total, np.arange(len(some) - mer + 1), mer)
        # The position in the low bits makes the smallest one unique, and the leftmost of equal ones.
        low = (mers & ~np.uint64(0xFFFF)) | np.arange(len(mers), dtype=np.uint64)
        size, want = 1, length - mer + 1
        while size * 2 <= want:
            low = np.minimum(low[:-size], low[size:])
            size *= 2
        if size < want:
            low = np.minimum(low[: len(low) - (want - size)], low[want - size :])
        start = np.flatnonzero(np.r_[True, low[1:] != low[:-1]])
        count = np.diff(np.r_[start, windows])
        spans = count + length - 1
        digest = mixed(_hashes(total, start, spans) + spans.astype(np.uint64))
        inner = (low[start] & np.uint64(0xFFFF)).astype(np.int64) - start
        found.append((start + at, count, inner, low[start] >> np.uint64(16), digest))
    if not found:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


class _Files:
    """The transform and the common prefixes of the rows so far: two sequential files, replaced by two new ones each round."""

    def __init__(self, transform: np.ndarray, prefixes: np.ndarray):
        self.files = None
        self.write(transform, prefixes)

    def write(self, transform: np.ndarray, prefixes: np.ndarray) -> None:
        old, self.files = self.files, (tempfile.TemporaryFile(), tempfile.TemporaryFile())
        for file, data in zip(self.files, (transform, prefixes), strict=True):
            file.write(data.data)
            file.seek(0)
        for file in old or ():
            file.close()

    def read(self) -> tuple[np.ndarray, np.ndarray]:
        return tuple(np.frombuffer(bytearray(f.read()), np.uint8) for f in self.files)

    def close(self) -> None:
        for file in self.files:
            file.close()


def _smallest_between(prefixes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The smallest of prefixes[start..end] (both included) for each pair."""
    if not len(start):
        return np.zeros(0, np.uint8)
    order = np.argsort(-start)  # from the last: what lies between two pairs is then empty
    bounds = np.empty(2 * len(start), np.int64)
    bounds[0::2], bounds[1::2] = start[order], end[order] + 1
    out = np.empty(len(start), np.uint8)
    out[order] = np.minimum.reduceat(np.append(prefixes, np.uint8(0)), bounds)[::2]
    return out


def suffix_rows(symbols: np.ndarray, sizes: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(rows, prefixes) of a collection given as rows of symbols aligned at their ends, longest first.

    Symbols are 1 to 255, 0 where a string has none. `prefixes[k]` is what the suffixes at rows k - 1 and k
    share (each string's end differs from the others'), `rows[i, o]` the row of string i's suffix from its
    symbol o on, for suffixes of at least `length`; -1 for shorter ones.
    """
    many, longest = symbols.shape
    alive = np.searchsorted(-sizes, -np.arange(longest + 1), side="right")  # strings of at least so many symbols
    files = _Files(symbols[:, -1].copy(), np.zeros(many, np.uint8))
    at = np.arange(many)  # row of each string's last inserted suffix
    for done in range(longest):
        transform, prefixes = files.read()
        at = at[: alive[done + 1]]
        order = np.argsort(transform, kind="stable")  # equal symbols in the order of their rows
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        ends = len(transform) - np.count_nonzero(transform)  # rows of whole strings: nothing stands before them
        mine = place[at]
        symbol = transform[at]
        before, after = order[mine - 1], order[np.minimum(mine + 1, len(order) - 1)]
        has_before = (mine > 0) & (transform[before] == symbol)
        has_after = (mine + 1 < len(order)) & (transform[after] == symbol)
        shared, shared_after = np.zeros(len(at), np.uint8), np.zeros(len(at), np.uint8)
        shared[has_before] = 1 + _smallest_between(prefixes, before[has_before] + 1, at[has_before])
        shared_after[has_after] = 1 + _smallest_between(prefixes, at[has_after] + 1, after[has_after])
        rows = many + mine - ends
        new = np.zeros(many + len(transform) - ends, bool)
        new[rows] = True
        grown, common = np.empty(len(new), np.uint8), np.empty(len(new), np.uint8)
        grown[~new], common[~new] = transform, prefixes
        left = done + 2  # symbols of a suffix with the one before it
        grown[rows] = symbols[: len(at), longest - left] if left <= longest else 0
        common[rows] = shared
        common[rows[has_after] + 1] = shared_after[has_after]
        files.write(grown, common)
        at = rows
    transform, prefixes = files.read()
    files.close()
    # From every string's end back to its start: the row of the suffix with one symbol more.
    order = np.argsort(transform, kind="stable")
    ends = len(transform) - np.count_nonzero(transform)
    longer = np.empty(len(order), np.int64)
    longer[order] = np.arange(len(order)) + many - ends
    rows = np.full((many, max(0, longest - length + 1)), -1, np.int64)
    at = np.arange(many)
    for size in range(1, longest + 1):
        at = longer[at[: alive[size]]]
        if size >= length:
            rows[np.arange(len(at)), sizes[: len(at)] - size] = at
    return rows, prefixes


def repeated_windows(texts: list[bytes], places: np.ndarray, length: int = LENGTH) -> list[np.ndarray]:
    """For each string, which of its windows of `length` also start at an earlier place.

    `places` are numbers in the order of the strings' places, a window at offset o standing at place + o.
    """
    if not texts:
        return []
    sizes = np.array([len(t) for t in texts], np.int64)
    by = np.argsort(-sizes, kind="stable")
    longest = int(sizes.max())
    symbols = np.zeros((len(texts), longest), np.uint8)
    for row, i in enumerate(by):
        symbols[row, longest - sizes[i] :] = np.frombuffer(texts[i], np.uint8) + 1  # UTF-8 has no byte 255
    rows, prefixes = suffix_rows(symbols, sizes[by], length)
    run = np.cumsum(prefixes < length)  # equal windows stand in one run
    string, offset = np.nonzero(rows >= 0)
    group, place = run[rows[string, offset]], places[by][string] + offset
    order = np.lexsort([place, group])
    first = np.r_[True, group[order][1:] != group[order][:-1]]
    later = np.empty(len(order), bool)
    later[order] = ~first
    out: list[np.ndarray] = [np.zeros(0, bool)] * len(texts)
    bounds = np.searchsorted(string, np.arange(len(texts) + 1))
    for row, i in enumerate(by):
        out[i] = later[bounds[row] : bounds[row + 1]]
    return out


def _runs(flags: np.ndarray, length: int) -> list[tuple[int, int]]:
    """(start, end) of the bytes that the flagged windows cover, as few runs as there are runs of flags."""
    edges = np.flatnonzero(np.diff(np.r_[0, flags.astype(np.int8), 0]))
    return [(int(a), int(b) - 1 + length) for a, b in zip(edges[0::2], edges[1::2], strict=True)]


def _without_own_repeats(found: tuple[np.ndarray, ...], row: int, length: int) -> tuple[np.ndarray, ...]:
    """Parts of a text without those that are equal to an earlier one of it; their stretches as rows without windows.

    So a periodic text gives a few rows, not one for each of its bytes. A stretch's digest is its end, and its
    key one of its own.
    """
    start, count, inner, key, digest = found
    order = np.argsort(digest, kind="stable")
    repeated = np.zeros(len(order), bool)
    repeated[order[1:]] = digest[order][1:] == digest[order][:-1]
    if not repeated.any():
        return found
    begin, end = start[repeated], start[repeated] + count[repeated] + length - 1
    reach = np.maximum.accumulate(end)
    new = np.flatnonzero(np.r_[True, begin[1:] > reach[:-1]])
    begin, end = begin[new], np.r_[reach[new[1:] - 1], reach[-1:]]
    none = np.zeros(len(begin), np.int64)
    own = mixed(np.arange(len(begin), dtype=np.uint64) + np.uint64(row * 0x9E3779B97F4A7C15 % 2**64))
    kept = [x[~repeated] for x in found]
    return tuple(np.concatenate(x) for x in zip(kept, (begin, none, none, own, end.astype(np.uint64)), strict=True))


_PLACE = 1 << 31  # bytes of a text at most, in a place number


def covered(docs: DataFrame, length: int = LENGTH, mer: int = MER) -> DataFrame:
    """(row, start, end): stretches of bytes that go, overlapping; `docs` has columns row (by place) and text."""
    if mer >= length:
        raise ValueError("the common string must be shorter than a window")

    def cut_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, found = [], []
            for row, text in zip(batch["row"], batch["text"], strict=True):
                one = _without_own_repeats(parts(np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8), length, mer), row, length)
                rows.append(np.full(len(one[0]), row, np.int64))
                found.append(one)
            start, count, inner, key, digest = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 5
            yield pd.DataFrame({"key": key.view(np.int64), "digest": digest.view(np.int64), "row": np.concatenate(rows) if rows else start, "span": start << 16 | inner << 8 | count})

    # A part's place, its string's place in it and its windows (both below 2^8) are one number; no windows: a settled stretch.
    cut_parts = docs.mapInPandas(cut_up, "key long, digest long, row long, span long")
    windows_of = F.col("span").bitwiseAND(255)
    several = cut_parts.groupBy("key").agg(F.count("*").alias("n"), F.min(windows_of).alias("least")).where("n > 1 OR least = 0")
    # Written first, so that the join reads two shuffles and the rows of a hot string can be split.
    found = cut(cut_parts.join(cut(several.select("key")).hint("shuffle_hash"), "key"))
    settled = found.where(windows_of == 0).select("row", F.shiftright("span", 16).alias("start"), F.col("digest").alias("end"))
    shared = found.where(windows_of > 0)
    first = cut(shared.groupBy("key", "digest").agg(F.min(F.struct("row", "span")).alias("first"), F.count("*").alias("n")))
    again = shared.join(first.where("n > 1").select("key", "digest", "first"), ["key", "digest"]).where((F.col("row") != F.col("first.row")) | (F.col("span") != F.col("first.span")))
    begin = F.shiftright("span", 16)
    again = again.select("row", begin.alias("start"), (begin + F.col("span").bitwiseAND(255) + (length - 1)).alias("end"))

    different = first.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    wanted = first.select("key", "first.*").join(different, "key")
    asked = wanted.groupBy("row").agg(F.collect_list("span").alias("asked"))  # a document's own parts

    def number(raw: bytes) -> int:
        return int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "big", signed=True)

    half = (length - mer) // 2

    def halves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The asked parts' bytes, cut in two by how far before the string a window begins."""
        for batch in batches:
            out = []
            for row, text, asked_ in zip(batch["row"], batch["text"], batch["asked"], strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                for span in asked_:
                    begin_, inner, count = span >> 16, span >> 8 & 255, span & 255
                    far = max(0, min(count, inner - half + 1))  # windows that begin `half` bytes or more before the string
                    at = begin_ + inner
                    for start, n, same in ((begin_, far, raw[at - half : at + mer]), (begin_ + far, count - far, raw[at : at + length - half + 1])):
                        if n:
                            bytes_ = raw[start : start + n + length - 1]
                            out.append((number(same), number(bytes_), row, start, bytes_))
            yield pd.DataFrame(out, columns=["key", "digest", "row", "start", "bytes"]).astype({"key": "int64", "digest": "int64", "row": "int64", "start": "int64"})

    strings = cut(docs.join(asked, "row").mapInPandas(halves, "key long, digest long, row long, start long, bytes binary"))
    once = strings.groupBy("key", "digest").agg(F.min(F.struct("row", "start", "bytes")).alias("first"), F.count("*").alias("n"))
    once = cut(once.select("key", "digest", "first.*", "n"))
    places = once.where("n > 1").select("key", "digest", F.col("row").alias("r"), F.col("start").alias("s"))
    same = strings.join(places, ["key", "digest"]).where("row <> r OR start <> s").select("row", "start", (F.col("start") + F.length("bytes")).alias("end"))
    crowd = once.groupBy("key").agg(F.count("*").alias("of_key")).where("of_key > 1")
    unsettled = cut(once.select("key", "row", "start", "bytes").join(crowd, "key"))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        group = group.sort_values(["key", "row", "start"], ignore_index=True)
        size = group["bytes"].map(len).cumsum().to_numpy()
        key = group["key"].to_numpy()
        # Whole keys, until a collection is full.
        at = 0
        while at < len(group):
            end = int(np.searchsorted(size, (size[at - 1] if at else 0) + COLLECTION, "right"))
            end = max(end, int(np.searchsorted(key, key[at], "right")))
            end = int(np.searchsorted(key, key[end - 1], "right")) if end < len(group) and key[end] == key[end - 1] else end
            some = group.iloc[at:end]
            rank = np.unique(some["row"], return_inverse=True)[1].astype(np.int64)
            flags = repeated_windows(some["bytes"].tolist(), rank * _PLACE + some["start"].to_numpy(np.int64), length)
            for row, start, own in zip(some["row"], some["start"], flags, strict=True):
                out += [(row, start + a, start + b) for a, b in _runs(own, length)]
            at = end
        return pd.DataFrame(out, columns=["row", "start", "end"]).astype("int64")

    whole = unsettled.where(F.col("of_key") <= HOT)
    groups = int((whole.agg(F.sum(F.length("bytes")).alias("n")).first()["n"] or 0) // COLLECTION + 1)
    compared = whole.withColumn("group", F.pmod(F.xxhash64("key"), F.lit(groups))).groupBy("group").applyInPandas(compare, "row long, start long, end long")

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(number(b[i : i + length]), row, start + i) for row, start, b in zip(batch["row"], batch["start"], batch["bytes"], strict=True) for i in range(len(b) - length + 1)]
            yield pd.DataFrame(out, columns=["key", "row", "start"]).astype("int64")

    hot = unsettled.where(F.col("of_key") > HOT).select("row", "start", "bytes").mapInPandas(windows, "key long, row long, start long")
    hot = hot.select("key", F.struct("row", "start").alias("place"))
    firsts = hot.groupBy("key").agg(F.min("place").alias("first"))
    later = hot.join(firsts, "key").where("place <> first").select("place.row", "place.start", (F.col("place.start") + length).alias("end"))
    return settled.unionAll(again).unionAll(same).unionAll(compared).unionAll(later)


def in_order(rows: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(row, text) and (row, doc_id): row is a whole number in the order of the documents, equal for equal rows.

    Ids that are whole numbers, without nulls or repetitions, serve themselves; there are no second rows then.
    """
    whole = rows.schema["doc_id"].dataType.simpleString() in ("bigint", "int", "smallint", "tinyint")
    odd = rows.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL")
    if whole and not odd.limit(1).count():
        return rows.select(F.col("doc_id").cast("long").alias("row"), "text"), None
    keyed = rows.withColumn("_key", row_key("doc_id", "text"))
    numbered = running_start(keyed.select("doc_id", "_key").distinct().withColumns({"_all": F.lit(0), "_one": F.lit(1)}), "_all", ["doc_id", "_key"], "_one")
    numbered = cut(numbered.select("_key", "doc_id", F.col("start").alias("row")))
    return keyed.select("_key", "text").join(numbered.select("_key", "row"), "_key").select("row", "text"), numbered.select("row", "doc_id")


def without_repeats(docs: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (binary), for every row."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    own, ids = in_order(rows)
    spans = covered(own, length).groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("spans"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text_, spans_ in zip(batch["text"], batch["spans"], strict=True):
                raw = text_.encode("utf-8", "surrogatepass")
                kept, at, runs, gone = [], 0, 0, 0
                for a, b in sorted((s["start"], s["end"]) for s in (spans_ if spans_ is not None else ())):
                    if a > at or (not runs and a == 0):
                        runs += 1
                        kept.append(raw[at:a])
                        gone += b - a
                        at = b
                    elif b > at:
                        gone += b - at
                        at = b
                kept.append(raw[at:])
                out.append((len(raw), gone, runs, b"".join(kept)))
            yield pd.concat([batch[["row"]].reset_index(drop=True), pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept"])], axis=1)

    cleaned = own.join(spans, "row", "left").mapInPandas(run, "row long, n_bytes long, n_removed long, n_spans long, kept binary")
    named = cleaned.withColumn("doc_id", F.col("row").cast(rows.schema["doc_id"].dataType)) if ids is None else cleaned.join(ids, "row")
    return named.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept")


@query("op3_suffix_array_dedup")
def op3_suffix_array_dedup(spark, sf_dir):
    """What is left of every document without repeated strings of 100 bytes."""
    done = without_repeats(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
