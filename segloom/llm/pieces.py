"""SentencePiece encoding and decoding by suffix-array matching.

For a batch of texts: the distinct words (a word starts at a mark, or at a run
of marks, as no piece crosses from another character to a mark) are joined,
the joined text is indexed by an array of its suffixes sorted to the length of
the longest piece, and every piece of the vocabulary is binary-searched for
its range of occurrences. The occurrences are the edges of a lattice; they are
sorted by end position and relaxed from left to right.

The vocabulary's model merges pairs (BPE), so relaxing does not add scores:
an edge is taken at a node if the last piece chosen at its start may stand
before it, that is if merging the two pieces' text would give these two pieces.
Exactly one edge per node passes, and following the choices back from a word's
end gives the word's encoding. Characters without a piece become byte pieces.
Pieces of several marks only have one common score, below all others: a run of
marks is matched after the rest, by merging it from the left.

Cases: null text has null ids; empty text has no ids; repeated rows are equal;
an empty table gives an empty table; texts of any length are one row each, and
a batch's memory is bounded by cutting batches by their bytes; the mark itself
in a text decodes to a space, as in the model's own library; other columns
pass through (columns named as the added ones are replaced).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segloom.llm.common import query, table

MARK = "▁"
_BATCH = 1_000_000  # characters
_WORD = re.compile("▁+[^▁]*|[^▁]+")
_KNOWN = 300_000  # words that are remembered between batches, about
_NONE = np.int64(-1)
_FREE = 1 << 30  # a number for characters without a piece, which merge with nothing


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@dataclass
class Vocabulary:
    pieces: list[str]  # by id
    rank: np.ndarray  # smaller merges earlier; -1 for pieces that do not take part
    left: np.ndarray  # last merge of a piece, or -1 for a single character
    right: np.ndarray
    pair_keys: np.ndarray  # sorted (a << 32 | b) of all pairs whose text is a piece
    pair_rank: np.ndarray
    byte_ids: np.ndarray
    special: frozenset[int]
    order: np.ndarray  # ids of normal pieces
    prefix: bool
    shown: list[bytes] | None = None


def load(path: str) -> Vocabulary:
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    pieces = [p.piece for p in model.pieces]
    normal = [i for i, p in enumerate(model.pieces) if p.type == 1]
    ids = {pieces[i]: i for i in normal}
    rank = np.full(len(pieces), -1, np.int64)
    # Equal scores are told apart by position only at a merge, so they share a rank.
    scores = sorted({model.pieces[i].score for i in normal}, reverse=True)
    place = {s: k for k, s in enumerate(scores)}
    for i in normal:
        rank[i] = place[model.pieces[i].score]
    keys, ranks = [], []
    for i in normal:
        text = pieces[i]
        for cut in range(1, len(text)):
            a, b = ids.get(text[:cut]), ids.get(text[cut:])
            if a is not None and b is not None:
                keys.append(a << 32 | b)
                ranks.append(rank[i])
    order = np.argsort(np.array(keys, np.int64))
    left, right = np.full(len(pieces), -1, np.int64), np.full(len(pieces), -1, np.int64)
    pair = dict(zip(keys, ranks, strict=True))
    for i in normal:
        if len(pieces[i]) > 1:
            parts = _merge([ids.get(c, -1) for c in pieces[i]], pieces, ids, pair, stop=2)
            if len(parts) == 2:
                left[i], right[i] = parts
    byte_ids = np.full(256, -1, np.int64)
    for i, p in enumerate(model.pieces):
        if p.type == 6:
            byte_ids[int(p.piece[3:-1], 16)] = i
    special = frozenset(i for i, p in enumerate(model.pieces) if p.type in (2, 3))
    # A piece that its own merges do not give is never produced.
    made = [i for i in normal if len(pieces[i]) == 1 or left[i] >= 0]
    return Vocabulary(pieces, rank, left, right, np.array(keys, np.int64)[order], np.array(ranks, np.int64)[order], byte_ids, special, np.array(made, np.int64), model.normalizer_spec.add_dummy_prefix)


def _merge(parts: list[int], pieces: list[str], ids: dict, pair: dict, stop: int) -> list[int]:
    """Merging the best neighbours until `stop` parts are left."""
    while len(parts) > stop:
        best = min(((pair.get(a << 32 | b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a >= 0 and b >= 0), default=(1 << 60, 0))
        if best[0] == 1 << 60:
            break
        i = best[1]
        parts = [*parts[:i], ids[pieces[parts[i]] + pieces[parts[i + 1]]], *parts[i + 2 :]]
    return parts


class Relation:
    """Which pieces may follow each other, worked out for many pairs at once and remembered."""

    def __init__(self, v: Vocabulary):
        self.v = v
        self.keys = np.zeros(0, np.int64)
        self.good = np.zeros(0, bool)

    def _rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.v.pair_keys, key), len(self.v.pair_keys) - 1)
        return np.where(self.v.pair_keys[at] == key, self.v.pair_rank[at], _FREE)

    def _work_out(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """A merge across the border comes first unless a merge inside either piece stands before it.

        Merges of both pieces are undone from the latest on; if, at some stage, the two
        parts beside the border would merge before the merge last undone, the pair cannot stand.
        """
        v = self.v
        a, b = a.copy(), b.copy()
        good = np.ones(len(a), bool)
        # Rank of the merge undone last: a border merge below it would have come first.
        limit = np.full(len(a), _FREE, np.int64)
        from_right = np.ones(len(a), bool)
        alive = np.arange(len(a))
        while len(alive):
            x, y, now = a[alive], b[alive], limit[alive]
            r = self._rank_of(x, y)
            # Of equal ranks the left one merges first: the border stands left of a merge undone on its right side.
            bad = (r < now) | ((r == now) & (r < _FREE) & from_right[alive])
            good[alive[bad]] = False
            can_x, can_y = v.left[x] >= 0, v.left[y] >= 0
            rx, ry = np.where(can_x, v.rank[x], -1), np.where(can_y, v.rank[y], -1)
            go = ~bad & (can_x | can_y)
            take_y = ry >= rx  # the later merge; of equal ones the right one came later
            undo_y, undo_x = alive[go & take_y], alive[go & ~take_y]
            limit[undo_y], from_right[undo_y] = v.rank[b[undo_y]], True
            b[undo_y] = v.left[b[undo_y]]
            limit[undo_x], from_right[undo_x] = v.rank[a[undo_x]], False
            a[undo_x] = v.right[a[undo_x]]
            alive = alive[go]
        return good

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 32 | b
        unique, back = np.unique(key, return_inverse=True)
        at = np.searchsorted(self.keys, unique)
        known = np.zeros(len(unique), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == unique[inside]
        out = np.zeros(len(unique), bool)
        out[known] = self.good[at[known]]
        if not known.all():
            new = unique[~known]
            out[~known] = self._work_out(new >> 32, new & 0xFFFFFFFF)
            if len(self.keys) > 4_000_000:  # memory, not results
                self.keys, self.good = new, out[~known]
            else:
                keys = np.concatenate([self.keys, new])
                order = np.argsort(keys, kind="stable")
                self.keys, self.good = keys[order], np.concatenate([self.good, out[~known]])[order]
        return out[back]


class Encoder:
    def __init__(self, path: str):
        self.v = v = load(path)
        self.relation = Relation(v)
        texts = [v.pieces[i] for i in v.order]
        # Numbers are compared four at a time; every piece leaves at least one free, for the end of its range.
        self.longest = (max(map(len, texts)) // 4 + 1) * 4
        # Pieces as rows of code points, zero-padded, sorted as the suffixes are.
        table_ = np.zeros((len(texts), self.longest), np.uint32)
        for k, t in enumerate(texts):
            table_[k, : len(t)] = [ord(c) for c in t]
        self.size = np.array([len(t) for t in texts], np.int64)
        self.codes = np.unique(table_[table_ > 0])
        self.rows = np.where(table_ > 0, self._numbers(table_), 0).astype(np.uint16)
        # Neighbours that stand together in no piece: no merge crosses such a place, so words are cut there.
        a, b = self.rows[:, :-1].astype(np.uint32), self.rows[:, 1:].astype(np.uint32)
        self.together = np.unique((a << 16 | b)[b > 0])
        self.ids = {v.pieces[i]: int(i) for i in v.order}
        self.pair = dict(zip(v.pair_keys.tolist(), v.pair_rank.tolist(), strict=True))
        self.runs: dict[int, np.ndarray] = {}
        self.known: dict[str, bytes] = {}  # words of earlier batches
        marks = [t for t in texts if MARK in t[1:]]
        if any(t.strip(MARK) for t in marks) or len({v.rank[self.ids[t]] for t in marks}) > 1:
            raise ValueError("a piece with a mark inside that is not a run of marks of the common score")
        self.longest_run = max(map(len, marks), default=1)

    def _numbers(self, points: np.ndarray) -> np.ndarray:
        """Code points as small numbers in the same order, from 1; the largest for those in no piece."""
        at = np.minimum(np.searchsorted(self.codes, points), len(self.codes) - 1)
        return np.where(self.codes[at] == points, at + 1, len(self.codes) + 1).astype(np.uint16)

    def _edges(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, number of the piece) of all occurrences; zeros in `data` end words, and no piece holds one."""
        n = len(data)
        wide = np.concatenate([data, np.zeros(self.longest + 4, np.uint16)]).astype(np.uint64)
        four = wide[:-3] << np.uint64(48) | wide[1:-2] << np.uint64(32) | wide[2:-1] << np.uint64(16) | wide[3:]
        # The suffix array, to the length of the longest piece: ranks of 4 characters, then of twice as many each time.
        rank, size = _ranks(four), 4
        while size < self.longest:
            far = np.concatenate([rank[size:], np.zeros(size, np.uint64)])
            rank, size = _ranks(rank << np.uint64(32) | far), size * 2
        order = np.argsort(rank[:n]).astype(np.int32)
        del rank
        columns = [four[order + k] for k in range(0, self.longest, 4)]
        wanted = _fours(self.rows)
        # Above a piece's occurrences: the same piece followed by the largest number.
        above = self.rows.copy()
        above[np.arange(self.longest)[None, :] >= self.size[:, None]] = 0xFFFF
        low, high = _search(columns, wanted), _search(columns, _fours(above))
        count = high - low
        piece = np.repeat(np.arange(len(count), dtype=np.int32), count)
        at = np.arange(int(count.sum()), dtype=np.int32) + np.repeat((low - np.cumsum(count) + count).astype(np.int32), count)
        return order[at], piece

    def _run(self, n: int) -> np.ndarray:
        """Ids of n marks alone."""
        if n not in self.runs:
            whole = self.longest_run
            rest = _merge([self.ids[MARK]] * (n % whole), self.v.pieces, self.ids, self.pair, stop=0)
            self.runs[n] = np.array([self.ids[MARK * whole]] * (n // whole) + rest, np.int32)
        return self.runs[n]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word, marks and then characters that are none, as the bytes of 32-bit numbers."""
        odd = {k: w for k, w in enumerate(words) if w.startswith(MARK * 2) or w == MARK}
        plain = list(words)
        for k, w in odd.items():
            plain[k] = MARK + w.lstrip(MARK)
        out = self._match(plain)
        one = np.int32(self.ids[MARK]).tobytes()
        for k, w in odd.items():
            marks = len(w) - len(plain[k]) + 1
            if plain[k] == MARK:
                out[k] = self._run(marks).tobytes()
            elif out[k][:4] == one:
                out[k] = self._run(marks).tobytes() + out[k][4:]
            else:
                out[k] = self._run(marks - 1).tobytes() + out[k]
        return out

    def _match(self, words: list[str]) -> list[bytes]:
        """Ids of each word with one mark at most, at its start."""
        if not words:
            return []
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        numbers = self._numbers(points)
        head = np.zeros(len(points) + 1, bool)
        word_at = np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))])
        head[word_at] = True
        pair = numbers[:-1].astype(np.uint32) << 16 | numbers[1:]
        near = np.minimum(np.searchsorted(self.together, pair), len(self.together) - 1)
        head[1:-1] |= self.together[near] != pair
        # The parts of words, each distinct one once.
        cuts = np.flatnonzero(head)
        text = "".join(words)
        number: dict[str, int] = {}
        cuts_ = cuts.tolist()
        part = np.array([number.setdefault(text[x:y], len(number)) for x, y in zip(cuts_[:-1], cuts_[1:], strict=True)], np.int64)
        coded = self._match_parts(list(number))
        where = np.searchsorted(cuts, word_at).tolist()
        order = part.tolist()
        get = coded.__getitem__
        return [get(order[x]) if y - x == 1 else b"".join(map(get, order[x:y])) for x, y in zip(where[:-1], where[1:], strict=True)]

    def _match_parts(self, parts: list[str]) -> list[bytes]:
        """Ids of each part, by its lattice."""
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        ends = np.cumsum(sizes + 1) - 1
        begin = ends - sizes
        inside = np.ones(int(ends[-1]) + 1, bool)
        inside[ends] = False
        points = np.zeros(len(inside), np.uint32)
        points[inside] = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)
        data = np.where(inside, self._numbers(points), 0).astype(np.uint16)
        begin_of = np.repeat(begin.astype(np.int32), sizes + 1)
        start, piece = self._edges(data)
        # A character without a piece is an edge of its own.
        lone = inside.copy()
        lone[start[self.size[piece] == 1]] = False
        alone = np.flatnonzero(lone).astype(np.int32)
        start = np.concatenate([start, alone])
        ids = np.concatenate([self.v.order.astype(np.int32)[piece], np.full(len(alone), _FREE, np.int32)])
        end = start + np.concatenate([self.size.astype(np.int32)[piece], np.ones(len(alone), np.int32)])
        del piece
        step = end - begin_of[start]  # characters from the part's start
        by = np.argsort(step.astype(np.uint16) if len(step) and step.max() < 1 << 16 else step, kind="stable")
        start, ids, end, step = start[by], ids[by], end[by], step[by]
        last = np.full(len(data), _NONE)  # the piece chosen that ends before a position
        chosen = np.zeros(len(data), np.int64)  # and where it starts
        first = start == begin_of[start]
        cuts = np.flatnonzero(np.r_[True, step[1:] != step[:-1], True]).tolist()
        for s, e in zip(cuts[:-1], cuts[1:], strict=True):
            before = last[start[s:e]]
            ok = first[s:e].copy()
            rest = np.flatnonzero(~ok & (before >= 0))
            free = (before[rest] == _FREE) | (ids[s:e][rest] == _FREE)
            ok[rest[free]] = True
            rest = rest[~free]
            ok[rest] = self.relation(before[rest], ids[s:e][rest].astype(np.int64))
            taken = np.flatnonzero(ok) + s
            last[end[taken]] = ids[taken]
            chosen[end[taken]] = start[taken]
        # The choices from every part's end back to its start, all parts together.
        used = np.zeros(len(data), bool)
        at, stop = ends.copy(), begin
        while len(at):
            used[at] = True
            if (last[at] < 0).any():
                raise ValueError("a position of the lattice was not reached")
            at = chosen[at]
            go = at > stop
            at, stop = at[go], stop[go]
        place = np.flatnonzero(used)
        what = last[place]
        if (what == _FREE).any():
            place, what = self._bytes(points, place, what)
        bounds = (4 * np.searchsorted(place, np.concatenate([begin, [len(data)]]), side="right")).tolist()
        flat = what.astype(np.int32).tobytes()
        return [flat[x:y] for x, y in zip(bounds[:-1], bounds[1:], strict=True)]

    def _bytes(self, points: np.ndarray, place: np.ndarray, what: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same tokens with byte pieces for characters that have no piece."""
        free = np.flatnonzero(what == _FREE)
        raw = [chr(c).encode("utf-8", "surrogatepass") for c in points[place[free] - 1].tolist()]
        count = np.ones(len(what), np.int64)
        count[free] = list(map(len, raw))
        filled = np.repeat(what, count)
        filled[filled == _FREE] = self.v.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
        return np.repeat(place, count), filled

    def encode(self, texts: list[str | None]) -> list[np.ndarray | None]:
        """Ids of each text."""
        return [x for _, some in self.encode_some(texts) for x in some]

    def encode_some(self, texts: list[str | None]) -> Iterator[tuple[slice, list[np.ndarray | None]]]:
        """The same, some texts at a time: a batch is cut by its characters."""
        at = 0
        while at < len(texts):
            end, n = at, 0
            while end < len(texts) and (end == at or n + len(texts[end] or "") <= _BATCH):
                n += len(texts[end] or "")
                end += 1
            yield slice(at, end), self._encode_some(texts[at:end])
            at = end

    def _encode_some(self, texts: list[str | None]) -> list[np.ndarray | None]:
        first = MARK if self.v.prefix else ""
        found = [_WORD.findall(first + t.replace(" ", MARK)) if t else [] for t in texts]
        if len(self.known) > _KNOWN:
            self.known.clear()
        new = list(set().union(*found).difference(self.known))
        self.known.update(zip(new, self.encode_words(new), strict=True))
        get = self.known.__getitem__
        return [None if t is None else np.frombuffer(b"".join(map(get, f)), np.int32) for t, f in zip(texts, found, strict=True)]


def _ranks(keys: np.ndarray) -> np.ndarray:
    """Dense ranks; 0 for key 0 only."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.r_[ordered[:1] > 0, ordered[1:] != ordered[:-1]]
    out = np.empty(len(keys), np.uint64)
    out[order] = np.cumsum(new).astype(np.uint64)
    return out


def _fours(rows: np.ndarray) -> list[np.ndarray]:
    """Rows of numbers as columns of four numbers each."""
    wide = rows.astype(np.uint64)
    return [wide[:, k] << np.uint64(48) | wide[:, k + 1] << np.uint64(32) | wide[:, k + 2] << np.uint64(16) | wide[:, k + 3] for k in range(0, wide.shape[1], 4)]


def _search(columns: list[np.ndarray], wanted: list[np.ndarray]) -> np.ndarray:
    """First of the sorted rows that is not below each wanted row, by bisection of all at once."""
    n, m = len(columns[0]), len(wanted[0])
    low, high = np.zeros(m, np.int64), np.full(m, n, np.int64)
    while (open_ := low < high).any():
        mid = np.minimum((low + high) // 2, n - 1)
        below = np.zeros(m, bool)
        equal = open_.copy()
        for column, want in zip(columns, wanted, strict=True):
            row = column[mid]
            below |= equal & (row < want)
            equal &= row == want
        low, high = np.where(open_ & below, mid + 1, low), np.where(open_ & ~below, mid, high)
    return low


def _piece_bytes(v: Vocabulary) -> list[bytes]:
    """What each id adds to a decoded text."""
    out = [p.replace(MARK, " ").encode("utf-8", "surrogatepass") for p in v.pieces]
    for byte, i in enumerate(v.byte_ids):
        if i >= 0:
            out[i] = bytes([byte])
    for i in v.special:
        out[i] = " ⁇ ".encode() if i == min(v.special) else b""
    return out


def decode(v: Vocabulary, ids) -> str:
    """The text of a list of ids."""
    if v.shown is None:
        v.shown = _piece_bytes(v)
    text = b"".join(map(v.shown.__getitem__, ids)).decode("utf-8", "replace")
    # The mark put before every text, if the first id that shows anything has it.
    first = next((i for i in ids if v.shown[i]), None)
    return text[1:] if v.prefix and first is not None and v.pieces[first].startswith(MARK) else text


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per process and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encoded(docs: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """`docs` with `ids` (array of int) appended."""
    path = path or default_model()

    @F.pandas_udf("array<int>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tool = encoder(path)
        for batch in batches:
            for _, ids in tool.encode_some(batch.tolist()):
                yield pd.Series(ids, dtype=object)

    return docs.withColumn("ids", run(F.col(text)))


def decoded(rows: DataFrame, ids: str = "ids", path: str | None = None) -> DataFrame:
    """`rows` with `decoded` appended."""
    path = path or default_model()

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        v = encoder(path).v
        for batch in batches:
            yield pd.Series([None if x is None else decode(v, x) for x in batch], index=batch.index, dtype=object)

    return rows.withColumn("decoded", run(F.col(ids)))


@query("op4_sentencepiece")
def op4_sentencepiece(spark, sf_dir):
    """Ids of every document, and whether they decode to its text."""
    path = default_model()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tool = encoder(path)
        for batch in batches:
            texts, doc_ids = batch["text"].tolist(), batch["doc_id"]
            for at, ids in tool.encode_some(texts):
                back = [None if x is None else decode(tool.v, x.tolist()) for x in ids]
                digest = [None if t is None else hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in back]
                yield pd.DataFrame(
                    {
                        "doc_id": doc_ids.iloc[at].to_numpy(),
                        "n_ids": pd.array([None if x is None else len(x) for x in ids], dtype="Int64"),
                        "ids": ids,
                        "decoded_sha256": digest,
                        "round_trip": [a == b for a, b in zip(back, texts[at], strict=True)],
                    }
                )

    # Encoding and decoding in one worker: a task holds one vocabulary and some texts at a time.
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.mapInPandas(run, "doc_id long, n_ids long, ids array<int>, decoded_sha256 string, round_trip boolean")
