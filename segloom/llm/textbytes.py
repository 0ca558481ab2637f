"""Words and shingles of many texts at once, as numpy arrays over their joined UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_RNG = np.random.default_rng(7)
_BYTE = _RNG.integers(1, 2**64, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 2**64)
# The same number for an upper-case ASCII letter as for its lower-case one.
_BYTE[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    if n:
        out[0] = 1
    done = 1
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = out[:more] * np.uint64(pow(base, done, 2**64))
        done += more
    return out


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def parts(texts, characters: int) -> Iterator[slice]:
    """Slices of a batch's texts with about `characters` characters each; a longer text is a slice of its own."""
    ends = np.cumsum([0 if t is None else len(t) for t in texts])
    at = 0
    while at < len(ends):
        before = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + characters, side="right")))
        yield slice(at, end)
        at = end


def joined(texts) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, starts) of the texts; starts has one number more than there are texts. Null is empty."""
    raw = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
    starts = np.zeros(len(raw) + 1, np.int64)
    np.cumsum([len(r) for r in raw], out=starts[1:])
    return np.frombuffer(b"".join(raw), np.uint8), starts


def word_spans(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, end, text number) of every word of every text."""
    if not len(data):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    inside = ~_SPACE[data]
    head = inside.copy()
    head[1:] &= ~inside[:-1]
    edges = starts[1:-1]
    edges = edges[edges < len(data)]
    head[edges] = inside[edges]  # a new text starts a new word
    first = np.flatnonzero(head)
    tail = inside.copy()
    tail[:-1] &= ~inside[1:]
    cuts = edges[edges > 0] - 1
    tail[cuts] = inside[cuts]
    end = np.flatnonzero(tail) + 1
    return first, end, np.searchsorted(starts, first, side="right") - 1


def word_hashes(data: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64 bits for every word, A-Z taken as a-z."""
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _powers(_BASE, len(data)), out=total[1:])
    back = _powers(_BASE_INVERSE, len(data) + 1)[first]
    return mixed((total[end] - total[first]) * back + (end - first).astype(np.uint64))


def shingles(texts, size: int) -> list[np.ndarray]:
    """For every text the sorted distinct hashes of its `size`-word shingles; of all its words where it has fewer; none without words."""
    data, starts = joined(texts)
    first, end, owner = word_spans(data, starts)
    hashes = word_hashes(data, first, end)
    bounds = np.searchsorted(owner, np.arange(len(starts)))
    mult = np.array([pow(0xD6E8FEB86659FD93, k + 1, 2**64) for k in range(size)], np.uint64)
    rolled = np.zeros(max(0, len(hashes) - size + 1), np.uint64)
    for k in range(size):
        rolled += hashes[k : k + len(rolled)] * mult[k]
    rolled = mixed(rolled)
    out = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= size:
            out.append(np.unique(rolled[a : b - size + 1]))
        elif b > a:
            out.append(mixed(np.array([(hashes[a:b] * mult[: b - a]).sum() + np.uint64(b - a)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
