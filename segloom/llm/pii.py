r"""Personal data: generated candidates, scored by gradient-boosted trees.

Base spans are what the kinds' patterns say, leftmost and without overlap in
each kind, minus those that fail the kind's check (`PATTERNS`). Besides them,
generators with high recall propose overlapping spans per kind: mail addresses
with written-out signs or blanks, addresses with other separators, long groups
of digits with any separators, phone numbers without a plus sign. Boosted trees
score each proposal by its format and its context, the scores are calibrated on
rows that the trees have not seen, and a proposal is selected if its
calibrated probability reaches the threshold at which the selection's precision is
`PRECISION` there, best first and without overlap. Base spans always stay.

Labels for fitting come from the texts themselves: a proposal is personal data if
it covers a base span, with the format masked where it would give the answer
away (half of the positives are shown to the trees in a variant form, as the
generators would meet them: without plus sign, with written-out signs, with other
separators), and it is not if it overlaps none, or stems from everyday text (dates,
amounts, lists, numbers that fail a check) put in a base span's place. At most about `FIT_DOCUMENTS`
documents (by hash of their ids, so about the same ones each time) with at most
`FIT_ROWS` proposals are used.

Cases: null text is empty text; texts of any length are scanned whole, each
pattern in linear time; repeated rows are equal; an empty table, or one without
proposals, selects none but base spans; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segloom.llm.common import query, table

KINDS = ("email", "ip", "card", "phone")
FIT_DOCUMENTS = 4_000
FIT_ROWS = 20_000
PRECISION = 0.98
TREES, DEPTH, RATE, BINS = 60, 3, 0.2, 32
SEED = 5

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Possessive runs and a look behind change nothing but the time for long runs of digits.
_IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        total += n if i % 2 == 0 else (n * 2 - 9 if n > 4 else n * 2)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    out, floor = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            out.append((start, found.end()))
        floor = found.end() if found else at + 1
        at = text.find("@", floor)
    return out


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of what the patterns find, by start, then kind."""
    out = [(a, 0, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0")[:4] or 0) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _digits(m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_digits(m.group())) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


# Generators: what might be personal data. Bounded repetitions keep them linear.
_AT = r"(?:[ ]?[(\[{<][ ]?(?:at|AT|@)[ ]?[)\]}>][ ]?|[ ]at[ ]|[ ]?@[ ]?)"
_DOT = r"(?:[ ]?[(\[{<][ ]?(?:dot|DOT|\.)[ ]?[)\]}>][ ]?|[ ]dot[ ]|\.)"
_PROPOSE = (
    re.compile(rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{{1,64}}{_AT}[A-Za-z0-9-]{{1,63}}(?:{_DOT}[A-Za-z0-9-]{{1,63}}){{1,5}}"),
    re.compile(r"(?<![0-9])[0-9]{1,3}(?:[ ]?[.,:_\[\]()-]{1,3}[ ]?[0-9]{1,3}){3}(?![0-9])"),
    re.compile(r"(?<![0-9])[0-9](?:[ .,/_-]{0,2}[0-9]){12,18}(?![0-9])"),
    re.compile(r"(?:\+|\b00)?[0-9(][0-9() ./-]{6,20}[0-9](?![0-9])"),
)
_ANY_AT = re.compile(r"@|\bat\b|\bAT\b")
_ANY_DIGITS = re.compile(r"[0-9][0-9() .,/:_\[\]-]{5}")
_HINTS = (
    re.compile(r"mail|contact|write|reach|courriel|correo"), re.compile(r"\bip\b|host|server|addr"),
    re.compile(r"card|visa|master|credit|carte|karte|tarjeta"), re.compile(r"phone|tel|call|mobil|fax|cell"),
)


def proposals(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of all proposals; they may overlap, also within a kind's neighbours."""
    out = []
    if _ANY_AT.search(text):
        out += [(m.start(), 0, m.end()) for m in _PROPOSE[0].finditer(text)]
    at = 0
    while found := _ANY_DIGITS.search(text, at):
        # Only the neighbourhood of digits is scanned, with room for the longest proposal.
        start, end = max(0, found.start() - 4), found.end()
        while end < len(text) and end - start < 20_000 and (more := _ANY_DIGITS.search(text, end, end + 24)):
            end = more.end()
        stop = min(len(text), end + 48)
        for kind in (1, 2, 3):
            out += [(m.start(), kind, m.end()) for m in _PROPOSE[kind].finditer(text, start, stop) if m.start() >= found.start() - 4]
        at = end
    return sorted(set(out))


def features(text: str, start: int, kind: int, end: int) -> list[float]:
    """Format and context of a proposal, without what decides base spans (plus sign, checks)."""
    body = text[start:end]
    before, after = text[max(0, start - 30) : start].lower(), text[end : end + 20].lower()
    digits = _digits(body)
    groups = re.findall(r"[0-9]+", body)
    seps = re.findall(r"[^0-9A-Za-z]", body)
    return [
        float(kind),
        float(len(body)),
        float(len(digits)),
        len(digits) / len(body),
        float(len(groups)),
        float(len(groups[0]) if groups else 0),
        float(len(groups[-1]) if groups else 0),
        float(max(map(len, groups), default=0)),
        float(digits[0]) if digits else -1.0,
        float(len(set(digits))),
        float(luhn(digits)) if digits and kind == 2 else -1.0,
        float(max((int(g[:4]) for g in groups), default=0)) if kind == 1 else -1.0,
        float(len(seps)),
        float(len(set(seps))),
        float(sum(c.isupper() for c in body)),
        float(body.count(".")),
        float(len(re.findall(r"[A-Za-z]+$", body)[0]) if re.search(r"[A-Za-z]+$", body) else 0),
        float(bool(before) and (before[-1].isalnum() or before[-1] in "_=\"'/#")),
        float(bool(after) and (after[0].isalnum() or after[0] in "_=\"'/#")),
        float(bool(before) and before[-1] == " "),
        float(any(h.search(before) is not None for h in _HINTS)),
        float(_HINTS[kind].search(before) is not None),
        sum("0" <= c <= "9" for c in before + after) / max(1, len(before) + len(after)),
    ]


def _variant(kind: int, body: str, turn: int) -> str:
    """A base span as it may be written where the patterns miss it."""
    if kind == 0:
        at = (" at ", " (at) ", " [at] ", " @ ")[turn % 4]
        return body.replace("@", at).replace(".", (".", " dot ", "[dot]", ".")[turn % 4])
    if kind == 1:
        return body.replace(".", ("[.]", " . ", "-", ",")[turn % 4])
    if kind == 2:
        digits = _digits(body)
        return (" / ", ".", "_", ", ")[turn % 4].join(digits[i : i + 4] for i in range(0, len(digits), 4))
    if turn % 4 == 2:
        return re.sub(r"^\+[0-9]+[ .-]?", "", body)  # without the country
    return body.replace("+", ("", "00", "", "(0)")[turn % 4], 1).strip()


def _ordinary(kind: int, body: str, turn: int) -> str:
    """Everyday text of a kind's look, made of a base span's characters: dates, times, amounts, versions, ranges, lists."""
    d = (_digits(body) * 20 or "1234567890")[turn % 7 :][:16]
    if kind == 0:
        name = body.partition("@")[0]
        return (f"{name} at noon.Then", f"look at {name[:4]}.md", f"{name} at {d[:2]}.{d[2:4]}", f"{name} at home")[turn % 4]
    if kind == 1:
        return (f"{d[0]}, {d[1]}, {d[2]}, {d[3:5]}", f"{d[:2]}:{d[2:4]}:{d[4:6]}:{d[6:8]}", f"9{d[:2]}.{d[2:5]}.8{d[5:7]}.7{d[7:9]}", f"{d[:3]}-{d[3:6]}-{d[6:9]}-{d[9:12]}")[turn % 4]
    if kind == 2:
        wrong = d[:15] + next(c for c in "0123456789" if not luhn(d[:15] + c))
        return (wrong, f"20{d[:2]}-{d[2:4]}-{d[4:6]} {d[6:8]}:{d[8:10]}.{d[10:14]}", ",".join([d[:2], d[2:5], d[5:8], d[8:11], d[11:14]]), " ".join([d[:4], d[4:8], d[8:13]]))[turn % 4]
    return (f"{d[:2]}.{d[2:4]}.20{d[4:6]}", f"20{d[:2]}-20{d[2:4]}", f"{d[:3]} {d[3:6]} {d[6:8]}", f"({d[0]}) {d[1:4]}/{d[4:7]}", f"{d[:2]}/{d[2:4]}/20{d[4:6]} {d[6:8]}.{d[8:10]}")[turn % 5]


def examples(text: str) -> list[tuple[list[float], int]]:
    """Features and labels of a text's proposals, half of the positives in a variant form, and of everyday text in their places."""
    base = base_spans(text)
    out = []
    for turn, (a, kind, b) in enumerate(base):
        body = _variant(kind, text[a:b], turn + a) if (turn + a) % 8 < 4 else text[a:b]
        changed = text[max(0, a - 60) : a] + body + text[b : b + 60]
        low = min(a, 60)
        # The proposal that the generators make of the span's place, whatever its exact bounds.
        near = [p for p in proposals(changed) if p[1] == kind and p[0] < low + len(body) and p[2] > low]
        if near:
            best = max(near, key=lambda p: min(p[2], low + len(body)) - max(p[0], low))
            out.append((features(changed, *best), 1))
        body = _ordinary(kind, text[a:b], turn + a)
        changed = text[max(0, a - 60) : a] + body + text[b : b + 60]
        out += [(features(changed, *p), 0) for p in proposals(changed) if p[0] < low + len(body) and p[2] > low]
    for a, kind, b in proposals(text):
        if not any(x < b and a < y for x, _, y in base):
            out.append((features(text, a, kind, b), 0))
    return out


@dataclass
class Trees:
    """Trees for the logistic loss over binned features."""

    edges: list[np.ndarray] = field(default_factory=list)
    start: float = 0.0
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)  # feature, bin, value by heap position

    def _bins(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(self.edges)])

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS)[1:-1])) for c in x.T]
        bins = self._bins(x)
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.start = float(np.log(share / (1 - share)))
        score = np.full(len(y), self.start)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-score))
            tree, add = self._tree(bins, y - p, p * (1 - p))
            self.trees.append(tree)
            score += add
        return self

    def _tree(self, bins: np.ndarray, gradient: np.ndarray, curve: np.ndarray):
        size = 2 ** (DEPTH + 1)
        feature, cut, value = np.full(size, -1), np.zeros(size, int), np.zeros(size)
        node = np.ones(len(bins), int)
        for level in range(DEPTH + 1):
            for n in range(2**level, 2 ** (level + 1)):
                rows = np.flatnonzero(node == n)
                if not len(rows):
                    continue
                g, h = gradient[rows], curve[rows]
                whole = g.sum() ** 2 / (h.sum() + 1)
                value[n] = RATE * g.sum() / (h.sum() + 1)
                best = (1e-6, -1, 0)
                for k in range(bins.shape[1] if level < DEPTH and len(rows) > 20 else 0):
                    gs = np.cumsum(np.bincount(bins[rows, k], g, BINS + 1))[:-1]
                    hs = np.cumsum(np.bincount(bins[rows, k], h, BINS + 1))[:-1]
                    gain = gs**2 / (hs + 1) + (g.sum() - gs) ** 2 / (h.sum() - hs + 1) - whole
                    gain[(hs < 1) | (h.sum() - hs < 1)] = 0
                    if gain.max() > best[0]:
                        best = (gain.max(), k, int(gain.argmax()))
                if best[1] >= 0:
                    feature[n], cut[n] = best[1], best[2]
                    node[rows] = 2 * n + (bins[rows, best[1]] > best[2])
        return (feature, cut, value), value[node]

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.zeros(0)
        bins = self._bins(x)
        out = np.full(len(x), self.start)
        for feature, cut, value in self.trees:
            node = np.ones(len(x), int)
            for _ in range(DEPTH):
                f = feature[node]
                inner = f >= 0
                node[inner] = 2 * node[inner] + (bins[inner, f[inner]] > cut[node[inner]])
            out += value[node]
        return out


@dataclass
class Model:
    trees: Trees | None = None
    slope: float = 1.0
    offset: float = 0.0
    threshold: float = 2.0

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * self.trees.score(x) + self.offset)))


def fit_trees(x: np.ndarray, y: np.ndarray) -> Model:
    """Trees on two thirds of the rows; calibration and threshold on the rest."""
    rest = np.random.default_rng(SEED).permutation(len(y)) % 3 == 0
    if len(y) < 60 or len(np.unique(y[~rest])) < 2 or len(np.unique(y[rest])) < 2:
        return Model()
    trees = Trees().fit(x[~rest], y[~rest])
    s, t = trees.score(x[rest]), y[rest]
    a = np.column_stack([s, np.ones(len(s))])
    w = np.array([1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + 1e-2 * np.eye(2), a.T @ (t - p) - 1e-2 * (w - [1.0, 0.0]))
        w += step
    model = Model(trees, float(w[0]), float(w[1]))
    p = model.probability(x[rest])
    order = np.argsort(-p, kind="stable")
    precise = np.cumsum(t[order]) / np.arange(1, len(order) + 1)
    last = np.flatnonzero((precise >= PRECISION) & np.r_[p[order][1:] < p[order][:-1], True])
    model.threshold = max(0.5, float(p[order][last[-1]])) if len(last) else 2.0
    return model


def fit(docs: DataFrame) -> Model:
    """A model from columns doc_id and text."""
    total = max(1, docs.count())
    near = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, FIT_DOCUMENTS / total))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [r for t in batch["text"] for r in examples(t or "")]
            yield pd.DataFrame({"x": [r[0] for r in rows], "y": [r[1] for r in rows]}).astype({"x": object, "y": "int32"})

    made = docs.where(near).select("text").mapInPandas(run, "x array<double>, y int")
    got = made.orderBy(F.xxhash64("x"), "y").limit(FIT_ROWS).toPandas()
    if not len(got):
        return Model()
    got = got.iloc[np.lexsort([got["y"], got["x"].map(lambda v: hash(tuple(v)))])]
    return fit_trees(np.array(got["x"].tolist()), got["y"].to_numpy(float))


def selected(text: str, base: list[tuple[int, int, int]], model: Model) -> list[tuple[int, int, int]]:
    """Base spans and the proposals that the model adds, by start, then kind."""
    if model.trees is None or model.threshold > 1:
        return base
    free = [p for p in proposals(text) if not any(a < p[2] and p[0] < b for a, _, b in base)]
    if not free:
        return base
    p = model.probability(np.array([features(text, *f) for f in free]))
    out = list(base)
    for i in np.argsort(-p, kind="stable"):
        if p[i] < model.threshold:
            break
        a, _, b = free[i]
        if not any(x < b and a < y for x, _, y in out):
            out.append(free[i])
    return sorted(out)


def spans_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with `[KIND]` in place of every span; overlapping spans are replaced together."""
    out, at = [], 0
    for a, k, b in sorted(spans):
        if a >= at:
            out += [text[at:a], f"[{KINDS[k].upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def found(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`docs` with `pii`: struct(base array, spans array, redacted)."""
    kind = "array<struct<kind:string,start:int,end:int>>"

    @F.pandas_udf(f"base {kind}, spans {kind}, redacted string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        rows = lambda spans: [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans]
        for batch in batches:
            out = []
            for t in batch:
                t = t or ""
                base = base_spans(t)
                spans = selected(t, base, model)
                out.append((rows(base), rows(spans), redact(t, spans)))
            yield pd.DataFrame(out, columns=["base", "spans", "redacted"])

    return docs.withColumn("pii", run(F.col(text)))


@query("op1_pii")
def op1_pii(spark, sf_dir):
    """Personal data in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, t in zip(batch["doc_id"], batch["text"], strict=True):
                base = base_spans(t or "")
                spans = selected(t or "", base, model)
                counts = [sum(s[1] == k for s in base) for k in range(len(KINDS))]
                out.append((doc_id, *counts, hashlib.sha256(spans_text(base).encode()).hexdigest(), spans_text(spans)))
            yield pd.DataFrame(out, columns=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    return docs.mapInPandas(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")
