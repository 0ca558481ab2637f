"""Toxicity by a weighted lexicon.

Folding: letters that look like Latin ones (other scripts, accents, full
width, mathematical letters) become those, digits and signs that stand for
letters become letters inside words that have a letter, all in lower case.
Folded words of the lexicon are found by an Aho-Corasick automaton over the
whole text, and count only as whole words and outside exception phrases. The
score is a logistic function of the weight found per text, normalised by the
logarithm of its length.

Learning: from labelled rows whose crc32(doc_id as text) mod 5 is not 0, at most
about `FIT_ROWS` of them by hash. A word is in the lexicon if it is in toxic
texts far more often than in others (smoothed log odds over `LEAST_ODDS`, in
`LEAST_ROWS` toxic texts at least, `LEXICON` words at most); its weight is the
log odds. Exception phrases are pairs of neighbouring words with a lexicon word
that occur in clean texts only. The offset and the slopes of the logistic
function are fitted on the same rows, so that 0.5 divides the classes.

Cases: null text is empty text, and has a score as any other; without usable
labels every score is 0; labels that are null are left out; a doc_id labelled
more than once counts by its largest label; repeated rows get equal scores; a
null doc_id counts as the text "" for the remainder; an empty table gives an
empty table; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segloom.llm.common import query, table

FIT_ROWS = 20_000
LEXICON = 2_000
LEAST_ROWS = 8
LEAST_ODDS = 3.0
EXCEPTION_ROWS = 3

# Letters of other scripts that look like a Latin letter, and what digits and signs stand for.
LOOKALIKES = {
    "а": "a", "α": "a", "в": "b", "β": "b", "с": "c", "ԁ": "d", "е": "e", "ε": "e", "һ": "h", "і": "i", "ι": "i", "ı": "i", "ј": "j",
    "к": "k", "κ": "k", "ӏ": "l", "м": "m", "п": "n", "ո": "n", "η": "n", "о": "o", "ο": "o", "σ": "o", "օ": "o", "р": "p", "ρ": "p",
    "ԛ": "q", "г": "r", "ѕ": "s", "т": "t", "τ": "t", "ս": "u", "υ": "u", "ν": "v", "ѵ": "v", "ѡ": "w", "ω": "w", "х": "x", "χ": "x",
    "у": "y", "γ": "y", "ʏ": "y", "ø": "o", "ł": "l", "đ": "d", "ß": "s", "ɑ": "a", "ɡ": "g", "ʀ": "r", "ɴ": "n", "ɪ": "i",
}
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "l", "€": "e"}

_STAND_INS = re.compile(r"[0134578@$!|€9]")
_LEET = re.compile(r"(?<![^\W_@$!|€])[\w@$!|€]*[^\W\d_][\w@$!|€]*|[\w@$!|€]*[0134578@$!|€9][\w@$!|€]*[^\W\d_][\w@$!|€]*")
_INVISIBLE = re.compile("[­​-‏⁠﻿]")
_WORD = re.compile(r"[^\W_]+")


class _Letters(dict):
    """Translation of a code point to its plain lower-case letter, worked out when first met."""

    def __missing__(self, code: int) -> int:
        char = unicodedata.normalize("NFKD", chr(code))[:1].lower()
        char = LOOKALIKES.get(char, LOOKALIKES.get(chr(code).lower(), char))
        self[code] = code if len(char) != 1 else ord(char)
        return self[code]


_LETTERS = _Letters()
_SIGN_LETTERS = str.maketrans(SIGNS)


def _plain_signs(found: re.Match) -> str:
    """Stand-ins become letters, but signs at the word's end are punctuation."""
    word = found.group()
    body = word.rstrip("@$!|€")
    return body.translate(_SIGN_LETTERS) + " " * (len(word) - len(body))


def fold(text: str) -> str:
    """The text in plain lower-case letters."""
    if not text.isascii():
        text = _INVISIBLE.sub("", unicodedata.normalize("NFC", text))
        text = text.translate(_LETTERS)
    text = text.lower()
    return _LEET.sub(_plain_signs, text) if _STAND_INS.search(text) else text


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    offset: float = -30.0
    slopes: tuple[float, float] = (0.0, 0.0)

    def automaton(self):
        import ahocorasick

        found = ahocorasick.Automaton()
        for word, weight in self.weights.items():
            found.add_word(word, (len(word), weight))
        for phrase in self.exceptions:
            found.add_word(phrase, (len(phrase), None))
        found.make_automaton()
        return found


def _spans(automaton, text: str) -> tuple[float, int]:
    """(weight, number) of the lexicon words in a folded text."""
    hits, covered = [], []
    n = len(text)
    for end, (size, weight) in automaton.iter(text):
        start = end + 1 - size
        if (start and text[start - 1].isalnum()) or (end + 1 < n and text[end + 1].isalnum()):
            continue
        if weight is None:
            covered.append((start, end))
        else:
            hits.append((start, end, weight))
    if covered:
        hits = [h for h in hits if not any(a <= h[0] and h[1] <= b for a, b in covered)]
    return sum(h[2] for h in hits), len(hits)


def features(automaton, text: str) -> tuple[float, float]:
    """(weight found by the logarithm of the length, the same by the length itself)."""
    folded = fold(text)
    weight, _ = _spans(automaton, folded)
    size = max(1, len(text) / 6)
    return weight / math.log2(2 + size), weight / size


def score(model: Model, text: str | None, automaton=None) -> float:
    automaton = automaton or (model.automaton() if model.weights else None)
    x = features(automaton, text or "") if automaton else (0.0, 0.0)
    z = model.offset + model.slopes[0] * x[0] + model.slopes[1] * x[1]
    return 1 / (1 + math.exp(-max(-60.0, min(60.0, z))))


def held_out(doc_id: str = "doc_id"):
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Regression with a small penalty, by Newton's method."""
    scale = np.maximum(x.std(0), 1e-9)
    a = np.column_stack([np.ones(len(x)), x / scale])
    w = np.zeros(a.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (p * (1 - p))[:, None]).T @ a + 0.05 * np.eye(len(w))
        step = np.linalg.solve(h, a.T @ (y - p) - 0.05 * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return np.concatenate([w[:1], w[1:] / scale])


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """(text, y) of the rows a model is fitted on."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("y"))
    total = max(1, known.count())
    kept = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, rows / total)))
    texts = docs.where(~held_out()).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # The kept labels are `rows` at most (as expected), which bounds this broadcast.
    return texts.join(F.broadcast(kept), "doc_id").select("text", "y")


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    """A model from columns doc_id and text of `docs`, doc_id and toxic of `labels`; nothing else is read."""
    sample = training_rows(docs, labels, rows)

    def grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts: dict[tuple[str, int], int] = {}
            for text, y in zip(batch["text"], batch["y"], strict=True):
                found = set(_WORD.findall(fold(text)))
                for w in found:
                    counts[w, y] = counts.get((w, y), 0) + 1
            yield pd.DataFrame({"word": [k[0] for k in counts], "y": [k[1] for k in counts], "n": list(counts.values())}).astype({"word": object, "y": "int32", "n": "int64"})

    sizes = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    if not bad or not good:
        return Model()
    seen = sample.mapInPandas(grams, "word string, y int, n long").groupBy("word").agg(F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("bad"), F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("good"))
    odds = F.log((F.col("bad") + 0.5) / (bad + 1.0)) - F.log((F.col("good") + 0.5) / (good + 1.0))
    best = seen.withColumn("odds", odds).where((F.col("bad") >= LEAST_ROWS) & (F.col("odds") > LEAST_ODDS))
    weights = {r["word"]: float(r["odds"]) for r in best.orderBy(F.desc(F.col("odds") * F.sqrt("bad")), "word").limit(LEXICON).collect()}
    if not weights:
        return Model()

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicon = Model(weights).automaton()
        for batch in batches:
            rows = []
            for text, y in zip(batch["text"], batch["y"], strict=True):
                folded = fold(text)
                for phrase in _neighbours(folded, lexicon):
                    rows.append((phrase, y))
            yield pd.DataFrame(rows, columns=["phrase", "y"]).astype({"phrase": object, "y": "int32"})

    around = sample.mapInPandas(pairs, "phrase string, y int").groupBy("phrase").agg(F.sum(1 - F.col("y")).alias("good"), F.sum("y").alias("bad"))
    exceptions = tuple(r["phrase"] for r in around.where((F.col("bad") == 0) & (F.col("good") >= EXCEPTION_ROWS)).orderBy(F.desc("good"), "phrase").limit(LEXICON).collect())
    model = Model(weights, exceptions)

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = model.automaton()
        for batch in batches:
            x = [features(automaton, t) for t in batch["text"]]
            yield pd.DataFrame({"a": [v[0] for v in x], "b": [v[1] for v in x], "y": batch["y"]}).astype({"a": "float64", "b": "float64", "y": "int32"})

    got = sample.mapInPandas(measured, "a double, b double, y int").toPandas().sort_values(["a", "b", "y"], ignore_index=True)
    w = _logistic(got[["a", "b"]].to_numpy(), got["y"].to_numpy(float))
    model.offset, model.slopes = float(w[0]), (float(w[1]), float(w[2]))
    return model


def _neighbours(text: str, lexicon) -> set[str]:
    """Lexicon words with the word before or after them, as they stand in the text."""
    out = set()
    n = len(text)
    for end, (size, _) in lexicon.iter(text):
        start = end + 1 - size
        if (start and text[start - 1].isalnum()) or (end + 1 < n and text[end + 1].isalnum()):
            continue
        before = re.search(r"[^\W_]+\W$", text[max(0, start - 40) : start])
        after = re.match(r"\W[^\W_]+", text[end + 1 : end + 41])
        if before and (before.start() or start <= 40):
            out.add(before.group() + text[start : end + 1])
        if after and (end + 1 + after.end() == n or not text[end + 1 + after.end()].isalnum()):
            out.add(text[start : end + 1] + after.group())
    return out


def scored(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`docs` with `score` and `predicted` appended."""

    @F.pandas_udf("double")
    def rate(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = model.automaton() if model.weights else None
        for batch in batches:
            yield pd.Series([score(model, t, automaton) for t in batch], dtype="float64")

    return docs.withColumn("score", rate(F.col(text))).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query("op8_toxicity")
def op8_toxicity(spark, sf_dir):
    """Score of every document by a lexicon learnt outside the held-out fifth."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return scored(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")
