"""Text, JSON and array column functions."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from segloom.config import (
    CATEGORY_PREFIX,
    HYBRID,
    MISSING,
    NAME_SEPARATOR,
    OTHER_KEY,
    PLACE_MISSING_SUFFIX,
)
from segloom.functions.columns import col, stripped

# --- fixed values -----------------------------------------------------------
WHITE_SPACE = "(?U)[\\s\\x1c-\\x1f]+"
POST_KIND = "구인글"
APPLY_KIND = "지원글"
POST_SYNONYMS = ("구인글", "구인", "모집", "리크루트")
APPLY_SYNONYMS = ("지원글", "지원")
DOMAINS = ("헤어", "메이크업", "스냅", "기타")
# --- end of fixed values ----------------------------------------------------


def text_or_empty(c: str | Column) -> Column:
    return F.coalesce(col(c), F.lit(""))


def collapse_ws(c: str | Column) -> Column:
    """Runs of white space become one space; ends trimmed; NULL becomes ''."""
    return F.trim(F.regexp_replace(text_or_empty(c), WHITE_SPACE, " "))


def training_text(title: str | Column, content: str | Column, max_chars: int | None = None) -> Column:
    """Title, one space, content; `max_chars` cuts the result (code points)."""
    parts = [F.nullif(collapse_ws(c), F.lit("")) for c in (title, content)]
    joined = F.concat_ws(" ", *parts)
    return joined if max_chars is None else F.substring(joined, 1, max_chars)


def preview(c: str | Column, n: int = 100) -> Column:
    text = collapse_ws(c)
    return F.when(F.length(text) > n, F.concat(F.substring(text, 1, n), F.lit("..."))).otherwise(text)


def full_text(title: str | Column, content: str | Column) -> Column:
    return F.concat(text_or_empty(title), F.lit(" "), text_or_empty(content))


def any_marker(text: Column, markers: Iterable[str]) -> Column:
    """Case-sensitive containment of any of the markers."""
    found = F.lit(False)
    for marker in markers:
        found = found | text.contains(marker)
    return found


def markers_found(text: Column, markers: Iterable[str], n: int = 4) -> Column:
    """The `n` longest distinct markers that occur, joined; '-' when none does."""
    # distinct markers, longest first; the listed order breaks ties
    ordered = sorted(dict.fromkeys(markers), key=len, reverse=True)
    hits = F.filter(F.array(*[F.lit(m) for m in ordered]), lambda m: F.contains(text, m))
    return F.when(F.size(hits) == 0, F.lit("-")).otherwise(F.array_join(F.slice(hits, 1, n), ", "))


def matches(text: Column, pattern: str, ignore_case: bool = True) -> Column:
    """Regex search with Unicode classes and word boundaries; `\\s` outside brackets also takes \\x1c to \\x1f."""
    return text.rlike(("(?iU)" if ignore_case else "(?U)") + re.sub(r"(?<!\\)\\s(?![^\[]*\])", r"[\\s\\x1c-\\x1f]", pattern))


def matches_phrases(text: Column, pattern: str, ignore_case: bool = True) -> Column:
    """Same as `matches` for an alternation of phrases, without a regex over every text.

    Phrases are words joined by optional white space (`\\s*`), possibly with `\\b`. A
    single word is a plain substring search. A longer phrase is only searched as a
    regex in texts that contain all its words. Other patterns go to `matches`.
    """
    phrases = pattern.split("|")
    if any(re.search(r"[\\^$.\[\](){}?*+]", re.sub(r"\\s\*|\\b", "", p)) for p in phrases):
        return matches(text, pattern, ignore_case)
    found = F.lit(False)
    rest = []
    words_of = {p: [w for w in re.split(r"\\s\*|\\b", p) if w] for p in phrases}
    plain = [p for p in phrases if words_of[p] == [p]]
    for phrase in phrases:
        words = words_of[phrase]
        if ignore_case and any(w.lower() != w.upper() for w in words):
            rest.append(phrase)
        elif words == [phrase]:
            found = found | text.contains(phrase)
        elif not any(word in w for word in plain for w in words):
            # otherwise a plain word above already covers the phrase
            gate = F.lit(True)
            for word in words:
                gate = gate & text.contains(word)
            found = found | (gate & text.rlike("(?U)" + phrase.replace("\\s*", "[\\s\\x1c-\\x1f]*")))
    return found | matches(text, "|".join(rest)) if rest else found


def has_hangul(c: str | Column) -> Column:
    return text_or_empty(c).rlike("[\\uAC00-\\uD7A3]")


def has_cjk(c: str | Column) -> Column:
    return text_or_empty(c).rlike("[\\u4E00-\\u9FFF\\u3400-\\u4DBF\\uF900-\\uFAFF]")


def fence_body(c: str | Column) -> Column:
    """The first chunk of a fenced response that starts with '{', else the whole text."""
    chunks = F.transform(
        F.split(col(c), "```"),
        lambda chunk, i: F.when(
            i % 2 == 1, stripped(F.regexp_replace(stripped(chunk), "(?iU)^json[\\s\\x1c-\\x1f]*", ""))
        ).otherwise(stripped(chunk)),
    )
    return F.coalesce(F.get(F.filter(chunks, lambda chunk: chunk.startswith("{")), F.lit(0)), col(c))


@F.pandas_udf(StringType())
def _first_object(texts: pd.Series) -> pd.Series:
    # NaN and the infinities become strings, so that the result is JSON for every reader.
    decoder = json.JSONDecoder(parse_constant=str)

    def first(text):
        start = text.find("{") if text is not None else -1
        while start >= 0:
            try:
                value, _ = decoder.raw_decode(text, start)
                return json.dumps(value, ensure_ascii=False)
            except ValueError:
                start = text.find("{", start + 1)
        return None

    return texts.map(first)


def extract_json_object(c: str | Column) -> Column:
    """First decodable JSON object of a raw response, in one form of text; NULL if there is none.

    One rule for all texts, flat or nested, one object or several: the first brace from which a
    JSON object can be read. Of repeated keys the last one counts.
    """
    body = fence_body(c)
    return _first_object(F.when(body.contains("{"), body))


def repair_tail(c: str | Column) -> Column:
    """A closing ']]' at the end becomes ']}'."""
    return F.regexp_replace(stripped(c), "(?U)\\]\\][\\s\\x1c-\\x1f]*$", "]}")


def posting_kind(c: str | Column) -> Column:
    """The post kind after synonym lookup; NULL when it is neither kind."""
    value = F.regexp_replace(col(c), WHITE_SPACE, "")
    is_post = value.isin(*POST_SYNONYMS) | (value.endswith("구인") & ~value.contains(APPLY_KIND))
    return F.when(is_post, POST_KIND).when(value.isin(*APPLY_SYNONYMS), APPLY_KIND)


def posting_domain(c: str | Column) -> Column:
    """The listed domain contained in the value, by list order; the last one by default."""
    value = stripped(text_or_empty(c))
    result = F.when(value.isin(*DOMAINS), value)
    result = result.when(value.contains("스") & F.lower(value).contains("nap"), "스냅")
    for domain in DOMAINS:
        result = result.when(value.contains(domain), domain)
    return result.otherwise(DOMAINS[-1])


def keyword_list(c: str | Column, limit: int = 5) -> Column:
    """Keywords of a comma-separated text (ASCII or full-width commas)."""
    return clean_keywords(F.split(text_or_empty(c), "[,，]"), limit)


def clean_keywords(c: str | Column, limit: int = 5) -> Column:
    """Trimmed non-empty keywords, at most `limit`."""
    words = F.coalesce(col(c), F.array().cast("array<string>"))
    return F.slice(F.filter(F.transform(words, lambda w: stripped(w)), lambda w: w != ""), 1, limit)


def normalize_phase1(kind: str | Column, domain: str | Column, keywords: Column) -> Column:
    """Normalised record; NULL when the kind is unknown. `keywords` is an array."""
    known = posting_kind(kind)
    none = F.array().cast("array<string>")
    words = F.when(known == APPLY_KIND, none).otherwise(clean_keywords(keywords))
    return F.when(
        known.isNotNull(),
        F.struct(known.alias("kind"), posting_domain(domain).alias("domain"), words.alias("keywords")),
    )


def all_signals(keywords: Column, categories: Column) -> Column:
    none = F.array().cast("array<string>")
    prefixed = F.transform(F.coalesce(categories, none), lambda x: F.concat(F.lit(CATEGORY_PREFIX), x))
    return F.concat(F.coalesce(keywords, none), prefixed)


def display_name(
    parts: Iterable[Column], keep_hybrid: bool = False, place_missing: bool = False, missing: str = MISSING
) -> Column:
    """Key parts joined by '·' without missing (and hybrid) ones."""
    skip = [missing, ""] if keep_hybrid else [missing, HYBRID, ""]
    trimmed = F.transform(F.array(*[col(p) for p in parts]), lambda p: stripped(p))
    return name_of(F.filter(trimmed, lambda p: p.isNotNull() & ~p.isin(*skip)), place_missing)


def key_name(key: str | Column, missing: str = MISSING) -> Column:
    """Display name of a merge-key array."""
    return name_of(F.filter(col(key), lambda p: ~stripped(p).isin(missing, HYBRID, "")))


def name_of(parts: Column, place_missing: bool = False) -> Column:
    joined = F.array_join(parts, NAME_SEPARATOR)
    if place_missing:
        return F.when(joined == "", F.lit(PLACE_MISSING_SUFFIX)).otherwise(
            F.concat(joined, F.lit(NAME_SEPARATOR + PLACE_MISSING_SUFFIX))
        )
    return F.when(joined == "", F.lit(OTHER_KEY)).otherwise(joined)


def ordered_name(values: str | Column, order: Iterable[str], default: str = "미분류") -> Column:
    """Map values in schema order joined by ' - '."""
    parts = [F.try_element_at(col(values), F.lit(name)) for name in order]
    joined = F.array_join(F.array_compact(F.array(*parts)), " - ")
    return F.when(joined == "", F.lit(default)).otherwise(joined)


def is_hybrid_key(key: str | Column) -> Column:
    """The first two parts of the segment key are both hybrid."""
    parts = F.split(col(key), NAME_SEPARATOR)
    return F.coalesce((F.get(parts, F.lit(0)) == HYBRID) & (F.get(parts, F.lit(1)) == HYBRID), F.lit(False))


def mentions_missing(key: str | Column, missing: str = MISSING) -> Column:
    return col(key).contains(missing)


def trim_evidence(evidence: str | Column, n: int = 200) -> Column:
    return F.transform_values(col(evidence), lambda _, v: F.substring(v, 1, n))
