"""Predicates and scalar transforms on posting and attribute columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from segloom.config import (
    CELL,
    DENSITY_AXES,
    FULL_KEY,
    INFO_POOR_KEY,
    JOB_TYPES,
    MISSING,
    PARTIAL_KEY,
)

# Fixed value: the characters that count as white space around a text value.
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def stripped(c: str | Column) -> Column:
    return F.btrim(col(c), F.lit(SPACES))


def cell_slug(by: Iterable[str] = CELL) -> Column:
    return F.concat_ws("_", *by)


def active(deleted: str | Column = "is_deleted", expired: str | Column = "is_expired") -> Column:
    return (col(deleted) == 0) & (col(expired) == 0)


def eligible(since, created="created_at", content="content", min_len: int = 10, **flags) -> Column:
    """Active, created on or after `since`, and with more than `min_len` characters of text."""
    return (
        active(**flags)
        & (col(created) >= F.lit(since))
        & col(content).isNotNull()
        & (F.length(F.trim(col(content))) > min_len)
    )


def payment_group(payment: str | Column) -> Column:
    code = F.coalesce(col(payment).try_cast("int"), F.lit(0))
    return F.when(code == -2, "n2").when(code == -3, "n3").otherwise("pay")


def job_type_norm(c: str | Column, allowed: Iterable[str] = JOB_TYPES) -> Column:
    """Lower-cased type, '' when it is NULL or not an allowed one."""
    value = F.lower(stripped(c))
    return F.when(value.isin(*allowed), value).otherwise(F.lit(""))


def job_type_status(c: str | Column, allowed: Iterable[str] = JOB_TYPES) -> Column:
    return F.when(job_type_norm(c, allowed) == "", F.lit("invalid_recruit_type")).otherwise(F.lit("ok"))


def is_ok(c: str | Column = "ok", default: bool = True) -> Column:
    return F.coalesce(col(c), F.lit(default))


def is_missing(c: str | Column, missing: str = MISSING) -> Column:
    """NULL, NaN text or the sentinel; the empty string is an explicit value."""
    return col(c).isNull() | (stripped(c) == missing)


def is_explicit(c: str | Column, missing: str = MISSING) -> Column:
    return ~is_missing(c, missing)


def info_density(axes: Iterable[str] = DENSITY_AXES, missing: str = MISSING) -> Column:
    total = F.lit(0)
    for axis in axes:
        total = total + F.when(is_explicit(axis, missing), 1).otherwise(0)
    return total


def density_label(score: str | Column, poor_max: int = 1) -> Column:
    """Three bands; scores up to `poor_max` are the poor one."""
    value = col(score)
    return F.when(value <= poor_max, INFO_POOR_KEY).when(value <= 3, PARTIAL_KEY).otherwise(FULL_KEY)


def attrs_to_columns(attrs: str, names: Mapping[str, str], missing: str = MISSING) -> list[Column]:
    """One column per axis out of a map column; `names` maps axis -> map key."""
    return [
        F.coalesce(F.try_element_at(F.col(attrs), F.lit(key)), F.lit(missing)).alias(axis)
        for axis, key in names.items()
    ]


def in_domain(c: str | Column, domain: Iterable[str], missing: str = MISSING) -> Column:
    """The value when the domain lists it, otherwise the sentinel."""
    return F.when(col(c).isin(*domain), col(c)).otherwise(F.lit(missing))


def in_domain_or_last(c: str | Column, domain: list[str], missing: str = MISSING) -> Column:
    """Stripped value; outside the domain the sentinel if listed, else the last value."""
    value = stripped(F.coalesce(col(c), F.lit(missing)))
    return F.when(value.isin(*domain), value).otherwise(F.lit(missing if missing in domain else domain[-1]))


def normalize_map(attrs: str | Column, domain: Mapping[str, Iterable[str]], missing: str = MISSING) -> Column:
    """Map with exactly the domain's keys; values outside the domain become the sentinel."""
    pairs: list[Column] = []
    for name, values in domain.items():
        pairs += [F.lit(name), in_domain(F.try_element_at(col(attrs), F.lit(name)), values, missing)]
    return F.create_map(*pairs)


def record_is_valid(attrs: str | Column, domain: Mapping[str, Iterable[str]]) -> Column:
    """Every key is present with a value of its domain."""
    valid = col(attrs).isNotNull()
    for name, values in domain.items():
        valid = valid & F.coalesce(F.try_element_at(col(attrs), F.lit(name)).isin(*values), F.lit(False))
    return valid


def validated(attrs: str | Column, domain: Mapping[str, Iterable[str]]) -> Column:
    """The domain's keys of a valid record, an empty map otherwise."""
    pairs: list[Column] = []
    for name in domain:
        pairs += [F.lit(name), F.try_element_at(col(attrs), F.lit(name))]
    empty = F.create_map().cast("map<string,string>")
    return F.when(record_is_valid(attrs, domain), F.create_map(*pairs)).otherwise(empty)
