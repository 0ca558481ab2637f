"""Attributes whose presence depends on the job type."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segloom.config import MISSING, NOT_APPLICABLE


def typed_padding(df: DataFrame, defined: Mapping[str, Iterable[str]], job_type: str = "job_type") -> DataFrame:
    """Attributes a type lacks get the not-applicable mark; missing ones the sentinel.

    `defined` maps attribute -> job types whose schema has it.
    """
    return df.withColumns(
        {
            a: F.when(F.col(job_type).isin(*types), F.coalesce(F.col(a), F.lit(MISSING))).otherwise(F.lit(NOT_APPLICABLE))
            for a, types in defined.items()
        }
    )


def attribute_types(schema: Mapping) -> dict[str, list[str]]:
    """attribute -> job types, from a schema document with common and type-specific parts."""
    common = schema.get("common_attributes")
    specific = schema.get("type_specific") or {}
    if not isinstance(common, list) or not all(isinstance(v, list) for v in specific.values()):
        raise ValueError("common_attributes and each type_specific entry must be lists")
    out: dict[str, list[str]] = {}
    for job_type, extra in specific.items():
        for attribute in [*common, *extra]:
            if attribute.get("name"):
                out.setdefault(str(attribute["name"]), []).append(job_type)
    return dict(sorted(out.items()))


def attribute_values(spark: SparkSession, schema: Mapping) -> DataFrame:
    """(job_type, attr, value, ord) rows of a schema document."""
    rows = [
        (job_type, str(a["name"]), str(v), i)
        for job_type, extra in (schema.get("type_specific") or {}).items()
        for a in [*schema.get("common_attributes", []), *extra]
        if a.get("name")
        for i, v in enumerate(a.get("values") or [])
    ]
    return spark.createDataFrame(rows, "job_type string, attr string, value string, ord int")
