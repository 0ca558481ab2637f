"""Batch assignment of queued postings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segloom.config import Gates
from segloom.functions.columns import job_type_norm, payment_group
from segloom.operators.models import CellModels, assign
from segloom.operators.ranking import queue
from segloom.operators.rules import DEFAULT_TIER, apply_rules
from segloom.runtime import cut, sized
from segloom.sources.sinks import merge_assignments


@dataclass
class BatchResult:
    results: DataFrame
    updates: DataFrame
    failures: DataFrame
    snapshot: DataFrame | None

    def summary(self, gates: Gates = Gates()) -> DataFrame:
        return batch_summary(self.results, gates)


def with_cell(postings: DataFrame, payment: str = "payment", job_type: str = "job_type") -> DataFrame:
    return postings.withColumns({"payment_group": payment_group(payment), "job_type": job_type_norm(job_type)})


def assign_postings(
    postings: DataFrame, attributes: DataFrame, models: CellModels, catalog: DataFrame, key: str = "id", tier: str = DEFAULT_TIER
) -> DataFrame:
    """Segment of each posting.

    `postings`: key, title, content, payment, job_type, categories. `attributes`:
    key, the model features and `ok`; a posting without attributes has failed.
    """
    found = attributes.withColumn("_found", F.coalesce(F.col("ok"), F.lit(True))).drop("ok")
    rows = with_cell(postings).join(found, key, "left").withColumn("_found", F.coalesce("_found", F.lit(False)))
    # the corrected axes are read twice below; the texts only here
    fixed = cut(apply_rules(rows, tier=tier).drop("title", "content"))
    return assign(fixed, models, catalog, ok="_found").drop("_found")


def batch_summary(results: DataFrame, gates: Gates = Gates()) -> DataFrame:
    """Counts of successes, failures, low-confidence and info-poor outcomes."""
    good = F.col("status").isin("ok", "info_poor", "no_rf_model")
    return results.agg(
        F.count_if(good).alias("n_success"),
        F.count_if(~good).alias("n_fail"),
        F.count_if((F.col("status") == "ok") & (F.col("confidence") < gates.low_confidence)).alias("n_low_confidence"),
        F.count_if(F.col("status") == "info_poor").alias("n_info_poor"),
    )


def update_rows(results: DataFrame, key: str = "id") -> DataFrame:
    """Rows to write back: those that have a segment."""
    return results.filter(F.col("segment_id").isNotNull()).select(
        key, "segment_id", "segment_version", F.col("confidence").cast("float").alias("segment_confidence")
    )


def failure_rows(results: DataFrame, key: str = "id") -> DataFrame:
    return results.filter(F.col("segment_id").isNull()).select(
        F.current_timestamp().alias("ts"), key, F.col("status").alias("reason"), "job_type", "payment_group"
    )


def only(static: DataFrame, waiting: DataFrame, key: str = "id") -> DataFrame:
    """Rows of a static table that the waiting ids need; the table is not shuffled for a short queue."""
    return static.join(sized(waiting.select(key).distinct()), key, "left_semi")


def batch_assign(
    table: DataFrame, categorised: DataFrame, attributes: DataFrame, models: CellModels, catalog: DataFrame,
    limit: int | None = 500, key: str = "id", write_back: bool = True,
) -> BatchResult:
    """Assign the queue of `table` and return results, updates, failures and the new snapshot.

    `categorised` gives the category list per id. `limit=None` takes the whole queue.
    """
    waiting = cut(queue(table, limit, key).select(key, "title", "content", "payment", "job_type"))
    posts = waiting.join(only(categorised.select(key, "categories"), waiting, key), key, "left")
    results = cut(assign_postings(posts, only(attributes, waiting, key), models, catalog, key))
    updates = update_rows(results, key)
    snapshot = merge_assignments(table, updates, key) if write_back else None
    return BatchResult(results, updates, failure_rows(results, key), snapshot)
