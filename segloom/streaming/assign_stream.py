"""Continuous assignment of arriving postings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from segloom.operators.assigning import assign_postings, failure_rows, only, update_rows
from segloom.operators.models import CellModels
from segloom.runtime import cut, scratch

# How long an id is remembered: a posting that comes again within this time is the same posting.
EXPIRY = "30 days"


def read_posting_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet", max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def append_once(batch: DataFrame, path: str, batch_id: int) -> None:
    """Write one micro-batch to its own folder; a replayed batch replaces itself."""
    writer = batch.withColumn("batch_id", F.lit(batch_id)).write.partitionBy("batch_id")
    writer.option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def read_sink(spark: SparkSession, path: str, schema, key: str = "id") -> DataFrame:
    """Assigned rows, one per id: the earliest batch that saw it."""
    rows = spark.read.schema(schema).option("basePath", path).parquet(path)
    first = rows.groupBy(key).agg(F.min("batch_id").alias("_b"))
    return rows.join(first, key).filter(F.col("batch_id") == F.col("_b")).drop("_b", "batch_id")


def first_seen(postings: DataFrame, key: str = "id", expiry: str = EXPIRY, arrived: Column | None = None) -> DataFrame:
    """Every posting whose id has not come within `expiry` before.

    The ids are state of the stream, kept by key in its checkpoint and dropped when
    they expire, so it grows with the arrivals of that time and not with the
    history. `arrived` is a time that does not fall from one batch to the next; by
    default it is the batch's own, so nothing is ever late.
    """
    timed = postings.withColumn("_arrived", F.current_timestamp() if arrived is None else arrived)
    return timed.withWatermark("_arrived", expiry).dropDuplicatesWithinWatermark([key]).drop("_arrived")


def assign_stream(
    postings: DataFrame, categorised: DataFrame, attributes: DataFrame, models: CellModels, catalog: DataFrame,
    path: str, checkpoint: str, key: str = "id", available_now: bool = True,
    after_batch: Callable[[DataFrame, int], None] | None = None, expiry: str = EXPIRY, arrived: Column | None = None,
) -> StreamingQuery:
    """Assign every arriving posting once.

    Ids that came before are left out by the stream's state (`first_seen`), so the
    sink is never read. Each micro-batch is the batch job on its rows: join the
    static category and attribute tables, correct, assign, write assignments and
    failures. A batch that is replayed after a failure gets the same rows from the
    state and overwrites its own folder.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        with scratch(batch.sparkSession):  # what a batch cuts is gone when it is written
            rows = cut(batch)
            posts = rows.join(only(categorised.select(key, "categories"), rows, key), key, "left")
            results = cut(assign_postings(posts, only(attributes, rows, key), models, catalog, key))
            append_once(update_rows(results, key), f"{path}/assigned", batch_id)
            append_once(failure_rows(results, key), f"{path}/failures", batch_id)
            if after_batch:
                after_batch(results, batch_id)

    fresh = first_seen(postings, key, expiry, arrived)
    writer = fresh.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
