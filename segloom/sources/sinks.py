"""Assignment tables: columns, upsert, update plan, writers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from segloom.config import CELL
from segloom.runtime import beside, cut

# Folders of a bucketed table: an update of some hundred ids touches as many of them at most.
BUCKETS = 1024

ASSIGNMENT_COLUMNS = {
    "segment_id": "int",
    "segment_version": "string",
    "segment_confidence": "float",
    "segment_assigned_at": "timestamp",
}


def ensure_columns(df: DataFrame, specs: Mapping[str, str] = ASSIGNMENT_COLUMNS) -> DataFrame:
    """Add the columns that are absent, as NULLs."""
    absent = {n: F.lit(None).cast(t) for n, t in specs.items() if n not in df.columns}
    return df.withColumns(absent) if absent else df


def merge_assignments(target: DataFrame, updates: DataFrame, key: str = "id", at: Column | None = None) -> DataFrame:
    """New snapshot of `target` with the updated ids' assignment replaced.

    `updates` holds at most one row per id with segment_id, segment_version and
    segment_confidence; other rows and columns stay as they are.
    """
    base = ensure_columns(target)
    stamp = F.current_timestamp() if at is None else at
    new = updates.select(
        key,
        F.struct(
            F.col("segment_id").cast("int").alias("segment_id"),
            F.col("segment_version"),
            F.col("segment_confidence").cast("float").alias("segment_confidence"),
            stamp.cast("timestamp").alias("segment_assigned_at"),
        ).alias("_new"),
    )
    old = F.struct(*[F.col(n).cast(t).alias(n) for n, t in ASSIGNMENT_COLUMNS.items()])
    joined = base.join(new, key, "left").withColumn("_new", F.coalesce("_new", old))
    return joined.withColumns({n: F.col(f"_new.{n}") for n in ASSIGNMENT_COLUMNS}).drop("_new")


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def write_bucketed(df: DataFrame, path: str, key: str = "id", buckets: int = BUCKETS) -> None:
    """The table, with the assignment columns, as one folder per bucket of the key's hash."""
    dealt = ensure_columns(df).withColumn("bucket", bucket_of(key, buckets)).repartition("bucket")
    dealt.write.mode("overwrite").partitionBy("bucket").parquet(path)


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("bucket")


def merge_into(spark: SparkSession, path: str, updates: DataFrame, key: str = "id", at: Column | None = None, buckets: int = BUCKETS) -> list[int]:
    """`merge_assignments` on a bucketed table in place; returns the buckets that were rewritten.

    Only buckets that hold an updated id are read and replaced. The merged rows are
    written aside first, so a failure before the replacement changes nothing; after
    a failure during it, the same call with the same `at` gives the same table, as
    it sets values and adds none. Ids that the table does not have are ignored.
    """
    updates = cut(updates)
    touched = sorted(r[0] for r in updates.select(bucket_of(key, buckets)).distinct().collect())  # `buckets` at most
    if not touched:
        return []
    table = spark.read.parquet(path).filter(F.col("bucket").isin(*touched))
    merged = cut(merge_assignments(table, updates, key, at))
    writer = merged.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("bucket").parquet(path)
    return touched


def update_plan(rows: DataFrame, labels: DataFrame, key: str = "id") -> DataFrame:
    """Each row with its label, and whether it would be updated or skipped."""
    return rows.join(labels, key, "left").withColumn(
        "action", F.when(F.col("segment_id").isNull(), "skip").otherwise("update")
    )


def update_summary(plan: DataFrame, key: str = "id", samples: int = 3) -> DataFrame:
    """Counts of the plan and its first rows (by id) as `id:segment` pairs."""
    counts = plan.agg(
        F.count_if(F.col("action") == "update").alias("n_update"),
        F.count_if(F.col("action") == "skip").alias("n_skipped"),
    )
    pair = F.struct(F.col(key), F.concat_ws(":", F.col(key), F.col("segment_id")).alias("pair"))
    first = plan.filter("action = 'update'").orderBy(key).limit(samples)
    shown = first.agg(F.array_join(F.transform(F.sort_array(F.collect_list(pair)), lambda x: x["pair"]), ",").alias("sample"))
    return beside(counts, shown)


def write_assignments(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet") -> None:
    """One folder per cell; a hot cell is spread over several files."""
    df.write.mode(mode).partitionBy(*CELL).option("header", True).format(fmt).save(path)


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_jdbc(df: DataFrame, url: str, table: str, batch: int = 1000, mode: str = "append", **options) -> None:
    df.write.format("jdbc").mode(mode).options(url=url, dbtable=table, batchsize=batch).options(**options).save()
