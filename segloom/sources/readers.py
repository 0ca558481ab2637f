"""Scans of posting tables, JSON lines and CSV files."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T



def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Projection to `names` (ours -> the source's), nothing else is read."""
    return df.select(*[F.col(source).alias(ours) for ours, source in names.items()])


def read_postings(spark: SparkSession, path: str, names: Mapping[str, str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return rename(df, names) if names else df


def read_postings_jdbc(
    spark: SparkSession, url: str, table: str, key: str, lower: int, upper: int, parts: int,
    names: Mapping[str, str] | None = None, **options,
) -> DataFrame:
    """Parallel scan of a database table, split on its integer key."""
    df = (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=key, lowerBound=lower, upperBound=upper, numPartitions=parts)
        .options(**options)
        .load()
    )
    return rename(df, names) if names else df


def read_jsonl(spark: SparkSession, path: str, schema, keep_corrupt: bool = False) -> DataFrame:
    """JSON lines; blank lines are skipped, broken ones dropped or kept in `_corrupt_record`."""
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    marked = T.StructType(fields.fields + [T.StructField("_corrupt_record", T.StringType())])
    df = spark.read.schema(marked).option("mode", "PERMISSIVE").json(path)
    return df if keep_corrupt else df.filter(F.col("_corrupt_record").isNull()).drop("_corrupt_record")


def read_csv(spark: SparkSession, path: str, schema, columns: Iterable[str] | None = None) -> DataFrame:
    """CSV with header; only `columns` are converted."""
    df = (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return df.select(*columns) if columns else df


def require_columns(df: DataFrame, columns: Iterable[str], what: str = "input") -> DataFrame:
    absent = sorted(set(columns) - set(df.columns))
    if absent:
        raise ValueError(f"{what} lacks the columns {absent}")
    return df


def read_assignments(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.parquet(path)
    return require_columns(df, ("id", "job_type", "payment_group", "segment_id", "segment_key"), "assignment table")


def fetch_texts(postings: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """Title and content of the ids that exist; NULL becomes ''."""
    wanted = ids.select(key)
    return postings.join(wanted, key, "left_semi").select(
        key, F.coalesce("title", F.lit("")).alias("title"), F.coalesce("content", F.lit("")).alias("content")
    )
