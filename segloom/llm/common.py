"""What several operators share: registration, bindings inside expressions, order without a single task."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from segloom.runtime import cut

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: Words are maximal runs without space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: Column) -> Column:
    return F.filter(F.split(text, GAP), lambda w: w != "")


def row_key(*columns: str) -> Column:
    """64 bits for the given columns' values, nulls included."""
    parts = []
    for name in columns:
        parts += [F.col(name).isNull(), F.col(name)]
    return F.xxhash64(*parts)


def ranged(df: DataFrame, *order: str) -> DataFrame:
    """Rows in `_range`s that follow each other in the given order (nulls first), as a written table.

    Bounds are sampled, so ranges are even for any distribution of ids; a
    window over one range is bounded, and there are as many ranges as shuffle
    partitions.
    """
    return cut(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))


def successors(df: DataFrame, order: list[str], give: list[str]) -> DataFrame:
    """Every row with `next_<c>` and `prev_<c>` for c in `give`, around the ends, without a window over all rows."""
    rows = ranged(df, *order)
    inside = Window.partitionBy("_range").orderBy(*order)
    row = F.struct(*give)
    placed = rows.withColumns({"_next": F.lead(row).over(inside), "_prev": F.lag(row).over(inside)})
    # One row per range: its first and last row's neighbours are found among these.
    key = F.struct(*order)
    ends = rows.groupBy("_range").agg(F.min_by(row, key).alias("_first"), F.max_by(row, key).alias("_last"))
    chain = Window.partitionBy(F.lit(0)).orderBy("_range")  # a row per range
    whole = chain.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select(
        "_range",
        F.coalesce(F.lead("_first").over(chain), F.first("_first").over(whole)).alias("_after"),
        F.coalesce(F.lag("_last").over(chain), F.last("_last").over(whole)).alias("_before"),
    )
    found = placed.join(F.broadcast(ends), "_range")
    out = {}
    for name in give:
        out[f"next_{name}"] = F.when(F.col("_next").isNull(), F.col(f"_after.{name}")).otherwise(F.col(f"_next.{name}"))
        out[f"prev_{name}"] = F.when(F.col("_prev").isNull(), F.col(f"_before.{name}")).otherwise(F.col(f"_prev.{name}"))
    return found.withColumns(out).drop("_range", "_next", "_prev", "_after", "_before")


def running_start(df: DataFrame, group: str, order: list[str], value: str) -> DataFrame:
    """Adds `start`: the sum of `value` over the earlier rows of the group, without a window over a whole group."""
    rows = ranged(df, group, *order)
    before = Window.partitionBy("_range", group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("_range", F.col(group).alias("_group")).agg(F.sum(value).alias("_sum"))
    # A row per range and group: as many rows as ranges and groups together.
    earlier = Window.partitionBy("_group").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("_range").alias("_r"), "_group", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"))
    placed = rows.withColumn("_in", F.coalesce(F.sum(value).over(before), F.lit(0)))
    same = (F.col("_range") == F.col("_r")) & F.col(group).eqNullSafe(F.col("_group"))
    return placed.join(parts, same).withColumn("start", F.col("_base") + F.col("_in")).drop("_range", "_r", "_group", "_base", "_in")
