"""Top-n, ranks, queues and reproducible samples.

Samples are ordered by a hash of the id, so they do not depend on partitioning.
Exact quotas are met without sorting a whole stratum in one task (see `mark_quota`).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segloom.config import CELL
from segloom.functions.columns import active
from segloom.runtime import cut, sized

BUCKET_BITS = 14
HASH_BITS = 60


def top_n_per_group(df: DataFrame, by: Iterable[str], order: Iterable[str | Column], n: int) -> DataFrame:
    """First n rows per group; Spark drops the others per task before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("rank", rank).filter(F.col("rank") <= n)


def rank_by_size(segments: DataFrame, by: Iterable[str] = CELL, first: str = "first_cluster") -> DataFrame:
    """Ids 0.. by falling size; equal sizes keep the order of their first cluster."""
    order = Window.partitionBy(*by).orderBy(F.desc("n"), first)
    return segments.withColumn("segment_id", F.row_number().over(order) - 1)


def renumber(df: DataFrame, by: Iterable[str] = CELL, segment: str = "segment_id") -> DataFrame:
    """Dense ids 0.. in old order within each cell; -1 stays.

    The distinct ids are numbered, not the rows.
    """
    by = list(by)
    return df.join(sized(id_map(df, by, segment)), [*by, segment], "left").withColumn(
        segment, F.coalesce("_new", F.lit(-1))
    ).drop("_new")


def id_map(df: DataFrame, by: list[str], segment: str) -> DataFrame:
    ids = df.filter(F.col(segment) != -1).select(*by, segment).distinct()
    return ids.withColumn("_new", F.row_number().over(Window.partitionBy(*by).orderBy(segment)) - 1)


def largest_segments(df: DataFrame, n: int = 1, by: Iterable[str] = CELL, segment: str = "segment_id") -> DataFrame:
    """The n largest segments per cell with their share of the cell's rows (info-poor included)."""
    by = list(by)
    sizes = df.groupBy(*by, segment).agg(F.count("*").alias("n"), F.min("segment_key").alias("segment_key"))
    sizes = sizes.withColumn("pct", F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy(*by)))
    return top_n_per_group(sizes.filter(F.col(segment) != -1), by, [F.desc("n"), segment], n)


def queue(postings: DataFrame, limit: int | None = 500, key: str = "id") -> DataFrame:
    """Active postings without a segment, in id order."""
    waiting = postings.filter(active() & F.col("segment_id").isNull())
    return waiting if limit is None else waiting.orderBy(key).limit(limit)


def delta(df: DataFrame, by: Iterable[str], x: str, y: str) -> DataFrame:
    """y minus the previous y in x order (NULL for the first)."""
    return df.withColumn("delta", F.col(y) - F.lag(y).over(Window.partitionBy(*by).orderBy(x)))


def hash_order(key: str | Column, seed: int) -> Column:
    """60 bits of a digest of seed and key, as any engine can work them out."""
    column = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat_ws("-", F.lit(str(seed)), column.cast("string")))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def mark_quota(df: DataFrame, quotas: DataFrame, by: Iterable[str], key: str = "id", seed: int = 42, flag: str = "taken") -> DataFrame:
    """Flags exactly `quota` rows per group (or all, if fewer): the first in hash order.

    `quotas` has the group columns and `quota`; groups without a row get nothing.
    The last row to take is found among the rows of one hash bucket per group; the
    flag is then a comparison with it, and the rows themselves are not shuffled.
    """
    by = list(by)
    hashed = df.withColumn("_h", hash_order(key, seed))
    bucket = F.shiftright("_h", HASH_BITS - BUCKET_BITS)
    counts = hashed.groupBy(*by, bucket.alias("_b")).agg(F.count("*").alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(*by).orderBy("_b"))
    border = (
        counts.withColumn("_upto", upto)
        .join(quotas, by)
        .withColumn("_take", F.col("quota") - (F.col("_upto") - F.col("_n")))
        .filter("_take > 0")
        .groupBy(*by)
        .agg(F.max(F.struct("_b", F.least("_take", "_n").alias("_take"))).alias("_e"))
    )
    border = sized(border.select(*by, "_e._b", "_e._take"))
    inside = hashed.select(*by, key, "_h", bucket.alias("_b")).join(border, [*by, "_b"])
    rank = F.row_number().over(Window.partitionBy(*by).orderBy("_h", key))
    last = inside.withColumn("_r", rank).filter("_r = _take").select(*by, F.struct("_h", key).alias("_last"))
    joined = hashed.join(sized(last), by, "left")
    return joined.withColumn(flag, F.coalesce(F.struct("_h", key) <= F.col("_last"), F.lit(False))).drop("_h", "_last")


def take_quota(df: DataFrame, quotas: DataFrame, by: Iterable[str], key: str = "id", seed: int = 42) -> DataFrame:
    return mark_quota(df, quotas, by, key, seed).filter("taken").drop("taken")


def sample_n(df: DataFrame, n: int, key: str = "id", seed: int = 42) -> DataFrame:
    """Exactly n rows, the same ones however the data is partitioned."""
    one = df.withColumn("_one", F.lit(1))
    quota = df.sparkSession.range(1).select(F.lit(1).alias("_one"), F.lit(n).cast("long").alias("quota"))
    return take_quota(one, quota, ["_one"], key, seed).drop("_one")


def tercile_limits(df: DataFrame, by: Iterable[str], length: str) -> DataFrame:
    """33rd and 66th percentile (interpolated) per group; the maximum for fewer than 3 rows."""
    by = list(by)
    small = df.groupBy(*by, length).agg(F.count("*").alias("_n"))
    points = F.percentile(length, F.array(F.lit(1 / 3), F.lit(2 / 3)), F.col("_n"))
    out = small.groupBy(*by).agg(points.alias("_p"), F.max(length).cast("double").alias("_max"), F.sum("_n").alias("_rows"))
    few = F.col("_rows") < 3
    return out.select(
        *by,
        F.when(few, F.col("_max")).otherwise(F.col("_p")[0]).alias("p33"),
        F.when(few, F.col("_max")).otherwise(F.col("_p")[1]).alias("p66"),
    )


def tercile_bins(df: DataFrame, by: Iterable[str], length: str) -> DataFrame:
    by = list(by)
    joined = df.join(sized(tercile_limits(df, by, length)), by)
    size = F.when(F.col(length) <= F.col("p33"), "short").when(F.col(length) <= F.col("p66"), "medium").otherwise("long")
    return joined.withColumn("length_bin", size)


def stratified_sample(df: DataFrame, strata: DataFrame, by: Iterable[str], total: int, key: str = "id", seed: int = 42) -> DataFrame:
    """`total` rows spread evenly over the listed strata.

    `strata` has the group columns and `ord`; the first total % k of the k strata
    get one row more. What a small stratum lacks is filled from the other rows.
    """
    by = list(by)
    k = F.count("*").over(Window.partitionBy(F.lit(1)))  # the strata list is a handful of rows
    extra = F.when(F.col("ord") < F.lit(total) % F.col("_k"), 1).otherwise(0)
    quotas = strata.withColumn("_k", k).select(*by, (F.floor(F.lit(total) / F.col("_k")) + extra).cast("long").alias("quota"))
    marked = mark_quota(df, quotas, by, key, seed)
    lack = marked.agg((F.lit(total) - F.count_if("taken")).alias("quota")).withColumn("_one", F.lit(1))
    rest = marked.filter("NOT taken").drop("taken").withColumn("_one", F.lit(1))
    fill = take_quota(rest, lack, ["_one"], key, seed).drop("_one")
    return marked.filter("taken").drop("taken").unionByName(fill)


def split_train_test(df: DataFrame, label: str, by: Iterable[str] = (), key: str = "id", test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds `is_test`: a stratified share per class, unstratified where a class has one row.

    The test set has ceil(share * n) rows; classes get their rounded-down part,
    and those with the largest remainders one row more.
    """
    by = list(by)
    sizes = df.groupBy(*by, label).agg(F.count("*").alias("_n"))
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1))  # one row per class
    marks = sized(
        sizes.withColumn("_plain", F.min("_n").over(group) < 2).select(
            *by, label, "_n", F.when(F.col("_plain"), F.lit("")).otherwise(F.col(label).cast("string")).alias("_stratum")
        )
    )
    strata = marks.groupBy(*by, "_stratum").agg(F.sum("_n").alias("_n"))
    exact = F.round(F.col("_n") * test_share, 9)
    total = F.ceil(F.round(F.sum("_n").over(group) * test_share, 9))
    need = total - F.sum(F.floor(exact)).over(group)
    order = (group.orderBy(F.desc(exact - F.floor(exact)), "_stratum"))
    quotas = strata.withColumns({"_need": need, "_rank": F.row_number().over(order)}).select(
        *by, "_stratum", (F.floor(exact) + F.when(F.col("_rank") <= F.col("_need"), 1).otherwise(0)).alias("quota")
    )
    rows = df.join(marks.drop("_n"), [*by, label])
    return mark_quota(rows, quotas, [*by, "_stratum"], key, seed, "is_test").drop("_stratum")


def global_position(df: DataFrame, key: str, name: str = "position") -> DataFrame:
    """1-based position of each row in the order of its key, for keys of any spread.

    Rows are dealt into ranges with sampled bounds, of about equal size; a range
    starts after the rows of the lower ranges, so no task sees all rows.
    """
    ranged = cut(df.repartitionByRange(key).withColumn("_r", F.spark_partition_id()))
    sizes = ranged.groupBy("_r").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(F.lit(1)).orderBy("_r")) - F.col("_n")  # a row per range
    offsets = sized(sizes.select("_r", before.alias("_before")))
    rank = F.row_number().over(Window.partitionBy("_r").orderBy(key))
    return ranged.join(offsets, "_r").withColumn(name, F.col("_before") + rank).drop("_r", "_before")
