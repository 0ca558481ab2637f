"""Joins and set operations on posting, category and assignment tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segloom.functions.text import all_signals, text_or_empty
from segloom.runtime import sized


def attach_categories(
    postings: DataFrame,
    bridge: DataFrame,
    dimension: DataFrame,
    key: str = "id",
    bridge_key: str = "job_posting_id",
    how: str = "left",
    distinct_pairs: bool = False,
) -> DataFrame:
    """Postings with their category names, ordered by category id; [] when there is none.

    Repeated (posting, category) pairs are counted before names are gathered, so
    a list never has more entries to sort than there are categories. With
    `distinct_pairs` the bridge has none, and no task holds its pairs for a count.
    """
    if distinct_pairs:
        counted = bridge.withColumn("_times", F.lit(1))
    else:
        counted = bridge.groupBy(bridge_key, "category_id").agg(F.count("*").cast("int").alias("_times"))
    # a shuffle by category would have as many parts as there are categories, and part the pairs of a posting again
    named = counted.join(sized(dimension), "category_id")
    lists = named.groupBy(F.col(bridge_key).alias(key)).agg(
        F.sort_array(F.collect_list(F.struct("category_id", "name", "_times"))).alias("_cats")
    )
    names = F.flatten(F.transform("_cats", lambda c: F.array_repeat(c["name"], c["_times"])))
    joined = postings.join(lists, key, how).withColumn(
        "categories", F.coalesce(names, F.array().cast("array<string>"))
    )
    return joined.drop("_cats")


def merge_phase1(phase1: DataFrame, categorised: DataFrame, key: str = "id") -> DataFrame:
    """Extraction rows that have a categorised posting, with the joint signal list."""
    joined = phase1.join(categorised, key)
    return joined.withColumn("all_signals", all_signals(F.col("keywords"), F.col("categories")))


def unmatched(left: DataFrame, right: DataFrame, key: str = "id") -> DataFrame:
    """Left rows without a partner (their count is the skip count of an inner merge)."""
    return left.join(right.select(key), key, "left_anti")


def map_lookup(df: DataFrame, dimension: DataFrame, key: str, value: str) -> DataFrame:
    """Rows whose key has a non-empty value in the dimension."""
    return df.join(dimension.select(key, value), key).filter(F.col(value).isNotNull() & (F.col(value) != ""))


def lookup_report(df: DataFrame, dimension: DataFrame, key: str, value: str) -> DataFrame:
    """Numbers of rows kept and dropped by `map_lookup`."""
    found = F.coalesce(F.col(value), F.lit("")) != ""
    return df.join(dimension.select(key, value), key, "left").agg(
        F.count_if(found).alias("n_mapped"), F.count_if(~found).alias("n_dropped")
    )


def join_labels_text(labels: DataFrame, texts: DataFrame, key: str = "id", text: str = "text") -> DataFrame:
    """All labels; a label without a text gets '' and is flagged."""
    joined = labels.join(texts.select(key, text, F.lit(True).alias("_found")), key, "left")
    return joined.withColumns(
        {text: text_or_empty(text), "text_found": F.coalesce("_found", F.lit(False))}
    ).drop("_found")


def join_attributes(assignments: DataFrame, attributes: DataFrame, key: str = "id", how: str = "inner") -> DataFrame:
    return assignments.join(attributes, key, how)


def pending(work: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    """Work rows without any result yet; failed results count as done."""
    return work.join(done.select(key), key, "left_anti")


def by_id_list(df: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    return df.join(ids.select(key), key, "left_semi")


def dedup_by_id(df: DataFrame, key: str, order: Iterable[str | Column]) -> DataFrame:
    """The first row per id in the given order.

    Spark keeps only the best row per id and task before the shuffle, so a key
    with very many copies does not meet in one task.
    """
    first = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("_rank", first).filter("_rank = 1").drop("_rank")


def union_cells(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def conflicts(categories: str | Column, listed: Iterable[str]) -> Column:
    """Whether the category list meets the listed ones."""
    values = F.array(*[F.lit(v) for v in listed])
    return F.coalesce(F.arrays_overlap(categories, values), F.lit(False))
