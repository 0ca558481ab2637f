"""Keyword and category signals: occurrences, frequencies, coverage of keyword clusters."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from segloom.config import CATEGORY_PREFIX, SIGNAL_SHARES
from segloom.functions.columns import stripped
from segloom.functions.text import DOMAINS, has_hangul
from segloom.runtime import beside

THRESHOLDS = SIGNAL_SHARES


def explode_keywords(df: DataFrame, keep: Iterable[str], keywords: str = "keywords") -> DataFrame:
    """One row per non-empty keyword occurrence."""
    return df.select(*keep, F.explode(keywords).alias("_raw")).select(*keep, stripped("_raw").alias("keyword")).filter("keyword <> ''")


def signal_freq(df: DataFrame, signals: str = "all_signals") -> DataFrame:
    """Occurrences per signal and their ratio to the number of postings."""
    # a NULL marker per posting counts the postings in the same pass
    marked = F.concat(F.array(F.lit(None).cast("string")), F.coalesce(F.col(signals), F.array().cast("array<string>")))
    return _with_share(df.select(F.explode(marked).alias("signal")).groupBy("signal").agg(F.count("*").alias("n")))


def _with_share(counts: DataFrame) -> DataFrame:
    posts = counts.filter("signal IS NULL").agg(F.max("n").alias("n_posts"))
    return beside(counts.filter("signal IS NOT NULL"), posts).withColumn("share", F.col("n") / F.col("n_posts"))


def canonical_map(norm: DataFrame) -> DataFrame:
    """Keyword map whose non-Hangul targets fall back to the keyword itself."""
    target = F.when(has_hangul("canonical"), F.col("canonical")).otherwise(F.col("keyword"))
    return norm.select("keyword", target.alias("canonical"))


def normalized_freq(freq: DataFrame, norm: DataFrame) -> DataFrame:
    """Frequencies after the keyword map; category signals and unmapped keywords stay.

    Works on the frequency table (one row per signal), not on occurrences.
    """
    mapped = freq.join(canonical_map(norm).withColumnRenamed("keyword", "signal"), "signal", "left")
    final = F.when(F.col("signal").startswith(CATEGORY_PREFIX), F.col("signal")).otherwise(
        F.coalesce("canonical", "signal")
    )
    return (
        mapped.groupBy(final.alias("signal"), "n_posts")
        .agg(F.sum("n").alias("n"))
        .withColumn("share", F.col("n") / F.col("n_posts"))
    )


def freq_candidates(freq: DataFrame, thresholds: Iterable[float] = THRESHOLDS) -> DataFrame:
    """Signals that reach each threshold (share of postings)."""
    levels = F.array(*[F.lit(float(t)) for t in thresholds])
    return freq.withColumn("threshold", F.explode(F.filter(levels, lambda t: F.col("n") >= F.col("n_posts") * t)))


def candidate_summary(candidates: DataFrame) -> DataFrame:
    is_category = F.col("signal").startswith(CATEGORY_PREFIX)
    return candidates.groupBy("threshold").agg(
        F.count("*").alias("n_signals"),
        F.count_if(~is_category).alias("n_keywords"),
        F.count_if(is_category).alias("n_categories"),
    )


def coverage_gates(
    clusters: DataFrame, occurrences: DataFrame, postings: DataFrame,
    min_keywords: int = 5, min_coverage: float = 0.05, max_share: float = 0.9, uneven: float = 0.15,
) -> DataFrame:
    """Gate figures per keyword cluster.

    `clusters` (keyword, cluster_id), `occurrences` (keyword, id, job_type), `postings` (id, job_type).
    Coverage counts distinct postings; dominance uses occurrences.
    """
    per_word = occurrences.groupBy("keyword").agg(F.count("*").alias("n"))
    shape = clusters.join(per_word, "keyword").groupBy("cluster_id").agg(
        F.count("*").alias("n_keywords"), (F.max("n") / F.sum("n")).alias("max_keyword_share")
    )
    hits = occurrences.join(clusters, "keyword").select("cluster_id", "id", "job_type").distinct()
    hit_counts = hits.groupBy("cluster_id", "job_type").agg(F.count("*").alias("hit"))
    totals = postings.groupBy("job_type").agg(F.count("*").alias("total"))
    types = beside(totals, totals.agg(F.sum("total").alias("all_posts"), F.count("*").alias("n_types")))
    rate = F.col("hit") / F.col("total")
    # a type without a hit has rate 0
    lowest = F.when(F.count("*") < F.max("n_types"), F.lit(0.0)).otherwise(F.min(rate))
    cover = hit_counts.join(types, "job_type").groupBy("cluster_id").agg(
        F.sum("hit").alias("n_hit"), (F.sum("hit") / F.max("all_posts")).alias("coverage"), (F.max(rate) - lowest).alias("spread")
    )
    noise, covered = F.col("n_keywords") < min_keywords, F.col("coverage") >= min_coverage
    varied = F.col("max_keyword_share") < max_share
    unequal = (F.col("spread") > uneven) & covered
    verdict = (
        F.when(noise, "noise").when(~covered, "coverage_low").when(~varied, "low_discrimination")
        .when(unequal, "type_imbalance").otherwise("pass")
    )
    return shape.join(cover, "cluster_id").withColumns(
        {"is_noise": noise, "coverage_ok": covered, "discriminative_ok": varied, "uneven": unequal, "verdict": verdict}
    )


def representative_keywords(clusters: DataFrame, occurrences: DataFrame, n: int = 10, exclude: Iterable[str] = DOMAINS) -> DataFrame:
    """The commonest keywords of each cluster."""
    words = clusters.filter(~F.col("keyword").isin(*exclude)) if exclude else clusters
    counts = occurrences.groupBy("keyword").agg(F.count("*").alias("n")).join(words, "keyword")
    order = Window.partitionBy("cluster_id").orderBy(F.desc("n"), "keyword")
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def dimension_summary(results: DataFrame) -> DataFrame:
    """Per threshold: kept (useful and not redundant) and removed dimensions.

    `results` (threshold, signal_count, dimensions array<struct<name, is_useful, is_redundant>>).
    """
    kept = F.filter("dimensions", lambda d: F.coalesce(d["is_useful"], F.lit(False)) & ~F.coalesce(d["is_redundant"], F.lit(False)))
    return results.select(
        "threshold", "signal_count", F.size(kept).alias("n_kept"), (F.size("dimensions") - F.size(kept)).alias("n_removed"),
        F.array_join(F.transform(kept, lambda d: d["name"]), ",").alias("kept_names"),
    )
