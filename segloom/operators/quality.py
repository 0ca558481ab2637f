"""Grades, acceptance gates and differences between assignments."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segloom.config import CELL, FOCUS_CELL, INFO_POOR_ID, INFO_POOR_KEY, SMALL_CELLS, Gates
from segloom.functions.columns import cell_slug
from segloom.functions.text import preview
from segloom.operators.ranking import top_n_per_group
from segloom.operators.stats import catalogue_metrics
from segloom.runtime import beside



def grade(segments: DataFrame, gates: Gates = Gates(), small_cells: Iterable[str] = SMALL_CELLS, segment: str = "segment_id") -> DataFrame:
    """Adds grade (A-D) and flags to the rows of `stats.segment_table`."""
    poor = (F.col(segment) == INFO_POOR_ID) | (F.col("segment_key") == INFO_POOR_KEY)
    small = cell_slug().isin(*small_cells)
    micro = F.col("n") < gates.micro_n
    catch_all = F.col("pct_cell") > gates.catch_all_pct
    uniform = (F.col("purpose_top") >= gates.dominant) | (F.col("topic_top") >= gates.dominant)
    top = (F.col("n") >= gates.a_min_n) & (F.col("pct_cell") <= gates.a_max_pct) & uniform
    flags = (
        F.when(poor, F.array(F.lit("info_poor")))
        .when(small, F.array(F.lit("small_cell")))
        .otherwise(F.array_compact(F.array(F.when(micro, F.lit("micro")), F.when(catch_all, F.lit("catch_all")))))
    )
    mark = F.when(poor | small, "D").when(micro | catch_all, "C").when(top, "A").otherwise("B")
    return segments.withColumns({"grade": mark, "flags": flags})


def stop_check(graded: DataFrame, gates: Gates = Gates(), focus: str = FOCUS_CELL) -> DataFrame:
    """One row: the figures, the six gates and whether all of them hold."""
    metrics = catalogue_metrics(graded, gates, focus)
    op = F.col("segment_id") != INFO_POOR_ID
    counts = graded.agg(
        F.count_if(op & (cell_slug() == focus) & (F.col("grade") == "A")).alias("focus_a"),
        F.count_if(op & F.col("grade").isin("A", "B")).alias("_ab"),
        F.count_if(op).alias("_op"),
    )
    ab = F.when(F.col("_op") > 0, F.col("_ab") * 100.0 / F.col("_op")).otherwise(F.lit(0.0))
    row = beside(metrics, counts).withColumn("ab_pct", ab)
    checks = {
        "ok_focus_max": F.col("focus_max_pct") <= gates.focus_max_pct,
        "ok_focus_a": F.col("focus_a") >= gates.focus_a_min,
        "ok_micro": F.col("n_micro") <= gates.micro_max,
        "ok_catch_all": F.col("catch_all_cells") <= gates.catch_all_max,
        "ok_poor": F.col("n_poor") <= gates.poor_max,
        "ok_ab": F.col("ab_pct") >= gates.ab_pct_min,
    }
    passed = F.lit(True)
    for check in checks:
        passed = passed & F.col(check)
    return row.withColumns(checks).withColumn("passed", passed).drop("_ab", "_op")


def grade_distribution(graded: DataFrame, by: Iterable[str] = CELL) -> DataFrame:
    """Operational segments per grade, one column each."""
    return graded.filter(F.col("segment_id") != INFO_POOR_ID).groupBy(*by).agg(
        *[F.count_if(F.col("grade") == g).alias(f"n_{g.lower()}") for g in "ABCD"]
    )


def weak_segments(graded: DataFrame) -> DataFrame:
    """Operational segments graded C or D, largest first."""
    weak = graded.filter((F.col("segment_id") != INFO_POOR_ID) & F.col("grade").isin("C", "D"))
    return weak.orderBy(F.desc("n"), "grade", *CELL, "segment_id")


def assignment_moves(a: DataFrame, b: DataFrame, ids: DataFrame | None = None, key: str = "id") -> DataFrame:
    """Rows present in both assignments with the outcome same / moved / info-poor destination.

    Moves compare segment ids; only for info-poor destinations the keys.
    """
    left = a.select(key, F.col("segment_id").alias("src_id"), F.col("segment_key").alias("src_key"))
    right = b.select(key, F.col("segment_id").alias("dst_id"), F.col("segment_key").alias("dst_key"))
    if ids is not None:
        left = left.join(ids.select(key), key, "left_semi")
    poor = F.col("dst_id") == INFO_POOR_ID
    moved = F.when(poor, F.col("src_key") != F.col("dst_key")).otherwise(F.col("src_id") != F.col("dst_id"))
    return left.join(right, key).withColumns({"to_info_poor": poor, "moved": moved})


def move_summary(moves: DataFrame) -> DataFrame:
    return moves.agg(
        F.count_if(~F.col("moved")).alias("n_same"),
        F.count_if("moved").alias("n_moved"),
        F.count_if("to_info_poor").alias("n_info_poor"),
    )


def move_pairs(moves: DataFrame, n: int | None = None) -> DataFrame:
    """Moved rows per (source key, destination key), the commonest first."""
    pairs = moves.filter("moved").groupBy("src_key", "dst_key").agg(F.count("*").alias("n"))
    return pairs.orderBy(F.desc("n"), "src_key", "dst_key").limit(n) if n else pairs


def move_ends(moves: DataFrame) -> DataFrame:
    """Rows per key as source and as destination."""
    small = moves.groupBy("src_key", "dst_key").agg(F.count("*").alias("n"))
    ends = F.array(
        F.struct(F.lit("source").alias("side"), F.col("src_key").alias("segment_key")),
        F.struct(F.lit("destination").alias("side"), F.col("dst_key").alias("segment_key")),
    )
    return small.select("n", F.inline(ends)).groupBy("side", "segment_key").agg(F.sum("n").alias("n"))


def move_examples(moves: DataFrame, texts: DataFrame, n: int = 3, key: str = "id", chars: int = 100) -> DataFrame:
    """First n moved ids per pair with a text preview; texts are joined to these only."""
    first = top_n_per_group(moves.filter("moved"), ["src_key", "dst_key"], [key], n)
    return first.join(texts.select(key, preview("text", chars).alias("preview")), key, "left")


def agreement(assigned: DataFrame, predicted: DataFrame, key: str = "id") -> DataFrame:
    """Agreement of predicted and assigned segments per cell and overall (cell NULL).

    `predicted`: id, status, predicted_id. Info-poor predictions are counted apart.
    """
    joined = assigned.join(predicted, key).groupBy(cell_slug().alias("cell"), "status", "segment_id", "predicted_id").agg(F.count("*").alias("n"))
    judged = (F.col("status") == "ok") & (F.col("segment_id") != INFO_POOR_ID)
    poor = F.col("status") == "info_poor"

    def total(cond):
        return F.sum(F.when(cond, F.col("n")).otherwise(0))

    out = joined.groupingSets([[F.col("cell")], []], "cell").agg(
        total(judged).alias("n_judged"),
        total(judged & (F.col("segment_id") == F.col("predicted_id"))).alias("n_match"),
        total(poor).alias("n_poor"),
        total(poor & (F.col("segment_id") == INFO_POOR_ID)).alias("n_poor_match"),
    )
    return out.withColumns(
        {
            "match_pct": F.col("n_match") * 100.0 / F.greatest("n_judged", F.lit(1)),
            "poor_match_pct": F.col("n_poor_match") * 100.0 / F.greatest("n_poor", F.lit(1)),
        }
    )
