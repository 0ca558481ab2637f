"""Segments out of clusters: merge by dominant key, absorb, split, rename.

All functions take rows or, with `weight`, a compressed table (see stats.compress).
Steps that look at rows several times work on the compressed table in both cases:
rows are read once to build it and once to receive the new segments.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segloom.config import (
    CELL,
    HYBRID,
    INFO_POOR_ID,
    INFO_POOR_KEY,
    KEY_AXES,
    MISSING,
    NAME_SEPARATOR,
    PLACE_MISSING_SUFFIX,
    SegmentConfig,
)
from segloom.functions.text import display_name, key_name
from segloom.operators.ranking import id_map, rank_by_size
from segloom.operators.rules import PORTFOLIO, SNAP
from segloom.operators.stats import compress, dominants
from segloom.runtime import beside, cut, sized

UNNAMED = (HYBRID, MISSING)


def treatment_counts(enabled: bool = True, job_type: str = "job_type") -> Column:
    """Whether the treatment is part of the key: never for photo."""
    return F.lit(enabled) & (F.col(job_type) != "photo")


def _explicit(axis: str) -> Column:
    return F.when(~F.col(f"dom_{axis}").isin(*UNNAMED), F.col(f"dom_{axis}"))


def _tail(with_treatment: Column) -> list[Column]:
    return [F.when(with_treatment, _explicit("treatment")), _explicit("career"), _explicit("continuity")]


def merge_key(with_treatment: Column) -> Column:
    """purpose, place, topic, then the explicit treatment, career and continuity."""
    head = [F.col("dom_purpose"), F.col("dom_place"), F.col("dom_topic")]
    return F.array_compact(F.array(*head, *_tail(with_treatment)))


def coarse_key(with_treatment: Column) -> Column:
    """The merge key without a hybrid or missing topic."""
    head = [F.col("dom_purpose"), F.col("dom_place"), _explicit("topic")]
    return F.array_compact(F.array(*head, *_tail(with_treatment)))


KeyFunction = Callable[[Column], Column]


def through_table(df: DataFrame, by: Sequence[str], step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Rows with the segments that `step` gives to their compressed table."""
    keys = list(dict.fromkeys([*by, "segment_id", "segment_key", *KEY_AXES]))
    table = cut(compress(df, [], keys).withColumns({"_old_id": F.col("segment_id"), "_old_key": F.col("segment_key")}))
    new = step(table).select(
        *[F.col({"segment_id": "_old_id", "segment_key": "_old_key"}.get(k, k)).alias(f"_t_{k}") for k in keys],
        F.col("segment_id").alias("_new_id"), F.col("segment_key").alias("_new_key"),
    )
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_t_{k}"))
    joined = df.join(sized(new), same)
    return joined.withColumns({"segment_id": F.col("_new_id"), "segment_key": F.col("_new_key")}).select(*df.columns)


def cluster_info(
    df: DataFrame, label: str, by: Sequence[str] = CELL, threshold: float = 0.70, with_treatment: bool = True,
    weight: str | None = None,
) -> DataFrame:
    """Per cluster (-1 skipped): rows, six dominants, merge key and coarse key."""
    use = treatment_counts(with_treatment) if "job_type" in by else F.lit(with_treatment)
    info = dominants(df.filter(F.col(label) != INFO_POOR_ID), [*by, label], KEY_AXES, threshold, weight=weight)
    return info.withColumns({"merge_key": merge_key(use), "coarse_key": coarse_key(use)})


def absorb_small(segments: DataFrame, by: Sequence[str] = CELL, min_size: int | Column = 10) -> DataFrame:
    """Adds `into`: the `first_cluster` of the segment that finally holds each segment.

    Segments below `min_size` join, smallest first, the segment whose key agrees
    in most positions (then the larger, then the earlier one), again and again
    until all are large enough or one is left. The outcome depends on the order of
    these steps, so a cell's list of distinct keys (not its rows) is one task.
    """
    types = dict(segments.dtypes)
    schema = ", ".join([*[f"{n} {types[n]}" for n in by], f"first_cluster {types['first_cluster']}", f"into {types['first_cluster']}"])

    def settle(cell: pd.DataFrame) -> pd.DataFrame:
        cell = cell.sort_values("first_cluster", ignore_index=True)
        keys = [tuple(k) for k in cell["merge_key"]]
        alike = np.array([[sum(p == q for p, q in zip(a, b)) for b in keys] for a in keys])
        size, least = cell["n"].to_numpy().copy(), cell["_least"].iloc[0]
        into = np.arange(len(cell))
        alive = np.ones(len(cell), bool)
        moved = True
        while moved:
            moved = False
            small = np.flatnonzero(alive & (size < least))
            for i in small[np.argsort(size[small], kind="stable")]:
                if size[i] >= least or alive.sum() == 1:
                    continue
                alive[i] = False
                others = np.flatnonzero(alive)
                target = others[np.lexsort((others, -size[others], -alike[i, others]))[0]]
                size[target] += size[i]
                into[into == i] = target
                moved = True
        out = cell[[*by, "first_cluster"]].copy()
        out["into"] = cell["first_cluster"].to_numpy()[into]
        return out

    wanted = segments.select(*by, "first_cluster", "merge_key", "n", F.lit(min_size).cast("long").alias("_least"))
    return segments.join(wanted.groupBy(*by).applyInPandas(settle, schema), [*by, "first_cluster"])


def merged_segments(
    info: DataFrame, label: str, key: str = "merge_key", by: Sequence[str] = CELL, absorb: bool = True, min_size: int = 10
) -> DataFrame:
    """Per cluster: the id and name of its segment (see `merge_by_key`)."""
    by = list(by)
    group = info.groupBy(*by, F.col(key).alias("merge_key"))
    segments = group.agg(F.sum("n").alias("n"), F.min(label).alias("first_cluster"))
    keyed = absorb_small(segments, by, min_size) if absorb else segments.withColumn("into", F.col("first_cluster"))
    keyed = sized(keyed)
    totals = keyed.groupBy(*by, F.col("into").alias("first_cluster")).agg(F.sum("n").alias("n"))
    names = keyed.select(*by, "first_cluster", key_name("merge_key").alias("segment_key"))
    numbered = rank_by_size(totals.join(names, [*by, "first_cluster"]), by)
    final = numbered.select(*by, F.col("first_cluster").alias("into"), "segment_id", "segment_key")
    members = keyed.select(*by, "merge_key", "into").join(final, [*by, "into"]).drop("into")
    return info.select(*by, label, F.col(key).alias("merge_key")).join(members, [*by, "merge_key"]).drop("merge_key")


def merge_by_key(
    df: DataFrame,
    label: str,
    key: str | KeyFunction = "merge_key",
    by: Sequence[str] = CELL,
    threshold: float = 0.70,
    with_treatment: bool = True,
    absorb: bool = True,
    min_size: int = 10,
    weight: str | None = None,
) -> DataFrame:
    """Clusters with an equal key become one segment, numbered by falling size.

    `key` is 'merge_key', 'coarse_key' or a function from the treatment switch to
    an array column over the dominants. Label -1 stays the info-poor segment.
    """
    by = list(by)
    info = cluster_info(df, label, by, threshold, with_treatment, weight)
    if callable(key):
        info, key = info.withColumn("_key", key(treatment_counts(with_treatment))), "_key"
    members = sized(merged_segments(sized(info), label, key, by, absorb, min_size))
    joined = df.drop("segment_id", "segment_key").join(members, [*by, label], "left")
    return joined.withColumns(
        {
            "segment_id": F.coalesce("segment_id", F.lit(INFO_POOR_ID)),
            "segment_key": F.coalesce("segment_key", F.lit(INFO_POOR_KEY)),
        }
    )


def second_pass(df: DataFrame, config: SegmentConfig, by: Sequence[str] = CELL, weight: str | None = None) -> DataFrame:
    """Merge the segments once more by the coarse key, always with the default minimum size."""
    staged = df.withColumnRenamed("segment_id", "_stage")
    return merge_by_key(
        staged, "_stage", "coarse_key", by, config.dominant_threshold, config.treatment_in_key, config.absorb_small, weight=weight
    ).drop("_stage")


def absorb_ambiguous(df: DataFrame, by: Sequence[str] = CELL, threshold: float = 0.70, weight: str | None = None) -> DataFrame:
    """Segments whose purpose and place are both hybrid or missing become info-poor."""
    by = list(by)
    if weight is None:
        return through_table(df, by, lambda table: absorb_ambiguous(table, by, threshold, "n"))
    doms = dominants(df.filter("segment_id <> -1"), [*by, "segment_id"], ("purpose", "place"), threshold, weight=weight)
    vague = F.col("dom_purpose").isin(*UNNAMED) & F.col("dom_place").isin(*UNNAMED)
    kept = doms.select(*by, "segment_id", vague.alias("_vague"))
    hit = F.max(F.col("_vague").cast("int")).over(Window.partitionBy(*by)) == 1
    rank = F.row_number().over(Window.partitionBy(*by, "_vague").orderBy("segment_id")) - 1
    new = F.when(F.col("_vague"), F.lit(INFO_POOR_ID)).when(hit, rank).otherwise(F.col("segment_id"))
    joined = df.join(sized(kept.select(*by, "segment_id", "_vague", new.alias("_new"))), [*by, "segment_id"], "left")
    return joined.withColumns(
        {
            "segment_key": F.when(F.col("_vague"), F.lit(INFO_POOR_KEY)).otherwise(F.col("segment_key")),
            "segment_id": F.coalesce("_new", "segment_id"),
        }
    ).drop("_new", "_vague")


def absorbed_count(before: DataFrame, after: DataFrame, weight: str | None = None) -> DataFrame:
    size = F.col(weight) if weight else F.lit(1)

    def poor(df, name):
        return df.agg(F.sum(F.when(F.col("segment_id") == -1, size).otherwise(0)).alias(name))

    return beside(poor(before, "b"), poor(after, "a")).select((F.col("a") - F.col("b")).alias("n_absorbed"))


def display_names(df: DataFrame, by: Sequence[str], weight: str | None = None, threshold: float = 0.70) -> DataFrame:
    """Names of groups from their dominants: the plain one and the one for a missing place."""
    doms = dominants(df, by, KEY_AXES, threshold, weight=weight)
    plain = key_name(merge_key(treatment_counts()))
    no_place = display_name([F.col("dom_purpose"), F.col("dom_topic")], keep_hybrid=True, place_missing=True)
    return doms.select(*by, "n", plain.alias("_name"), no_place.alias("_name_no_place"))


def split_candidates(
    df: DataFrame, part: Column, by: Sequence[str], config: SegmentConfig, weight: str | None, how: str
) -> DataFrame:
    """Segments to split with the id of the new part, and the size of both parts."""
    by = list(by)
    size = F.col(weight) if weight else F.lit(1)
    rows = df.filter("segment_id <> -1")
    counts = rows.groupBy(*by, "segment_id").agg(
        F.sum(F.when(part, size).otherwise(0)).alias("n_b"), F.min("segment_key").alias("original_name")
    )
    doms = dominants(rows, [*by, "segment_id"], ("purpose", "place", "topic"), weight=weight)
    table = doms.join(counts, [*by, "segment_id"]).withColumn("n_a", F.col("n") - F.col("n_b"))
    large = F.col("n") >= config.split_min_segment
    if how == "place":
        fits = (
            large
            & (F.col("n_b") / F.col("n") >= config.split_min_missing_ratio)
            & (F.col("n_b") >= config.split_part_min_size)
            & (F.col("dom_place") != HYBRID)
        )
    else:
        fits = (
            large
            & (F.col("n_a") / F.col("n") >= config.split_min_portfolio_ratio)
            & (F.col("n_a") >= config.split_part_min_size)
            & (F.col("n_b") >= config.split_part_min_size)
            & (F.col("dom_purpose") != PORTFOLIO)
        )
        if config.split_requires_snap:
            fits = fits & (F.col("dom_topic") == SNAP)
    last = F.max("segment_id").over(Window.partitionBy(*by))
    table = table.withColumn("_last", last).filter(fits)
    order = Window.partitionBy(*by).orderBy("segment_id")
    return table.select(
        *by, "segment_id", "original_name", F.col("n").alias("total"), "n_a", "n_b",
        (F.col("_last") + F.row_number().over(order)).cast("int").alias("_new"),
    )


def _split(df: DataFrame, part: Column, by: Sequence[str], config: SegmentConfig, weight: str | None, how: str) -> tuple[DataFrame, DataFrame]:
    by = list(by)
    if weight is None:
        logs: list[DataFrame] = []

        def step(table: DataFrame) -> DataFrame:
            out, log = _split(table, part, by, config, "n", how)
            logs.append(log)
            return out

        return through_table(df, by, step), logs[0]
    chosen = sized(split_candidates(df, part, by, config, weight, how))
    marked = df.withColumn("_part", part)
    inside = marked.join(chosen.select(*by, "segment_id"), [*by, "segment_id"])
    names = display_names(inside, [*by, "segment_id", "_part"], weight)
    name = F.when(F.col("_part"), F.col("_name_no_place")).otherwise(F.col("_name")) if how == "place" else F.col("_name")
    table = names.join(chosen, [*by, "segment_id"]).select(
        *by, "segment_id", "_part", name.alias("_key"), F.when(F.col("_part"), F.col("_new")).otherwise(F.col("segment_id")).alias("_id")
    )
    out = marked.join(sized(table), [*by, "segment_id", "_part"], "left")
    out = out.withColumns(
        {"segment_key": F.coalesce("_key", "segment_key"), "segment_id": F.coalesce("_id", "segment_id")}
    ).drop("_part", "_key", "_id")
    ids = sized(id_map(out, by, "segment_id"))
    out = out.join(ids, [*by, "segment_id"], "left").withColumn("segment_id", F.coalesce("_new", "segment_id")).drop("_new")
    sides = table.groupBy(*by, F.col("segment_id")).agg(
        F.max(F.when(~F.col("_part"), F.col("_key"))).alias("name_a"), F.max(F.when(F.col("_part"), F.col("_key"))).alias("name_b")
    )
    log = chosen.drop("_new").join(sides, [*by, "segment_id"]).select(
        *by, "original_name", "total", F.coalesce("name_a", F.lit("기타")).alias("name_a"), "n_a", "name_b", "n_b"
    )
    return out, log


def split_by_place(df: DataFrame, config: SegmentConfig = SegmentConfig(), by: Sequence[str] = CELL, weight: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Large segments with many missing places: those rows become a segment of their own.

    Returns the rows and the split log.
    """
    return _split(df, F.coalesce(F.col("place") == MISSING, F.lit(False)), by, config, weight, "place")


def split_by_purpose(df: DataFrame, config: SegmentConfig = SegmentConfig(), by: Sequence[str] = CELL, weight: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Large segments with many portfolio rows: the other rows become a segment of their own."""
    return _split(df, F.coalesce(F.col("purpose") != PORTFOLIO, F.lit(True)), by, config, weight, "purpose")


def rename_segments(df: DataFrame, by: Sequence[str] = CELL, threshold: float = 0.70, weight: str | None = None) -> DataFrame:
    """Names recomputed from the dominants; place-missing parts keep their suffix."""
    by = list(by)
    if weight is None:
        return through_table(df, by, lambda table: rename_segments(table, by, threshold, "n"))
    rows = df.filter("segment_id <> -1")
    current = rows.groupBy(*by, "segment_id").agg(F.min("segment_key").alias("_current"))
    names = display_names(rows, [*by, "segment_id"], weight, threshold).join(current, [*by, "segment_id"])
    suffix = F.col("_current").endswith(NAME_SEPARATOR + PLACE_MISSING_SUFFIX)
    table = names.select(*by, "segment_id", F.when(suffix, F.col("_name_no_place")).otherwise(F.col("_name")).alias("_key"))
    return df.join(sized(table), [*by, "segment_id"], "left").withColumn("segment_key", F.coalesce("_key", "segment_key")).drop("_key")


def postprocess(df: DataFrame, config: SegmentConfig, by: Sequence[str] = CELL, weight: str | None = None) -> tuple[DataFrame, list[DataFrame]]:
    """The optional steps in fixed order; returns rows and split logs."""
    logs: list[DataFrame] = []

    def steps(table: DataFrame) -> DataFrame:
        size = weight or "n"
        if config.absorb_ambiguous:
            table = cut(absorb_ambiguous(table, by, weight=size))
        if config.place_split:
            table, log = split_by_place(table, config, by, size)
            table = cut(table)
            logs.append(log.withColumn("split", F.lit("place")))
        if config.purpose_split:
            table, log = split_by_purpose(table, config, by, size)
            table = cut(table)
            logs.append(log.withColumn("split", F.lit("purpose")))
        return rename_segments(table, by, weight=size) if config.rename else table

    out = steps(df) if weight else through_table(df, by, steps)
    return out, logs


def key_similarity(a: str, b: str) -> Column:
    """Number of positions in which two key arrays agree."""
    pairs = F.zip_with(F.slice(a, 1, F.least(F.size(a), F.size(b))), F.slice(b, 1, F.least(F.size(a), F.size(b))), lambda x, y: x == y)
    return F.size(F.filter(pairs, lambda p: p))


def union_all(parts: Iterable[DataFrame]) -> DataFrame | None:
    out = None
    for part in parts:
        out = part if out is None else out.unionByName(part)
    return out
