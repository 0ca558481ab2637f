"""The catalogue build: rows -> profiles -> clusters -> segments -> rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segloom.config import (
    CELL,
    DEFAULT_CONFIG,
    DENSITY_AXES,
    JOB_TYPES,
    MISSING,
    NAME_SEPARATOR,
    PAYMENT_GROUPS,
    SINGLE_ROW_KEY,
    SINGLE_SEGMENT_CELL,
    SegmentConfig,
)
from segloom.functions.columns import cell_slug, density_label, info_density, is_missing
from segloom.operators import distance, linkage, merge, stats
from segloom.operators.rules import TIERS, tier_figures, tier_rows
from segloom.runtime import cut, sized


@dataclass
class Tree:
    """Merge tree of the weighted profiles, reusable for any number of clusters."""

    points: DataFrame
    profiles: DataFrame
    merges: DataFrame


def clean_axes(df: DataFrame, config: SegmentConfig = DEFAULT_CONFIG) -> DataFrame:
    return df.withColumns({a: F.when(is_missing(a), MISSING).otherwise(F.col(a)) for a in config.axes})


def catalogue_table(df: DataFrame, config: SegmentConfig = DEFAULT_CONFIG, by: Sequence[str] = CELL, weight: str | None = None) -> DataFrame:
    """Distinct axis tuples per cell with counts; its size does not grow with the rows."""
    cells = df.filter(F.col("job_type").isin(*JOB_TYPES) & F.col("payment_group").isin(*PAYMENT_GROUPS))
    small = stats.compress(clean_axes(cells, config), by, config.axes, weight)
    return cut(small.withColumn("info_density", info_density(DENSITY_AXES)))


def build_tree(
    table: DataFrame, config: SegmentConfig = DEFAULT_CONFIG, block: int = 1024, by: Sequence[str] = CELL,
    weights: Mapping[str, Sequence[float]] | None = None,
) -> Tree:
    """Average linkage over the clusterable profiles of all cells.

    With `weights` (name -> distance weights of the axes with a weight) there is a tree per cell
    and name, in the column `tree`, all of them built in the same rounds.
    """
    by = list(by)
    names, own = distance.weighted_axes(config.axes, config.gower_weights)
    usable = table.filter((F.col("info_density") >= 1) & (cell_slug() != SINGLE_SEGMENT_CELL))
    small = usable.groupBy(*by, *names).agg(F.sum("n").alias("n"))
    if weights is not None:
        small = small.withColumn("tree", F.explode(F.array(*[F.lit(t) for t in weights])))
        by = ["tree", *by]
    order = F.row_number().over(Window.partitionBy(*by).orderBy(*names))
    small = cut(small.withColumn("id", (order - 1).cast("long")))
    codes, sizes = distance.value_codes(small, names)
    counted = distance.profile_counts(small, names, cut(codes), sizes)
    points = counted.select(*by, "id", F.col("n").cast("double").alias("size"), "slots", "amounts")
    if weights is None:
        form = distance.GowerForm(sizes, own)
    else:
        form = distance.FormPerGroup("tree", {t: distance.GowerForm(sizes, w) for t, w in weights.items()})
    merges = linkage.average_linkage(points, by, form, block=block)
    return Tree(small.select(*by, "id", "n"), small, merges)


def segment_counts(tree: Tree, config: SegmentConfig, by: Sequence[str] = CELL, target: Column | None = None) -> DataFrame:
    """Number of raw clusters per cell: the target, at most one per profile; `k_capped` tells where that binds."""
    cells = tree.points.groupBy(*by).agg(F.sum("n").alias("rows"), F.count("*").alias("p"))
    k = distance.target_raw_k(cell_slug(), F.col("rows"), config) if target is None else target
    cells = cells.withColumn("raw_k", k).withColumn("k", F.least("raw_k", F.col("p").cast("int")))
    return cells.withColumn("k_capped", F.col("k") < F.col("raw_k"))


def label_table(table: DataFrame, tree: Tree, config: SegmentConfig, by: Sequence[str] = CELL, target: Column | None = None) -> DataFrame:
    """The catalogue table with raw cluster labels (-1 info-poor)."""
    by = list(by)
    names, _ = distance.weighted_axes(config.axes, config.gower_weights)
    ks = segment_counts(tree, config, by, target)
    clusters = linkage.cut_tree(tree.points, tree.merges, by, ks.select(*by, "k"))
    labels = tree.profiles.join(clusters, [*by, "id"]).select(*by, *names, F.col("cluster").alias("raw_cluster_id"))
    joined = table.join(labels, [*by, *names], "left")
    raw = F.when(F.col("info_density") < 1, -1).when(cell_slug() == SINGLE_SEGMENT_CELL, 0).otherwise(F.col("raw_cluster_id"))
    return cut(joined.withColumn("raw_cluster_id", raw.cast("int")))


def segment_labeled(labeled: DataFrame, config: SegmentConfig, by: Sequence[str] = CELL) -> tuple[DataFrame, list[DataFrame], DataFrame]:
    """Segments of a labelled catalogue table; also split logs and the stage-1 table.

    Numbers of the configuration may be columns over `by`.
    """
    by = list(by)
    first = merge.merge_by_key(
        labeled, "raw_cluster_id", "merge_key", by, config.dominant_threshold, config.treatment_in_key,
        config.absorb_small, config.min_segment_size, weight="n",
    )
    # a cell with a single clusterable row is named after that row
    lone = labeled.filter("raw_cluster_id <> -1").groupBy(*by).agg(F.sum("n").alias("_rows"))
    lone = lone.filter((F.col("_rows") == 1) & (cell_slug() != SINGLE_SEGMENT_CELL)).select(*by, F.lit(True).alias("_lone"))
    row_name = F.when(F.col("purpose") == MISSING, SINGLE_ROW_KEY).otherwise(
        F.concat_ws(NAME_SEPARATOR, "purpose", "place", "topic")
    )
    first = first.join(sized(lone), by, "left")
    named = F.col("_lone") & (F.col("raw_cluster_id") != -1)
    first = cut(first.withColumn("segment_key", F.when(named, row_name).otherwise(F.col("segment_key"))).drop("_lone"))
    out = merge.second_pass(first, config, by, weight="n") if config.coarse_merge else first
    out, logs = merge.postprocess(out, config, by, weight="n")
    return cut(out), logs, first


def cell_results(table: DataFrame, tree: Tree, first: DataFrame, final: DataFrame, config: SegmentConfig) -> DataFrame:
    """Per cell: rows, info-poor, target K and whether it is capped, raw clusters, segments after merge 1 and at the end."""
    after = first.filter("segment_id <> -1").groupBy(*CELL).agg(F.countDistinct("segment_id").alias("n_after_merge"))
    ks = segment_counts(tree, config).select(*CELL, "raw_k", "k_capped")
    base = stats.cell_summary(final, weight="n")
    return base.join(after, [*CELL], "left").join(ks, [*CELL], "left").withColumns(
        {
            "raw_k": F.coalesce("raw_k", F.when(cell_slug() == SINGLE_SEGMENT_CELL, 1).otherwise(0)),
            "k_capped": F.coalesce("k_capped", F.lit(False)),
        }
    )


def assign_rows(df: DataFrame, final: DataFrame, config: SegmentConfig = DEFAULT_CONFIG) -> DataFrame:
    """Rows of the nine cells with density, raw cluster and segment."""
    cells = clean_axes(df.filter(F.col("job_type").isin(*JOB_TYPES) & F.col("payment_group").isin(*PAYMENT_GROUPS)), config)
    lookup = final.select(*CELL, *config.axes, "info_density", "raw_cluster_id", "segment_id", "segment_key")
    return cells.join(sized(lookup), [*CELL, *config.axes]).withColumn("density_label", density_label("info_density", 0))


@dataclass
class Catalogue:
    rows: DataFrame
    table: DataFrame
    cells: DataFrame
    logs: DataFrame | None


def build_catalogue(df: DataFrame, config: SegmentConfig = DEFAULT_CONFIG, block: int = 1024) -> Catalogue:
    """All cells in one plan.

    `df`: one row per posting with the cell columns and the axes (rules applied).
    Rows are read twice: once to compress them, once to receive their segment.
    """
    table = catalogue_table(df, config)
    tree = build_tree(table, config, block)
    final, logs, first = segment_labeled(label_table(table, tree, config), config)
    return Catalogue(
        assign_rows(df, final, config), final, cell_results(table, tree, first, final, config), merge.union_all(logs)
    )


# What decides which steps run; everything else may differ within one plan.
STEPS = ("coarse_merge", "absorb_small", "absorb_ambiguous", "place_split", "purpose_split", "rename", "split_requires_snap")
NUMBERS = (
    "treatment_in_key", "dominant_threshold", "min_segment_size", "split_min_segment", "split_min_missing_ratio",
    "split_part_min_size", "split_min_portfolio_ratio",
)


def per_variant(configs: Mapping[str, SegmentConfig], value: Callable[[SegmentConfig], object], column: str = "variant") -> Column:
    """The value of each row's variant."""
    out = None
    for name, config in configs.items():
        here = F.col(column) == name
        out = F.when(here, value(config)) if out is None else out.when(here, value(config))
    return out


def joint_config(configs: Mapping[str, SegmentConfig]) -> SegmentConfig:
    """One configuration for variants with the same steps, whose numbers are columns over `variant` where they differ."""
    first = next(iter(configs.values()))
    differing = {n: per_variant(configs, lambda c, n=n: getattr(c, n)) for n in NUMBERS if len({getattr(c, n) for c in configs.values()}) > 1}
    return replace(first, **differing)


def variant_segments(table: DataFrame, configs: Mapping[str, SegmentConfig]) -> DataFrame:
    """The catalogue table per variant, with its segments.

    All distance weights have their trees built in the same rounds, all variants
    are cut, labelled and merged as groups of one plan; variants that take other
    steps (a coarse merge, splits) take them side by side.
    """
    weights = {c.gower_weights: f"w{i}" for i, c in enumerate(configs.values())}
    base = next(iter(configs.values()))
    names, _ = distance.weighted_axes(base.axes, base.gower_weights)
    if any(distance.weighted_axes(c.axes, c.gower_weights)[0] != names for c in configs.values()):
        raise ValueError("variants must weight the same axes")
    trees = build_tree(table, base, weights={t: distance.weighted_axes(base.axes, w)[1] for w, t in weights.items()})
    by = ["variant", *CELL]
    of = F.broadcast(table.sparkSession.createDataFrame([(v, weights[c.gower_weights]) for v, c in configs.items()], "variant string, tree string"))

    def spread(df: DataFrame) -> DataFrame:
        return cut(df.join(of, "tree").drop("tree"))

    tree = Tree(spread(trees.points), spread(trees.profiles), spread(trees.merges))
    target = per_variant(configs, lambda c: distance.target_raw_k(cell_slug(), F.col("rows"), c))
    everyone = table.withColumn("variant", F.explode(F.array(*[F.lit(v) for v in configs])))
    labeled = label_table(everyone, tree, base, by, target)
    alike: dict[tuple, dict[str, SegmentConfig]] = {}
    for name, config in configs.items():
        alike.setdefault(tuple(getattr(config, step) for step in STEPS), {})[name] = config
    parts = [segment_labeled(labeled.filter(F.col("variant").isin(*some)), joint_config(some), by)[0] for some in alike.values()]
    return merge.union_all(parts)


def variant_grid(df: DataFrame, configs: Mapping[str, SegmentConfig]) -> DataFrame:
    """Catalogue figures of each variant, from one build of all of them."""
    final = variant_segments(catalogue_table(df, next(iter(configs.values()))), configs)
    figures = stats.catalogue_metrics(stats.segment_table(final, by=["variant", *CELL], weight="n"), by=["variant"])
    pure = stats.purity(final, weight="n", over=["variant"]).select("variant", "purity")
    return figures.join(pure, "variant")


def tier_grid(df: DataFrame, tiers: Iterable[str] = TIERS, config: SegmentConfig = DEFAULT_CONFIG, **names) -> DataFrame:
    """Figures before clustering and of the catalogue under each tier of the snap rule.

    `df`: uncorrected axes with categories, title and content. The texts are read
    once; the tiers are groups of one build.
    """
    by = ["tier", *CELL]
    rows = cut(tier_rows(df, tiers, [*CELL, *config.axes], **names))
    table = catalogue_table(rows, config, by, "n")
    final, _, _ = segment_labeled(label_table(table, build_tree(table, config, by=by), config, by), config, by)
    after = stats.catalogue_metrics(stats.segment_table(final, by=by, weight="n"), by=["tier"])
    return tier_figures(rows).join(after.withColumnRenamed("n_poor", "n_poor_after"), "tier")


def best_variant(grid: DataFrame) -> DataFrame:
    """The variant with the highest purity; fewer segments, then the name break ties."""
    order = F.struct(F.col("purity"), -F.col("n_segments"))
    return grid.groupBy().agg(F.max_by("variant", order).alias("variant"), F.max("purity").alias("purity"))
