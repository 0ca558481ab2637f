"""Density clusters (HDBSCAN*) of profiles.

Rows of one profile coincide, so core distances and sizes use the row counts.
Edges of equal weight are removed together, as in the published definition; the
result does not depend on the order of ties.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from segloom.config import CELL, MISSING, SINGLE_SEGMENT_CELL
from segloom.functions.columns import cell_slug
from segloom.operators.blocks import BLOCK, over_block_pairs
from segloom.operators.components import components
from segloom.operators.distance import onehot_square
from segloom.operators.kmeans import numbered
from segloom.operators.stats import compress
from segloom.runtime import cut, sized

# Smallest cluster per cell.
MIN_CLUSTER_SIZE = {
    "model_n2": 50,
    "model_n3": 20,
    "model_pay": 30,
    "beauty_n2": 25,
    "beauty_n3": 15,
    "beauty_pay": 10,
    "photo_n2": 20,
    "photo_pay": 10,
}


def core_squares(points: DataFrame, by: Sequence[str], axes: Sequence[str], drop_missing: bool = True, block: int = BLOCK) -> DataFrame:
    """Adds `core`: the squared distance within which a point has `min_samples` rows, itself included."""
    by, axes = list(by), list(axes)

    def reduce(rows, others):
        square = onehot_square(rows, others, axes, drop_missing).astype(int)
        n = others["n"].to_numpy(dtype=float)
        parts = []
        for level in np.unique(square):
            part = rows[[*by, "pid"]].copy()
            part["level"], part["rows"] = int(level), (square == level) @ n
            parts.append(part[part["rows"] > 0])
        return pd.concat(parts)

    types = dict(points.dtypes)
    schema = ", ".join([*[f"{n} {types[n]}" for n in [*by, "pid"]], "level int", "rows double"])
    levels = over_block_pairs(points, by, "pid", reduce, schema, block).groupBy(*by, "pid", "level").agg(F.sum("rows").alias("rows"))
    reach = F.sum("rows").over(Window.partitionBy(*by, "pid").orderBy("level"))
    within = levels.withColumn("reach", reach).join(points.select(*by, "pid", "min_samples"), [*by, "pid"])
    core = within.filter(F.col("reach") >= F.col("min_samples")).groupBy(*by, "pid").agg(F.min("level").alias("core"))
    return points.join(core, [*by, "pid"])


def spanning_tree(points: DataFrame, by: Sequence[str], axes: Sequence[str], drop_missing: bool = True, block: int = BLOCK) -> DataFrame:
    """Minimum spanning tree (by, a, b, level) of the mutual reachability distance.

    In each round every component takes its lightest outgoing edge, in the order
    (level, lo, hi), and components joined by these edges become one.
    """
    by, axes = list(by), list(axes)
    types = dict(points.dtypes)
    keys = ", ".join(f"{n} {types[n]}" for n in by)

    def lightest(rows, others):
        level = onehot_square(rows, others, axes, drop_missing)
        level = np.maximum(np.maximum(level, rows["core"].to_numpy()[:, None]), others["core"].to_numpy()[None, :])
        level[rows["comp"].to_numpy()[:, None] == others["comp"].to_numpy()[None, :]] = np.inf
        p, q = rows["pid"].to_numpy()[:, None], others["pid"].to_numpy()[None, :]
        # among equal levels the pair with the smallest (lo, hi)
        rank = np.where(level == level.min(axis=1, keepdims=True), np.minimum(p, q) * (2.0**31) + np.maximum(p, q), np.inf)
        best = rank.argmin(axis=1)
        out = rows[[*by, "comp"]].copy()
        out["level"] = level[np.arange(len(rows)), best]
        out["a"], out["b"] = np.minimum(p[:, 0], q[0, best]), np.maximum(p[:, 0], q[0, best])
        out["other"] = others["comp"].to_numpy()[best]
        return out[np.isfinite(out["level"])]

    schema = f"{keys}, comp int, level double, a int, b int, other int"
    state = cut(points.withColumn("comp", F.col("pid")))
    tree = None
    while True:
        chosen = over_block_pairs(state, by, "pid", lightest, schema, block)
        edges = cut(chosen.groupBy(*by, "comp").agg(F.min(F.struct("level", "a", "b", "other")).alias("e")))
        if edges.isEmpty():
            return tree
        picked = edges.select(*by, "e.a", "e.b", F.col("e.level").cast("int").alias("level")).distinct()
        tree = picked if tree is None else tree.unionByName(picked)
        # each component hooks on to the one it chose; of a mutual pair the smaller is the root
        hooks = edges.select(*by, "comp", F.col("e.other").alias("up"))
        back = hooks.select(*by, F.col("comp").alias("up"), F.col("up").alias("_back"))
        hooks = hooks.join(back, [*by, "up"]).select(
            *by, "comp", F.when((F.col("_back") == F.col("comp")) & (F.col("comp") < F.col("up")), F.col("comp")).otherwise(F.col("up")).alias("up")
        )
        hooks = cut(hooks)
        while True:
            over = hooks.select(*by, F.col("comp").alias("up"), F.col("up").alias("_up"))
            jumped = cut(hooks.join(over, [*by, "up"]))
            if jumped.filter("up <> _up").isEmpty():
                break
            hooks = jumped.select(*by, "comp", F.col("_up").alias("up"))
        state = cut(state.join(sized(hooks), [*by, "comp"], "left").withColumn("comp", F.coalesce("up", "comp")).drop("up"))


def _lambda(level: int) -> float:
    return float("inf") if level == 0 else level**-0.5


def stable_clusters(nodes: DataFrame, tree: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, pid, cluster): clusters by excess of mass, noise as -1, from nodes (by, pid, n, core, mcs) and tree (by, a, b, level).

    Levels rise one after another (squared distances are whole numbers, at most
    two per axis, so there are few). At each one nodes enter at their core level
    and the tree's links of that level join components. A component of `mcs`
    rows or more that holds no such component from below begins a cluster; one
    that holds a single one goes on with its cluster; one that holds several ends
    them and begins their parent. Sums per component give an ended cluster's
    stability; it is chosen unless the best clusters inside it are together more
    stable, and then all rows of its component take its number, over what they
    had from below. So the last one chosen is the outermost. The cluster of the
    whole cell never ends.
    """
    by = list(by)
    place = [*by, "comp"]
    levels = sorted({r[0] for r in tree.select("level").distinct().collect()} | {r[0] for r in nodes.select("core").distinct().collect()})
    points = nodes.withColumns({"comp": F.col("pid"), "label": F.lit(-1)})
    comps: DataFrame | None = None
    for level in levels:
        fall = F.lit(_lambda(level))
        new = nodes.filter(F.col("core") == level)
        zero = F.lit(0.0)
        entered = new.select(*by, F.col("pid").alias("comp"), F.col("n").cast("double").alias("size"), "mcs", F.lit(False).alias("big"), zero.alias("gone"), zero.alias("mass"), zero.alias("inside"))
        comps = entered if comps is None else comps.unionByName(entered)
        of = points.select(*by, "pid", "comp")
        links = tree.filter(F.col("level") == level).select(*by, "a", "b")
        for end in ("a", "b"):
            links = links.join(of.select(*by, F.col("pid").alias(end), F.col("comp").alias(f"_{end}")), [*by, end])
        joined = components(links.select(*by, F.col("_a").alias("a"), F.col("_b").alias("b")), by)
        comps = comps.join(joined.withColumnRenamed("node", "comp"), place, "left").withColumn("root", F.coalesce("root", "comp"))

        def of_big(value):
            return F.sum(F.when(F.col("big"), value).otherwise(0.0))

        # What a cluster that ends here is worth, and whether it is chosen over those inside it.
        stability = F.when(F.col("mass") > 0, F.col("gone") - F.col("mass") * fall).otherwise(0.0)
        best = F.greatest(stability, F.col("inside"))
        held = comps.groupBy(*by, "root").agg(
            F.sum("size").alias("size"),
            F.max("mcs").alias("mcs"),
            F.count_if("big").alias("_n"),
            of_big(F.col("size")).alias("_size"),
            of_big(F.col("gone")).alias("_gone"),
            of_big(F.col("mass")).alias("_mass"),
            of_big(F.col("inside")).alias("_inside"),
            of_big(best).alias("_best"),
        )
        held = cut(held)
        ended = comps.filter("big").join(held.filter("_n > 1").select(*by, "root"), [*by, "root"], "left_semi")
        chosen = ended.filter(~(F.col("inside") > stability)).select(*place, F.lit(True).alias("chosen"))
        moved = joined.select(*by, F.col("node").alias("comp"), "root")
        points = points.join(chosen, place, "left").join(moved, place, "left")
        points = cut(
            points.withColumns(
                {"label": F.when(F.col("chosen"), F.col("comp")).otherwise(F.col("label")), "comp": F.coalesce("root", "comp")}
            ).drop("chosen", "root")
        )
        one, big = F.col("_n") == 1, F.col("size") >= F.col("mcs")
        leaves = F.col("size") - F.when(one, F.col("_size")).otherwise(0.0)
        lost = F.when(leaves > 0, leaves * fall).otherwise(0.0)
        comps = held.select(
            *by, F.col("root").alias("comp"), "size", "mcs", big.alias("big"),
            F.when(big, F.when(one, F.col("_gone")).otherwise(0.0) + lost).otherwise(0.0).alias("gone"),
            F.when(big, F.when(one, F.col("_mass")).otherwise(0.0) + leaves).otherwise(0.0).alias("mass"),
            F.when(one, F.col("_inside")).when(F.col("_n") > 1, F.col("_best")).otherwise(0.0).alias("inside"),
        )
    # A cluster's label is its smallest pid; the numbers follow it, from 0 in each cell.
    found = points.filter("label >= 0").select(*by, "label").distinct()
    found = found.withColumn("cluster", F.row_number().over(Window.partitionBy(*by).orderBy("label")) - 1)  # a row per cluster
    return points.join(found, [*by, "label"], "left").select(*by, "pid", F.coalesce("cluster", F.lit(-1)).alias("cluster"))


def density_clusters(
    df: DataFrame, axes: Sequence[str], by: Sequence[str] = CELL, min_sizes: dict[str, int] = MIN_CLUSTER_SIZE,
    default_size: int = 10, drop_missing: bool = True, block: int = BLOCK,
) -> DataFrame:
    """Label per profile (by, axes, n, cluster); -1 is noise.

    Cells with fewer rows than the smallest cluster, or without any explicit
    value, are all noise; the single-segment cell is one cluster.
    """
    by, axes = list(by), list(axes)
    slug = cell_slug(by)
    size = F.lit(default_size)
    for cell, n in min_sizes.items():
        size = F.when(slug == cell, n).otherwise(size)
    explicit = F.greatest(*[F.when(F.col(a) != MISSING, 1).otherwise(0) for a in axes]) if len(axes) > 1 else F.lit(1)
    points = numbered(compress(df, by, axes), by, axes).withColumn("mcs", size)
    points = points.withColumn("min_samples", F.greatest(F.lit(1), F.floor(F.col("mcs") / 2)).cast("int"))
    cell = Window.partitionBy(*by)  # over profiles, not rows
    points = cut(
        points.withColumns({"_rows": F.sum("n").over(cell), "_any": F.max(explicit).over(cell)}).withColumn(
            "mode",
            F.when(slug == SINGLE_SEGMENT_CELL, "single").when((F.col("_rows") < F.col("mcs")) | (F.col("_any") == 0), "noise").otherwise("fit"),
        )
    )
    fit = cut(core_squares(points.filter("mode = 'fit'").select(*by, "pid", *axes, "n", "mcs", "min_samples"), by, axes, drop_missing, block))
    tree = spanning_tree(fit, by, axes, drop_missing, block)
    labels = None if tree is None else stable_clusters(fit.select(*by, "pid", "n", "core", "mcs"), cut(tree), by)
    out = points.select(*by, *axes, "pid", "n", "mode")
    out = out.join(labels, [*by, "pid"], "left") if labels is not None else out.withColumn("cluster", F.lit(None).cast("int"))
    return out.withColumn("cluster", F.when(F.col("mode") == "single", 0).otherwise(F.coalesce("cluster", F.lit(-1)))).drop("mode")


def density_summary(labels: DataFrame, by: Sequence[str] = CELL) -> DataFrame:
    """Per cell: rows, clusters, noise rows and share, smallest / median / largest cluster."""
    by = list(by)
    sizes = labels.groupBy(*by, "cluster").agg(F.sum("n").alias("size"))
    real = F.col("cluster") != -1
    return sizes.groupBy(*by).agg(
        F.sum("size").alias("n_rows"),
        F.count_if(real).alias("n_clusters"),
        F.sum(F.when(~real, F.col("size")).otherwise(0)).alias("n_noise"),
        (F.sum(F.when(~real, F.col("size")).otherwise(0)) * 100.0 / F.sum("size")).alias("noise_pct"),
        F.min(F.when(real, F.col("size"))).alias("min_size"),
        F.percentile(F.when(real, F.col("size")), 0.5).alias("median_size"),
        F.max(F.when(real, F.col("size"))).alias("max_size"),
    )
