"""Connected components of a link table, by alternating stars over written tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segloom.runtime import cut, sized


def _sides(links: DataFrame) -> DataFrame:
    return links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _smallest(sides: DataFrame) -> DataFrame:
    """For every node the smallest of itself and the nodes beside it."""
    return sides.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of a link (columns a, b).

    Every round joins a node's links with the smallest node beside it (one row per
    node, so a hub's links may be split over tasks), first upward, then downward,
    until nothing changes: then every node hangs on its component's smallest.
    """
    tree = cut(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct())
    seen = None
    while True:
        state = tuple(tree.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == seen or not state[0]:
            break
        seen = state
        sides = _sides(tree)
        up = sides.join(_smallest(sides), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").distinct()
        low = up.groupBy("a").agg(F.min("b").alias("m"))
        down = up.join(low, "a").select(F.greatest("a", "m").alias("x"), F.col("b"), F.col("m"))
        hung = down.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        tree = cut(hung.unionAll(low.select("a", F.col("m").alias("b"))).where("a > b").distinct())
    roots = tree.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return tree.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots).distinct()


def extended(found: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, component) after further links (a, b), from those before, as a written table.

    The new links are taken between components, so that the rounds see the few
    components that they join and not the many nodes inside.
    """
    if found is None:
        return cut(components(links))
    of_a = found.select(F.col("node").alias("a"), F.col("component").alias("x"))
    of_b = found.select(F.col("node").alias("b"), F.col("component").alias("y"))
    between = links.join(of_a, "a", "left").join(of_b, "b", "left")
    between = between.select(F.coalesce("x", "a").alias("a"), F.coalesce("y", "b").alias("b")).where("a <> b").distinct()
    joined = cut(components(between))
    # A row per joined component, so it is broadcast if it is small, and no component's nodes meet in one task.
    moved = sized(joined.select(F.col("node").alias("component"), F.col("component").alias("to")))
    kept = found.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    return cut(kept.unionAll(joined.join(found, "node", "left_anti")))


def forest(i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Every end of a link with the smallest end it is connected with, which is fewer rows than there are ends."""
    ends, back = np.unique(np.concatenate([i, j]), return_inverse=True)
    i, j = back[: len(i)], back[len(i) :]
    root = np.arange(len(ends))
    while True:
        new = root.copy()
        np.minimum.at(new, i, root[j])
        np.minimum.at(new, j, root[i])
        new = new[new]
        if (new == root).all():
            break
        root = new
    moved = np.flatnonzero(root != np.arange(len(ends)))
    return np.column_stack([ends[moved], ends[root[moved]]])
