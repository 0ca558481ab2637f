"""Connected components of a link table per group, by stars over written tables."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segloom.runtime import cut


def smallest_linked(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """The smallest node that each of n nodes is connected with by the links i - j."""
    root = np.arange(n)
    while True:
        new = root.copy()
        np.minimum.at(new, i, root[j])
        np.minimum.at(new, j, root[i])
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _contracted(links: DataFrame, by: list[str]) -> DataFrame:
    """The links of each partition as stars: every node hangs on the smallest node it is connected with there."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [b for b in batches if len(b)]  # one partition of links
        if not held:
            return
        whole = pd.concat(held, ignore_index=True)
        for _, rows in whole.groupby(by, sort=False, dropna=False):
            nodes, place = np.unique(rows[["a", "b"]].to_numpy(), return_inverse=True)
            place = place.reshape(-1, 2)
            root = smallest_linked(place[:, 0], place[:, 1], len(nodes))
            moved = np.flatnonzero(root != np.arange(len(nodes)))
            out = pd.DataFrame({"a": nodes[moved], "b": nodes[root[moved]]})
            for name in by:
                out[name] = rows[name].iloc[0]
            yield out

    types = dict(links.dtypes)
    return links.select(*by, "a", "b").mapInPandas(run, f"a {types['a']}, b {types['a']}, " + ", ".join(f"{n} {types[n]}" for n in by))


def components(links: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, node, root) of every node of a link (by, a, b) but the roots: the smallest node it is connected with.

    Tasks make stars of the links they hold; then every node sends its smallest
    neighbour to its larger ones and to the smaller ones in turn, until all nodes
    hang on their roots.
    """
    by = list(by)
    key = [*by, "a"]
    tree = cut(_contracted(links, by))
    while True:
        ends = tree.select(*by, F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
        ends = ends.unionAll(tree.select(*by, F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        places = ends.groupBy(*by, "node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if places.filter((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).isEmpty():
            return tree.select(*by, F.col("a").alias("node"), F.col("b").alias("root"))
        both = tree.select(*by, "a", "b").unionAll(tree.select(*by, F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy(*key).agg(F.min("b").alias("m")).select(*key, F.least("a", "m").alias("m"))
        up = both.join(low, key).filter("b > a").select(*by, F.col("b").alias("a"), F.col("m").alias("b")).filter("a > b").distinct()
        low = up.groupBy(*key).agg(F.min("b").alias("m"))
        hung = up.join(low, key).filter("b <> m").select(*by, F.col("b").alias("a"), F.col("m").alias("b"))
        tree = cut(_contracted(hung.unionAll(low.select(*by, "a", F.col("m").alias("b"))).distinct(), by))
