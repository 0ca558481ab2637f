"""Density clusters against a condensed tree built in memory, and components against union-find."""

import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from segloom.operators import density as DN
from segloom.operators.components import components


def by_hand(nodes: pd.DataFrame, edges: pd.DataFrame, min_size: int) -> pd.Series:
    """Cluster number per node (-1 noise) by excess of mass, over a condensed tree of one group in memory."""
    owner = {p: p for p in nodes["pid"]}

    def find(p):
        while owner[p] != p:
            owner[p] = owner[owner[p]]
            p = owner[p]
        return p

    rows = dict(zip(nodes["pid"], nodes["n"]))
    # component -> [level at which it breaks up, parts, rows, members]
    current = {}
    by_core, by_level = nodes.groupby("core")["pid"].apply(list), edges.groupby("level")
    for level in sorted({*nodes["core"], *edges["level"]}):
        for p in by_core.get(level, []):
            current[p] = (level, [], rows[p], [p])
        merged: dict[int, list] = {}
        pairs = by_level.get_group(level)[["a", "b"]].to_numpy() if level in by_level.groups else []
        touched = {find(p) for pair in pairs for p in pair}
        for a, b in pairs:
            owner[find(a)] = find(b)
        for part in touched:
            merged.setdefault(find(part), []).append(current.pop(part))
        for root, parts in merged.items():
            current[root] = (level, parts, sum(p[2] for p in parts), [m for p in parts for m in p[3]])

    clusters = []  # [parent, birth, stability, members]

    def follow(node, cluster):
        todo = [(node, cluster)]
        while todo:
            (level, parts, size, _), c = todo.pop()
            gone = np.inf if level == 0 else 1 / np.sqrt(level)
            big = [p for p in parts if p[2] >= min_size]
            stays = big[0][2] if len(big) == 1 else 0
            if size > stays:
                clusters[c][2] += (size - stays) * (gone - clusters[c][1])
            if len(big) == 1:
                todo.append((big[0], c))
            elif len(big) > 1:
                for part in big:
                    clusters.append([c, gone, 0.0, part[3]])
                    todo.append((part, len(clusters) - 1))

    for top in current.values():
        clusters.append([-1, 0.0, 0.0, top[3]])
        follow(top, len(clusters) - 1)

    # bottom-up: a cluster stays if its descendants together are not more stable
    best, picked = [c[2] for c in clusters], [c[0] >= 0 for c in clusters]
    below = [0.0] * len(clusters)
    for i in range(len(clusters) - 1, -1, -1):
        if below[i] > best[i] or clusters[i][0] < 0:
            best[i], picked[i] = below[i], False
        if clusters[i][0] >= 0:
            below[clusters[i][0]] += best[i]
    label = dict.fromkeys(nodes["pid"], -1)
    covered = [False] * len(clusters)
    for i, (parent, _, _, members) in enumerate(clusters):
        covered[i] = parent >= 0 and covered[parent]
        if picked[i] and not covered[i]:
            covered[i] = True
            label.update(dict.fromkeys(members, i))
    found = nodes["pid"].map(label)
    first = nodes["pid"].groupby(found).min().drop(index=-1, errors="ignore").sort_values()
    return found.map({c: k for k, c in enumerate(first.index)} | {-1: -1})


def test_clusters_by_hand(spark, monkeypatch):
    rows, sizes = [], {}
    for seed in range(12):
        rng = random.Random(seed)
        for _ in range(rng.randrange(8, 60)):
            row = (f"g{seed}", *[rng.choice("xyzwu"[: 2 + seed % 4]) if rng.random() < 0.85 else "불명확" for _ in range(4)])
            rows += [row] * rng.choice([1, 1, 1, 2, 3, 5, 9, 20])
        sizes[f"g{seed}"] = rng.choice([3, 4, 6, 10, 20])
    df = spark.createDataFrame(rows, "g string, a string, b string, c string, d string")
    seen, real = {}, DN.stable_clusters

    def spy(nodes, tree, by):
        seen["nodes"], seen["tree"] = nodes.toPandas(), tree.toPandas()
        out = real(nodes, tree, by)
        assert "PythonArrow" not in out._jdf.queryExecution().toString() and "FlatMapCoGroups" not in out._jdf.queryExecution().toString()
        return out

    monkeypatch.setattr(DN, "stable_clusters", spy)
    out = DN.density_clusters(df, ["a", "b", "c", "d"], by=["g"], min_sizes=sizes, block=16).toPandas()
    assert seen["nodes"]["g"].nunique() == 12
    for g, nodes in seen["nodes"].groupby("g"):
        nodes = nodes.sort_values("pid", ignore_index=True)
        tree = seen["tree"][seen["tree"]["g"] == g]
        want = by_hand(nodes[["pid", "n", "core"]], tree, int(nodes["mcs"].iloc[0])).tolist()
        assert out[out["g"] == g].sort_values("pid")["cluster"].tolist() == want


def test_components(spark):
    rng = random.Random(1)
    links = [(g, rng.randrange(300), rng.randrange(300)) for g in "pq" for _ in range(160)] + [("r", k, k + 1) for k in range(400)] + [("s", 0, k) for k in range(1, 200)]
    df = spark.createDataFrame(links, "g string, a int, b int").repartition(7)
    got = {(r.g, r.node): r.root for r in components(df, ["g"]).collect()}
    want: dict = {}
    for g in ("p", "q", "r", "s"):
        label = {x: x for h, a, b in links if h == g for x in (a, b)}
        while True:
            before = dict(label)
            for h, a, b in links:
                if h == g:
                    label[a] = label[b] = min(label[a], label[b])
            if label == before:
                break
        want |= {(g, x): low for x, low in label.items() if x != low}
    assert got == want
    assert components(df.filter(F.lit(False)), ["g"]).isEmpty()
