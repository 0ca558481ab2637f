"""k-means on profiles, and the measures that choose k.

Rows with equal axes have equal features, so models are fitted on the distinct
profiles with their counts as weights; a label per profile is a label per row.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segloom.config import CELL, MISSING
from segloom.operators.blocks import BLOCK, over_block_pairs
from segloom.operators.distance import onehot_square
from segloom.operators.stats import axis_counts, compress
from segloom.runtime import cut


def silhouette_rows(
    points: DataFrame, by: Sequence[str], axes: Sequence[str], label: str = "cluster", drop_missing: bool = False, block: int = BLOCK
) -> DataFrame:
    """Silhouette of each point (profile with count `n`) under the Euclidean one-hot distance.

    `points`: by, pid, axes, n, label. Rows of one profile share the value.
    """
    by, axes = list(by), list(axes)

    def reduce(rows, others):
        square = onehot_square(rows, others, axes, drop_missing)
        labels, place = np.unique(others[label].to_numpy(), return_inverse=True)
        weight = np.zeros((len(others), len(labels)))
        weight[np.arange(len(others)), place] = others["n"].to_numpy(dtype=float)
        sums = np.sqrt(square) @ weight
        out = rows[[*by, "pid"]].loc[rows.index.repeat(len(labels))].copy()
        out["other"] = np.tile(labels, len(rows))
        out["total"] = sums.ravel()
        out["rows"] = np.tile(weight.sum(axis=0), len(rows))
        return out

    types = dict(points.dtypes)
    schema = ", ".join([*[f"{n} {types[n]}" for n in [*by, "pid"]], f"other {types[label]}", "total double", "rows double"])
    parts = over_block_pairs(points, by, "pid", reduce, schema, block)
    sums = parts.groupBy(*by, "pid", "other").agg(F.sum("total").alias("total"), F.sum("rows").alias("rows"))
    joined = sums.join(points.select(*by, "pid", label, "n"), [*by, "pid"])
    own = F.col("other") == F.col(label)
    per = joined.groupBy(*by, "pid", label, "n").agg(
        F.max(F.when(own & (F.col("rows") > 1), F.col("total") / (F.col("rows") - 1))).alias("a"),
        F.min(F.when(~own, F.col("total") / F.col("rows"))).alias("b"),
    )
    top = F.greatest("a", "b")
    value = F.when(F.col("a").isNull() | (top == 0), F.lit(0.0)).otherwise((F.col("b") - F.col("a")) / top)
    return per.withColumn("silhouette", value)


def silhouette(points: DataFrame, by: Sequence[str], axes: Sequence[str], label: str = "cluster", drop_missing: bool = False, block: int = BLOCK) -> DataFrame:
    """Mean silhouette per group over all rows; NULL with fewer than two clusters."""
    rows = silhouette_rows(points, by, axes, label, drop_missing, block)
    mean = F.sum(F.col("silhouette") * F.col("n")) / F.sum("n")
    return rows.groupBy(*by).agg(
        F.when(F.countDistinct(label) > 1, mean).alias("silhouette"), F.countDistinct(label).alias("n_clusters")
    )


def calinski_harabasz(df: DataFrame, by: Sequence[str], axes: Sequence[str], label: str = "cluster", drop_missing: bool = False, weight: str | None = None) -> DataFrame:
    """Variance-ratio score per group, from value counts alone.

    The squared distance of one-hot rows to their mean adds up to n·p·(1-p) per value.
    """
    by = list(by)
    counts = axis_counts(df, [*by, label], axes, weight)
    spread = F.sum(F.col("n") * (1 - F.col("n") / F.col("size")))
    kept = F.col("value") != MISSING if drop_missing else F.lit(True)
    sizes = counts.groupBy(*by, label, "axis").agg(F.sum("n").alias("size")).groupBy(*by, label).agg(F.max("size").alias("size"))
    within = counts.filter(kept).join(sizes, [*by, label]).groupBy(*by).agg(spread.alias("within"))
    totals = sizes.groupBy(*by).agg(F.sum("size").alias("size"), F.count("*").alias("k"))
    pooled = counts.filter(kept).groupBy(*by, "axis", "value").agg(F.sum("n").alias("n"))
    overall = pooled.join(totals, by).groupBy(*by, "size", "k").agg(spread.alias("total"))
    between = F.col("total") - F.col("within")
    score = F.when(F.col("k") > 1, (between / (F.col("k") - 1)) / (F.col("within") / (F.col("size") - F.col("k"))))
    return overall.join(within, by).select(*by, F.col("size").alias("n"), F.col("k"), score.alias("score"))


@dataclass
class Runs:
    """All runs (cell, k, seed) with their centres: runs x k x values numbers, whatever the rows."""

    by: list[str]
    axes: list[str]
    slots: dict[tuple, dict[tuple[str, str], int]]  # per cell: (axis, value) -> place in a vector
    runs: list[tuple[tuple, int, int]]
    centres: list[np.ndarray]
    drop_missing: bool

    def vectors(self, rows: pd.DataFrame, cell: tuple) -> np.ndarray:
        """One-hot vectors of a cell's rows; a value that has no place is a zero block."""
        slots = self.slots[cell]
        out = np.zeros((len(rows), len(slots)))
        for axis in self.axes:
            value = rows[axis].where(rows[axis].notna(), MISSING)
            place = value.map(lambda v, axis=axis: slots.get((axis, v), -1)).to_numpy()
            known = np.flatnonzero(place >= 0)
            out[known, place[known]] = 1.0
        return out

    def of_cells(self, batch: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, np.ndarray, list[int]]]:
        """(rows, vectors, numbers of the runs) of each cell in a batch."""
        numbers: dict[tuple, list[int]] = {}
        for i, (cell, _, _) in enumerate(self.runs):
            numbers.setdefault(cell, []).append(i)
        for cell, rows in batch.groupby(self.by, sort=False, dropna=False):
            if cell in numbers:
                yield rows, self.vectors(rows, cell), numbers[cell]


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of rows and centres."""
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1)[None, :], 0.0)


def _chance(pid: np.ndarray, run: int, seed: int, step: int) -> np.ndarray:
    """A number in (0, 1) for each point, the same in every partitioning."""
    x = pid.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((seed * 1_000_003 + step * 7919 + 17) % 2**63)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / 2**53 + 2**-55


def _seeded(points: DataFrame, state: Runs) -> None:
    """k-means++ centres of all runs, one centre of each per pass.

    The next centre is drawn with probability proportional to count x squared distance: it is the point with
    the smallest exponential draw over that weight, which tasks find alone and a maximum joins.
    """
    step, want = 0, max((k for _, k, _ in state.runs), default=0)
    while step < want:

        def draw(batches: Iterator[pd.DataFrame], step=step) -> Iterator[pd.DataFrame]:
            for batch in batches:
                out = []
                for rows, x, numbers in state.of_cells(batch):
                    pid, n = rows["pid"].to_numpy(), rows["n"].to_numpy(float)
                    for i in numbers:
                        _, k, seed = state.runs[i]
                        if step < k:
                            weight = n * (_distances(x, state.centres[i]).min(1) if step else 1.0)
                            key = np.where(weight > 0, np.log(np.maximum(weight, 1e-300)) - np.log(-np.log(_chance(pid, i, seed, step))), -np.inf)
                            best = int(np.lexsort([pid, -key])[0])
                            if np.isfinite(key[best]):
                                out.append((i, float(key[best]), int(pid[best]), x[best].tolist()))
                yield pd.DataFrame(out, columns=["run", "key", "pid", "point"])

        found = points.mapInPandas(draw, "run int, key double, pid long, point array<double>")
        best = found.groupBy("run").agg(F.max_by("point", F.struct("key", -F.col("pid"))).alias("point")).collect()  # a row per run
        for r in best:
            state.centres[r["run"]] = np.vstack([state.centres[r["run"]], np.array(r["point"])])
        if not best:
            break
        step += 1


def _moved(points: DataFrame, state: Runs, max_iter: int, tol: float = 1e-4) -> None:
    """Lloyd's steps of all runs together until no centre moves; a run that has settled takes no more part."""
    open_ = set(range(len(state.runs)))
    for _ in range(max_iter):

        def sums(batches: Iterator[pd.DataFrame], open_=frozenset(open_)) -> Iterator[pd.DataFrame]:
            for batch in batches:
                out = []
                for rows, x, numbers in state.of_cells(batch):
                    n = rows["n"].to_numpy(float)
                    for i in numbers:
                        if i in open_:
                            nearest = _distances(x, state.centres[i]).argmin(1)
                            own = np.zeros((len(rows), len(state.centres[i])))
                            own[np.arange(len(rows)), nearest] = n
                            out.append((i, np.column_stack([own.T @ x, own.sum(0)]).tobytes()))
                yield pd.DataFrame(out, columns=["run", "sums"])

        def total(rows: pd.DataFrame) -> pd.DataFrame:
            whole = np.sum([np.frombuffer(r) for r in rows["sums"]], axis=0)
            return pd.DataFrame({"run": rows["run"].iloc[:1], "sums": [whole.tobytes()]})

        made = points.mapInPandas(sums, "run int, sums binary").groupBy("run").applyInPandas(total, "run int, sums binary").collect()
        for r in made:
            old = state.centres[r["run"]]
            whole = np.frombuffer(r["sums"]).reshape(len(old), -1)
            new = np.where(whole[:, -1:] > 0, whole[:, :-1] / np.maximum(whole[:, -1:], 1e-300), old)
            state.centres[r["run"]] = new
            if np.sqrt(((new - old) ** 2).sum(1)).max() <= tol:
                open_.discard(r["run"])
        if not open_ or not made:
            break


def kmeans_runs(profiles: DataFrame, axes: Sequence[str], runs: Iterable[tuple[tuple[str, ...], int, int]], by: Sequence[str] = CELL, drop_missing: bool = True, max_iter: int = 300) -> DataFrame | None:
    """Labels of all runs (cell, k, seed), fitted together: a pass over the profiles serves every run.

    A cell without explicit values, with k <= 1 or with fewer than 3 rows is one cluster.
    """
    by, axes = list(by), list(axes)
    runs = list(dict.fromkeys(runs))
    if not runs:
        return None
    sizes = {tuple(r[b] for b in by): r["rows"] for r in profiles.groupBy(*by).agg(F.sum("n").alias("rows")).collect()}
    values = F.explode(F.array(*[F.struct(F.lit(a).alias("axis"), F.coalesce(F.col(a), F.lit(MISSING)).alias("value")) for a in axes]))
    slots: dict[tuple, dict[tuple[str, str], int]] = {cell: {} for cell in sizes}
    # The values of the axes, which bound the vectors.
    for r in sorted(profiles.select(*by, values.alias("v")).select(*by, "v.*").distinct().collect()):
        if not (drop_missing and r["value"] == MISSING):
            own = slots[tuple(r[b] for b in by)]
            own[r["axis"], r["value"]] = len(own)
    plain = [(c, k, s) for c, k, s in runs if k <= 1 or sizes.get(c, 0) < 3 or not slots.get(c)]
    fitted = [r for r in runs if r not in set(plain)]
    state = Runs(by, axes, slots, fitted, [np.zeros((0, len(slots[c]))) for c, _, _ in fitted], drop_missing)
    points = cut(profiles.select(*by, "pid", *axes, "n"))
    if fitted:
        _seeded(points, state)
        _moved(points, state, max_iter)
    types = dict(points.dtypes)
    schema = ", ".join([f"{c} {types[c]}" for c in points.columns] + ["cluster int", "k int", "seed int"])

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for rows, x, numbers in state.of_cells(batch):
                for i in numbers:
                    _, k, seed = state.runs[i]
                    yield rows.assign(cluster=_distances(x, state.centres[i]).argmin(1), k=k, seed=seed)

    out = points.mapInPandas(label, schema)
    if plain:
        listed = profiles.sparkSession.createDataFrame([(*c, k, s) for c, k, s in plain], ", ".join([*[f"{b} {types[b]}" for b in by], "k int, seed int"]))
        alone = points.join(F.broadcast(listed), by).select(*points.columns, F.lit(0).alias("cluster"), "k", "seed")
        out = out.unionByName(alone)
    return cut(out)


def score_runs(labels: DataFrame, axes: Sequence[str], by: Sequence[str] = CELL, drop_missing: bool = True) -> DataFrame:
    """Silhouette of each run; -1 where only one cluster came out."""
    scored = silhouette(labels, [*by, "k", "seed"], axes, "cluster", drop_missing)
    return scored.withColumn("silhouette", F.coalesce("silhouette", F.lit(-1.0)))


def kmeans_best(profiles: DataFrame, axes: Sequence[str], ks: dict[tuple[str, ...], int], n_seeds: int = 10, by: Sequence[str] = CELL, drop_missing: bool = True) -> DataFrame:
    """Labels of the seed with the best silhouette in each cell."""
    runs = [(cell, k, seed) for cell, k in ks.items() for seed in range(n_seeds)]
    labels = kmeans_runs(profiles, axes, runs, by, drop_missing)
    best = score_runs(labels, axes, by, drop_missing).groupBy(*by).agg(
        F.max_by(F.struct("seed", "silhouette"), F.struct("silhouette", -F.col("seed"))).alias("b")
    )
    return labels.join(best.select(*by, F.col("b.seed").alias("seed"), "b.silhouette"), [*by, "seed"])


def k_sweep(profiles: DataFrame, axes: Sequence[str], ks: dict[tuple[str, ...], Iterable[int]], n_seeds: int = 5, by: Sequence[str] = CELL, drop_missing: bool = True) -> DataFrame:
    """Per cell and k: best silhouette over the seeds and the score of its variance ratio.

    A k that the cell has too few rows for is listed with a note.
    """
    by = list(by)
    rows = {tuple(r[b] for b in by): r["rows"] for r in profiles.groupBy(*by).agg(F.sum("n").alias("rows")).collect()}
    wanted = [(cell, k) for cell, values in ks.items() for k in values]
    usable = [(cell, k, s) for cell, k in wanted if rows.get(cell, 0) >= k + 1 for s in range(n_seeds)]
    labels = kmeans_runs(profiles, axes, usable, by, drop_missing)
    spark = profiles.sparkSession
    listed = spark.createDataFrame([(*cell, k) for cell, k in wanted], ", ".join([*[f"{b} string" for b in by], "k int"]))
    if labels is None:
        empty = F.lit(None).cast("double")
        return listed.withColumns({"silhouette": empty, "ch": empty, "note": F.lit("skip_n_lt_k")})
    scored = score_runs(labels, axes, by, drop_missing)
    ch = calinski_harabasz(labels.withColumn("run_k", F.col("k")), [*by, "run_k", "seed"], axes, "cluster", drop_missing, "n")
    scored = scored.join(ch.select(*by, F.col("run_k").alias("k"), "seed", F.col("score").alias("ch")), [*by, "k", "seed"], "left")
    best = scored.groupBy(*by, "k").agg(F.max_by(F.struct("silhouette", "ch", "n_clusters"), F.struct("silhouette", -F.col("seed"))).alias("b"))
    note = F.when(F.col("b").isNull(), "skip_n_lt_k").when(F.col("b.n_clusters") < 2, "single_cluster")
    return listed.join(best, [*by, "k"], "left").select(
        *by, "k", F.when(F.col("b").isNotNull(), F.col("b.silhouette")).alias("silhouette"), F.col("b.ch").alias("ch"), note.alias("note")
    )


def sweep_choice(scores: DataFrame, by: Sequence[str] = CELL, low: float = 0.15) -> DataFrame:
    """Best k by silhouette (smallest k among equals) and the all-below-threshold warning."""
    valid = F.col("silhouette") >= -0.5
    return scores.groupBy(*by).agg(
        F.max_by(F.when(valid, F.col("k")), F.when(valid, F.struct("silhouette", -F.col("k")))).alias("best_k"),
        F.max(F.when(valid, F.col("silhouette"))).alias("best_silhouette"),
        F.coalesce(F.max(F.when(valid, F.col("silhouette"))) < low, F.lit(False)).alias("all_low"),
    )


def kneedle(df: DataFrame, by: Sequence[str], x: str, y: str) -> DataFrame:
    """The x farthest from the chord between the first and the last point.

    Both series are scaled to 0..1; with one or two points the first x is taken.
    Distances are compared to 12 digits, the smaller x wins.
    """
    by = list(by)
    whole = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1))
    order = whole.orderBy(x).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def scaled(c):
        low, high = F.min(c).over(whole), F.max(c).over(whole)
        return F.when(high > low, (F.col(c) - low) / (high - low)).otherwise(F.lit(0.0))

    points = df.select(*by, x, scaled(x).alias("_x"), scaled(y).alias("_y"))
    points = points.withColumns({"_dx": F.col("_x") - F.first("_x").over(order), "_dy": F.col("_y") - F.first("_y").over(order)})
    points = points.withColumns({"_ex": F.last("_dx").over(order), "_ey": F.last("_dy").over(order)})
    chord = F.hypot("_ex", "_ey")
    norm = F.when(chord == 0, F.lit(1.0)).otherwise(chord)
    far = F.round(F.abs(F.col("_dx") * F.col("_ey") - F.col("_dy") * F.col("_ex")) / norm, 12)
    return points.groupBy(*by).agg(
        F.when(F.count("*") <= 2, F.min(x)).otherwise(F.max_by(x, F.struct(far, -F.col(x)))).alias("elbow")
    )


def delta_elbow(scores: DataFrame, by: Sequence[str], k: str = "k", y: str = "silhouette") -> DataFrame:
    """Elbow of the step-to-step changes; a single k is its own elbow."""
    from segloom.operators.ranking import delta

    by = list(by)
    steps = delta(scores, by, k, y).filter(F.col("delta").isNotNull())
    found = kneedle(steps, by, k, "delta")
    first = scores.groupBy(*by).agg(F.min(k).alias("_first"))
    return first.join(found, by, "left").select(*by, F.coalesce("elbow", "_first").alias("elbow"))


def recommend_k(scores: DataFrame, by: Sequence[str], k: str = "k", y: str = "silhouette", ch: str = "ch") -> DataFrame:
    """The elbow, with a note on how it agrees with the best variance ratio."""
    by = list(by)
    best = scores.groupBy(*by).agg(F.max_by(k, F.struct(ch, -F.col(k))).alias("ch_best"))
    gap = F.abs(F.col("ch_best") - F.col("elbow"))
    note = F.when(gap == 0, "equal").when(gap <= 1, "within_one").otherwise("differ")
    return delta_elbow(scores, by, k, y).join(best, by).select(*by, F.col("elbow").alias("recommended_k"), "ch_best", note.alias("agreement"))


def derive_k_cap(cap: Column) -> Column:
    """Upper bound of k for three axes."""
    half = F.least(F.lit(15), F.floor(cap / 2))
    floor = F.when(cap >= 6, 3).otherwise(2)
    return F.when(cap <= 1, 1).otherwise(F.greatest(half, floor)).cast("int")


def compare_methods(a: DataFrame, b: DataFrame, label: str = "cluster", by: Sequence[str] = CELL) -> DataFrame:
    """Clusters per cell in two assignments and the noise share of the second."""
    by = list(by)
    left = compress(a, by, [label]).groupBy(*by).agg(F.count("*").alias("n_a"))
    noise = F.sum(F.when(F.col(label) == -1, F.col("n")).otherwise(0))
    right = compress(b, by, [label]).groupBy(*by).agg(
        F.count_if(F.col(label) != -1).alias("n_b"), (noise * 100.0 / F.sum("n")).alias("noise_pct")
    )
    return left.join(right, by, "full_outer").withColumns({"n_a": F.coalesce("n_a", F.lit(0)), "n_b": F.coalesce("n_b", F.lit(0))})


def numbered(points: DataFrame, by: Sequence[str], axes: Sequence[str]) -> DataFrame:
    """Profiles with a dense number per group."""
    order = Window.partitionBy(*by).orderBy(*axes)
    return points.withColumn("pid", F.row_number().over(order) - 1)

