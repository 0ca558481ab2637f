"""Null-aware categorical distance and cosine distance."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segloom.config import AXES, CELL, GOWER_WEIGHTS, MISSING, PARTIAL_DISTANCE, PARTIAL_WEIGHT, SegmentConfig
from segloom.functions.columns import is_missing
from segloom.operators.blocks import BLOCK, over_block_pairs, over_blocks
from segloom.operators.stats import compress
from segloom.runtime import cut


def axis_contribution(a: Column, b: Column) -> tuple[Column, Column]:
    """(distance, weight) of one axis."""
    gone_a, gone_b = is_missing(a), is_missing(b)
    both, one = gone_a & gone_b, gone_a != gone_b
    distance = F.when(both, 0.0).when(one, PARTIAL_DISTANCE).when(a == b, 0.0).otherwise(1.0)
    weight = F.when(both, 0.0).when(one, PARTIAL_WEIGHT).otherwise(1.0)
    return distance, weight


def gower(left: Sequence[Column], right: Sequence[Column], weights: Sequence[float] = GOWER_WEIGHTS) -> Column:
    """Distance of two rows; axes beyond the weight list do not count."""
    top = bottom = F.lit(0.0)
    for a, b, w in zip(left, right, weights):
        distance, weight = axis_contribution(a, b)
        top, bottom = top + distance * w, bottom + weight * w
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def weighted_axes(axes: Sequence[str] = AXES, weights: Sequence[float] = GOWER_WEIGHTS) -> tuple[list[str], list[float]]:
    pairs = [(a, w) for a, w in zip(axes, weights) if w > 0]
    return [a for a, _ in pairs], [w for _, w in pairs]


def profiles(df: DataFrame, by: Iterable[str] = CELL, axes: Sequence[str] = AXES, weights: Sequence[float] = GOWER_WEIGHTS) -> DataFrame:
    """Distinct values of the weighted axes per cell with row counts.

    Rows with equal weighted axes are at distance 0 and equally far from all
    others, so distances need only these; the table's size depends on the value
    domains, not on the number of rows. Missing values are one value here.
    """
    by = list(by)
    names, _ = weighted_axes(axes, weights)
    # a bare sentinel is by far the commonest missing value; NULL and padded ones join it
    clean = [F.when(is_missing(a), MISSING).otherwise(F.col(a)).alias(a) for a in names]
    small = compress(df.select(*by, *clean), by, names)
    return small.withColumn("pid", F.row_number().over(Window.partitionBy(*by).orderBy(*names)) - 1)


def _gower_matrix(rows: pd.DataFrame, others: pd.DataFrame, axes: list[str], weights: list[float]) -> np.ndarray:
    top = np.zeros((len(rows), len(others)))
    bottom = np.zeros_like(top)
    for axis, w in zip(axes, weights):
        a, b = rows[axis].to_numpy(), others[axis].to_numpy()
        gone_a, gone_b = (a == MISSING)[:, None], (b == MISSING)[None, :]
        one, present = gone_a ^ gone_b, ~gone_a & ~gone_b
        top += w * (PARTIAL_DISTANCE * one + (present & (a[:, None] != b[None, :])))
        bottom += w * (PARTIAL_WEIGHT * one + present)
    return np.divide(top, bottom, out=np.zeros_like(top), where=bottom > 0)


def onehot_square(rows: pd.DataFrame, others: pd.DataFrame, axes: Iterable[str], drop_missing: bool) -> np.ndarray:
    """Squared Euclidean distances of one-hot rows; dropped missing values are zero blocks."""
    square = np.zeros((len(rows), len(others)))
    for a in axes:
        p, q = rows[a].to_numpy()[:, None], others[a].to_numpy()[None, :]
        differ = (p != q).astype(float)
        square += differ * (2.0 - (p == MISSING) - (q == MISSING)) if drop_missing else 2.0 * differ
    return square


def gower_histogram(small: DataFrame, by: Sequence[str] = CELL, axes: Sequence[str] = AXES, weights: Sequence[float] = GOWER_WEIGHTS, block: int = BLOCK) -> DataFrame:
    """Per cell and distance (6 digits): profile pairs and row pairs at that distance."""
    by = list(by)
    names, w = weighted_axes(axes, weights)

    def reduce(rows, others):
        d = np.round(_gower_matrix(rows, others, names, w), 6)
        later = rows["pid"].to_numpy()[:, None] < others["pid"].to_numpy()[None, :]
        pairs = rows["n"].to_numpy(dtype=float)[:, None] * others["n"].to_numpy(dtype=float)[None, :]
        values, place = np.unique(d[later], return_inverse=True)
        out = pd.DataFrame({"d": values, "n_pairs": np.bincount(place, minlength=len(values)).astype("int64")})
        out["row_pairs"] = np.bincount(place, weights=pairs[later], minlength=len(values))
        for i, name in enumerate(by):
            out.insert(i, name, rows[name].iloc[0])
        return out

    schema = ", ".join([*[f"{n} string" for n in by], "d double", "n_pairs long", "row_pairs double"])
    parts = over_block_pairs(small, by, "pid", reduce, schema, block)
    return parts.groupBy(*by, "d").agg(F.sum("n_pairs").alias("n_pairs"), F.sum("row_pairs").cast("long").alias("row_pairs"))


def gower_nearest(small: DataFrame, by: Sequence[str] = CELL, axes: Sequence[str] = AXES, weights: Sequence[float] = GOWER_WEIGHTS, block: int = BLOCK) -> DataFrame:
    """Per profile: distance to the nearest other profile, and the mean row distance to the cell."""
    by = list(by)
    names, w = weighted_axes(axes, weights)

    def reduce(rows, others):
        d = _gower_matrix(rows, others, names, w)
        n = others["n"].to_numpy(dtype=float)
        same = rows["pid"].to_numpy()[:, None] == others["pid"].to_numpy()[None, :]
        out = rows[[*by, "pid"]].copy()
        out["nearest"] = np.where(same, np.inf, d).min(axis=1)
        out["total"] = d @ n
        out["rows"] = n.sum()
        return out

    schema = ", ".join([*[f"{n} string" for n in by], "pid int", "nearest double", "total double", "rows double"])
    parts = over_block_pairs(small, by, "pid", reduce, schema, block)
    merged = parts.groupBy(*by, "pid").agg(
        F.min("nearest").alias("nearest"), (F.sum("total") / F.sum("rows")).alias("mean_distance")
    )
    return small.join(merged, [*by, "pid"])


def target_raw_k(cell: Column, n_clusterable: Column, config: SegmentConfig) -> Column:
    """Number of raw clusters: scaled per cell, rounded half to even, within 1..n."""
    out = F.lit(1)
    for slug, k in config.raw_k.items():
        scale = config.cell_raw_k_scale.get(slug, config.raw_k_scale)
        scaled = F.greatest(F.lit(1), F.bround(F.lit(k * float(scale)), 0).cast("int"))
        out = F.when(cell == slug, scaled).otherwise(out)
    return F.greatest(F.lit(1), F.least(out, n_clusterable.cast("int")))


def value_codes(small: DataFrame, axes: Sequence[str]) -> tuple[DataFrame, dict[str, int]]:
    """(axis, value, code) table of the explicit values, and the number per axis."""
    pairs = F.array(*[F.struct(F.lit(a).alias("axis"), F.col(a).alias("value")) for a in axes])
    values = small.select(F.inline(pairs)).filter(F.col("value") != MISSING).distinct()
    codes = values.withColumn("code", F.row_number().over(Window.partitionBy("axis").orderBy("value")) - 1)
    sizes = {r["axis"]: r["n"] for r in codes.groupBy("axis").agg(F.count("*").alias("n")).collect()}
    return codes, {a: sizes.get(a, 0) for a in axes}


class GowerForm:
    """Sums of Gower distances between groups of profiles, from sparse counts.

    A profile has a missingness pattern (which axes are explicit) and, in that
    pattern, its explicit values. A group's counts are `amounts` per slot (pattern,
    place): place 0 counts rows, the others the values of one axis after another.
    The distance of two profiles depends on their patterns and on the values that
    they share, so the sum over all pairs of two groups is

        N(A) base N(B)' - sum over axes k and values v of  c(A, s, k, v) share(k, s, t) c(B, t, k, v)

    with one number per pair of patterns (`base`) and per axis and pair of
    patterns (`share`). Nothing grows with the square of the number of values.
    """

    columns = ("slots", "amounts")
    constant = 0.0
    _CHUNK = 1024  # slots that are worked on at once

    def __init__(self, sizes: Mapping[str, int], weights: Sequence[float]):
        axes = list(sizes)
        self.ends = np.cumsum([1, *[sizes[a] for a in axes]])  # places before each axis
        self.width = int(self.ends[-1])
        self.patterns = 2 ** len(axes)
        here = np.array([[(s >> k) & 1 for k in range(len(axes))] for s in range(self.patterns)], bool)
        w = np.array(list(weights), float)
        both = here[:, None] & here[None, :]
        one = here[:, None] ^ here[None, :]
        bottom = both @ w + PARTIAL_WEIGHT * (one @ w)
        unit = np.divide(1.0, bottom, out=np.zeros_like(bottom), where=bottom > 0)
        self.base = (both @ w + PARTIAL_DISTANCE * (one @ w)) * unit
        self.share = np.moveaxis(both * w, 2, 0) * unit

    def _counts(self, rows: pd.DataFrame):
        """Row number, pattern, place and amount of every entry."""
        lengths = rows["slots"].str.len().to_numpy().astype(int)
        at = np.repeat(np.arange(len(rows)), lengths)
        slots = np.concatenate([np.asarray(x, np.int64) for x in rows["slots"]])
        amounts = np.concatenate([np.asarray(x, float) for x in rows["amounts"]])
        return at, slots // self.width, slots % self.width, amounts

    def totals(self, rows: pd.DataFrame, others: pd.DataFrame) -> np.ndarray:
        """Sum of distances between every row's and every other row's profiles."""
        at, pattern, place, amount = self._counts(rows)
        at_, pattern_, place_, amount_ = self._counts(others)
        n, n_ = np.zeros((len(rows), self.patterns)), np.zeros((len(others), self.patterns))
        n[at[place == 0], pattern[place == 0]] = amount[place == 0]
        n_[at_[place_ == 0], pattern_[place_ == 0]] = amount_[place_ == 0]
        out = n @ self.base @ n_.T
        shared = np.intersect1d(place[place > 0], place_[place_ > 0])
        mine, theirs = np.isin(place, shared), np.isin(place_, shared)
        slots, where = np.unique(place[mine] * self.patterns + pattern[mine], return_inverse=True)
        at, amount = at[mine], amount[mine]
        at_, pattern_, place_, amount_ = at_[theirs], pattern_[theirs], place_[theirs], amount_[theirs]
        for first in range(0, len(slots), self._CHUNK):
            chunk = slots[first : first + self._CHUNK]
            own = (where >= first) & (where < first + self._CHUNK)
            left = np.zeros((len(rows), len(chunk)))
            left[at[own], where[own] - first] = amount[own]
            right = np.zeros((len(others), len(chunk)))
            axis = np.searchsorted(self.ends, chunk // self.patterns, side="right") - 1
            column = np.searchsorted(shared, chunk // self.patterns)
            for t in np.unique(pattern_):
                of = pattern_ == t
                values = np.zeros((len(others), len(shared)))
                values[at_[of], np.searchsorted(shared, place_[of])] = amount_[of]
                right += values[:, column] * self.share[axis, chunk % self.patterns, t]
            out -= left @ right.T
        return out

    @staticmethod
    def merged(parts: Column) -> list[Column]:
        """The columns of a cluster made of one or two others."""

        def counts(x):
            return F.map_from_arrays(x["slots"], x["amounts"])

        def add(_, a, b):
            return F.coalesce(a, F.lit(0.0)) + F.coalesce(b, F.lit(0.0))

        both = F.aggregate(F.slice(parts, 2, 1), counts(F.get(parts, F.lit(0))), lambda acc, x: F.map_zip_with(acc, counts(x), add))
        return [F.map_keys(both).alias("slots"), F.map_values(both).alias("amounts")]


class FormPerGroup:
    """Forms that a column of the group's key chooses among; they differ in weights only."""

    columns = GowerForm.columns
    constant = GowerForm.constant
    merged = staticmethod(GowerForm.merged)

    def __init__(self, column: str, forms: Mapping[str, GowerForm]):
        self.column, self.forms = column, dict(forms)

    def totals(self, rows: pd.DataFrame, others: pd.DataFrame) -> np.ndarray:
        return self.forms[rows[self.column].iloc[0]].totals(rows, others)


class CosineForm:
    """Sums of cosine distances between groups of unit vectors, less their number, from sums of vectors."""

    columns = ("total",)
    constant = 1.0

    @staticmethod
    def vectors(rows: pd.DataFrame) -> np.ndarray:
        """The sums of vectors as a matrix."""
        return np.stack(rows["total"].to_numpy())

    @staticmethod
    def columned(vectors: np.ndarray) -> dict[str, list]:
        return {"total": list(vectors)}

    @staticmethod
    def numbers() -> Column:
        """How many numbers a cluster's vector has."""
        return F.size("total")

    @classmethod
    def totals(cls, rows: pd.DataFrame, others: pd.DataFrame) -> np.ndarray:
        return -cls.vectors(rows) @ cls.vectors(others).T

    @staticmethod
    def merged(parts: Column) -> list[Column]:
        both = F.aggregate(
            F.slice(parts, 2, 1), F.get(parts, F.lit(0))["total"], lambda acc, x: F.zip_with(acc, x["total"], lambda p, q: p + q)
        )
        return [both.alias("total")]


def profile_counts(small: DataFrame, axes: Sequence[str], codes: DataFrame, sizes: Mapping[str, int]) -> DataFrame:
    """Adds `slots` and `amounts` of each profile's rows (see `GowerForm`)."""
    width = 1 + sum(sizes[a] for a in axes)
    pattern = sum((F.when(F.col(a) != MISSING, 1 << k).otherwise(0) for k, a in enumerate(axes)), F.lit(0))
    out, places, offset = small, [F.lit(0)], 1
    for a in axes:
        here = codes.filter(F.col("axis") == a).select(F.col("value").alias(a), (F.col("code") + offset).alias(f"_c_{a}"))
        out = out.join(here, a, "left")
        places.append(F.col(f"_c_{a}"))
        offset += sizes[a]
    slots = F.transform(F.array_compact(F.array(*places)), lambda p: p + pattern * width)
    amounts = F.transform("slots", lambda _: F.col("n").cast("double"))
    return out.withColumn("slots", slots).withColumn("amounts", amounts).drop(*[f"_c_{a}" for a in axes])


def unit_vector(c: str) -> Column:
    """The vector divided by its Euclidean norm (zero vectors stay zero)."""
    values = F.transform(F.col(c), lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x * x))
    # Inside the function of an element, the norm would be worked out for each of them.
    norms = F.array_repeat(norm, F.size(c))
    return F.zip_with(values, norms, lambda x, n: F.when(n > 0, x / n).otherwise(F.lit(0.0)))


def dot(a: str | Column, b: str | Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


PIVOTS = 256  # reference points of a nearest-neighbour join, at most
NEAR_CELLS = 2  # cells whose vectors a vector meets before any bound is known
BUNDLE = 16_384  # vectors of whole cells that are held together
_SLACK = 1e-7  # of angles, so that rounding never hides a neighbour


def _angles(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(x @ pivots.T, -1.0, 1.0))


def cosine_nearest(vectors: DataFrame, by: Sequence[str], key: str, vector: str, block: int = BLOCK, pivots: int = PIVOTS, watch: Callable[[int, int], None] | None = None) -> DataFrame:
    """Per vector: the nearest other vector of its group and their cosine distance.

    Vectors belong to the cell of their nearest reference point (a bounded sample of
    them). Each one first meets the vectors of its nearest cells; the angle found
    is a bound. A cell all of whose vectors are within r of its point, at an angle
    a from the vector, holds nothing nearer than a - r, so only cells below the
    bound are visited then. Cells of a group are held in bundles, and a vector is sent
    once to a bundle with the list of cells that it visits there. Equal vectors of a group are met once; zero vectors have
    the distance 1 to all others. `watch(visits, all)` is told the visits of vectors
    to cells that the bound leaves, and those without it. Ties go to the smallest key.
    """
    by = list(by)
    types = dict(vectors.dtypes)
    units = vectors.select(*by, key, unit_vector(vector).alias("_u"))
    members = units.groupBy(*by, "_u").agg(F.min(key).alias("_k"), F.count("*").alias("_m"))
    # The second smallest key of equal vectors, for the smallest one.
    copies = units.join(members.filter("_m > 1"), [*by, "_u"]).filter(F.col(key) != F.col("_k"))
    second = copies.groupBy(*by, "_k").agg(F.min(key).alias("_second"))
    classes = cut(members.join(second, [*by, "_k"], "left").withColumn("_zero", ~F.exists("_u", lambda x: x != 0)))
    whole = classes.filter("NOT _zero")
    count = whole.count()
    dims = whole.select(F.max(F.size("_u"))).first()[0] or 1
    # About a block of vectors per cell, within the bound.
    wanted = int(max(1, min(pivots, -(-count // block) * 4)))
    sample = whole.orderBy(F.xxhash64("_u"), "_k").limit(wanted).select("_u").collect()
    points = np.unique(np.array([r["_u"] for r in sample], float).reshape(-1, dims), axis=0) if sample else np.zeros((0, dims))

    def placed(batches):
        for batch in batches:
            if not len(batch):
                continue
            angle = _angles(np.stack(batch["_u"].to_numpy()), points)
            near = np.argsort(angle, axis=1, kind="stable")[:, :NEAR_CELLS]
            at = np.arange(len(batch))
            yield batch.assign(_cell=near[:, 0].astype(np.int32), _angle=angle[at, near[:, 0]], _first=list(near.astype(np.int32)))

    base = ", ".join([*[f"{n} {types[n]}" for n in by], f"_k {types[key]}", "_u array<double>"])
    dealt = cut(whole.select(*by, "_k", "_u").mapInPandas(placed, f"{base}, _cell int, _angle double, _first array<int>"))
    radius = np.zeros(len(points))
    for r in dealt.groupBy("_cell").agg(F.max("_angle").alias("r")).collect():  # a row per reference point
        radius[r["_cell"]] = r["r"]
    cell = [*by, "_cell"]
    # Whole cells go to a bundle, in the order of their numbers; a row per group and cell.
    filled = dealt.groupBy(*cell).agg(F.count("*").alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(*by).orderBy("_cell"))
    bundles = cut(filled.select(*cell, F.floor((upto - 1) / BUNDLE).cast("int").alias("_bundle")))
    held = dealt.select(*cell, "_k", "_u").join(bundles, cell)
    lists = bundles.groupBy(*by, "_bundle").agg(F.collect_list("_cell").alias("_cells"))

    def reduce(rows, others):
        theirs, at = others["_k"].to_numpy(), others["_cell"].to_numpy()
        rank = np.argsort(np.argsort(theirs))
        mine, vectors, them = rows["_k"].to_numpy(), np.stack(rows["_u"].to_numpy()), np.stack(others["_u"].to_numpy())
        visits = np.zeros((len(rows), len(points)), bool)
        sizes = [len(v) for v in rows["_visits"]]
        visits[np.repeat(np.arange(len(rows)), sizes), np.concatenate(rows["_visits"].to_numpy())] = True
        low, best = np.full(len(rows), np.inf), np.full(len(rows), -1)
        for c in np.unique(at):
            there, here = np.flatnonzero(at == c), np.flatnonzero(visits[:, c])
            for i in (here[f : f + block] for f in range(0, len(here), block)):
                for j in (there[f : f + block] for f in range(0, len(there), block)):
                    d = 1.0 - vectors[i] @ them[j].T
                    d[mine[i][:, None] == theirs[j][None, :]] = np.inf
                    least = d.min(axis=1)
                    to = j[np.where(d == least[:, None], rank[j][None, :], len(theirs)).argmin(axis=1)]
                    wins = (least < low[i]) | ((least == low[i]) & np.isfinite(least) & (rank[to] < rank[best[i]]))
                    low[i[wins]], best[i[wins]] = least[wins], to[wins]
        out = rows[[*by, "_k"]].copy()
        out["distance"], out["neighbour"] = low, theirs[best]
        return out[np.isfinite(out["distance"])]

    schema = ", ".join([*[f"{n} {types[n]}" for n in by], f"_k {types[key]}", "distance double", f"neighbour {types[key]}"])

    def met(visitors: DataFrame) -> DataFrame:
        """`visitors` have the list of the cells they visit as `_go`."""
        sent = visitors.select(*by, "_k", "_u", "_go").join(lists, by).withColumn("_visits", F.array_intersect("_go", "_cells"))
        sent = sent.filter(F.size("_visits") > 0).select(*by, "_bundle", "_k", "_u", "_visits")
        return over_blocks(sent, held, [*by, "_bundle"], "_k", reduce, schema, max(block, BUNDLE // 4), max(block, BUNDLE))

    first = met(dealt.withColumn("_go", F.col("_first")))
    bound = first.groupBy(*by, "_k").agg(F.min(F.struct("distance", "neighbour")).alias("b"))
    bounded = cut(dealt.join(bound, [*by, "_k"], "left").withColumn("_bound", F.col("b.distance")))

    def visiting(batches):
        for batch in batches:
            if not len(batch):
                continue
            bound_ = np.arccos(np.clip(1.0 - batch["_bound"].fillna(2.0).to_numpy(float), -1.0, 1.0))
            reach = _angles(np.stack(batch["_u"].to_numpy()), points) - radius
            for row, own in zip(reach, batch["_first"]):
                row[np.asarray(own, int)] = np.inf  # visited
            go = [np.flatnonzero(row <= b + _SLACK).astype(np.int32) for row, b in zip(reach, bound_)]
            yield batch[[*by, "_k", "_u"]].assign(_go=go)

    again = bounded.select(*by, "_k", "_u", "_first", "_bound").mapInPandas(visiting, f"{base}, _go array<int>")
    again = cut(again)
    if watch:
        watch(int(again.agg(F.sum(F.size("_go"))).first()[0] or 0), count * max(0, len(points) - NEAR_CELLS))
    second_visits = met(again)
    found = bounded.filter("b IS NOT NULL").select(*by, "_k", "b.distance", "b.neighbour").unionByName(second_visits)
    # A zero vector is at distance 1 from every other one, the smallest of its group among them.
    smallest = classes.groupBy(*by).agg(F.min("_k").alias("_low"), F.min(F.when(F.col("_zero"), F.col("_k"))).alias("_zero_k"))
    next_low = classes.join(smallest, by).filter(F.col("_k") != F.col("_low")).groupBy(*by).agg(F.min("_k").alias("_next"))
    ends = smallest.join(next_low, by, "left")
    zero = classes.filter("_zero").join(ends, by)
    zero = zero.select(*by, "_k", F.lit(1.0).alias("distance"), F.when(F.col("_k") == F.col("_low"), F.col("_next")).otherwise(F.col("_low")).alias("neighbour"))
    beside_zero = whole.join(ends.filter("_zero_k IS NOT NULL"), by).select(*by, "_k", F.lit(1.0).alias("distance"), F.col("_zero_k").alias("neighbour"))
    found = found.unionByName(zero.filter("neighbour IS NOT NULL")).unionByName(beside_zero)
    best = found.groupBy(*by, "_k").agg(F.min(F.struct("distance", "neighbour")).alias("b"))
    # Copies of a vector are each other's nearest ones, but for zero vectors.
    per_class = classes.join(best, [*by, "_k"], "left")
    full = units.join(per_class, [*by, "_u"])
    twin = F.when(F.col(key) == F.col("_k"), F.col("_second")).otherwise(F.col("_k"))
    own = F.when(F.col("_m") > 1, F.struct(F.when(F.col("_zero"), 1.0).otherwise(0.0).alias("distance"), twin.alias("neighbour")))
    return full.withColumn("b", F.least(own, F.col("b"))).filter("b IS NOT NULL").select(*by, key, "b.neighbour", "b.distance")
