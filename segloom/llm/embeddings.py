"""Embedding near-dedup through a pivot-permutation index.

Reference points are drawn from a bounded sample of the vectors (by hash), none
near another, so that a large group of near copies gives one of them. Every vector is described by its `NEAREST` nearest reference points in
order; inverted lists hold, per label and reference point, the vectors that
have it in their description. Two vectors of a list that share `SHARED`
reference points or more (weighted alike) are candidates, and candidates are
verified by their cosine in double precision.

Equal vectors of a label are one class with a count, so copies cost nothing.
Lists are cut into blocks of bounded size and compared block against block
inside tasks; a pair is taken in the list of the smallest reference point that
it shares, so it counts once. Tasks give out, per vector, sums of partners and
one link per partner block at most, never pairs.

Cases: vectors that are null, zero, empty or hold null or non-finite
components, and rows without a label, link with nothing and are components of
their own; vectors of different lengths do not link; rows that repeat a vec_id
are vectors of their own (the smallest vec_id names the component); an empty
table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segloom.llm.common import query, table
from segloom.llm.graph import components, forest
from segloom.runtime import cut

LIMIT = 0.93
NEAREST = 12
SHARED = 2
SAMPLE = 4096  # vectors that reference points are drawn from, at most about
LEAST_PIVOTS, MOST_PIVOTS = 128, 2048
APART = 0.7  # cosine that two reference points do not reach
BLOCK = 1024
_GROUP = 8_000  # rows of list blocks in a task, about
SEED = 3


def usable(vector) -> np.ndarray | None:
    """The vector in double precision, or None if it links with nothing."""
    if vector is None or len(vector) == 0:
        return None
    v = np.asarray(vector, dtype=object)
    if any(x is None for x in v):
        return None
    v = v.astype(np.float64)
    return v if np.isfinite(v).all() and v.any() else None


def described(rows: DataFrame, vec_id: str, embedding: str, label: str) -> DataFrame:
    """(vec_id, label, node, vector): node stands for the label and the vector's values, null if it links with nothing."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            vectors = [usable(v) if lab is not None and lab == lab else None for v, lab in zip(batch["e"], batch["label"], strict=True)]
            raw = [None if v is None else (v + 0.0).tobytes() for v in vectors]  # -0.0 is 0.0
            node = [None if r is None else struct.unpack(">q", hashlib.blake2b(f"{lab}|".encode() + r, digest_size=8).digest())[0] for r, lab in zip(raw, batch["label"], strict=True)]
            yield pd.DataFrame({"vec_id": batch["vec_id"], "label": [None if r is None else str(lab) for r, lab in zip(raw, batch["label"], strict=True)], "node": pd.array(node, dtype="Int64"), "vector": raw})

    # Labels as text, so that nulls of whole numbers stay nulls on the way.
    cols = rows.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("e"), F.col(label).cast("string").alias("label"))
    return cols.mapInPandas(run, f"vec_id {rows.schema[vec_id].dataType.simpleString()}, label string, node long, vector binary")


def reference_points(classes: DataFrame, count: int, dims: int) -> np.ndarray:
    """Unit vectors of a sample that lie apart; how many grows with the square root of `count`, within limits."""
    number = int(min(MOST_PIVOTS, max(LEAST_PIVOTS, 1.5 * count**0.5)))
    near = F.pmod(F.xxhash64("node", F.lit(SEED)), F.lit(1 << 30)) < int((1 << 30) * min(1.0, SAMPLE / max(1, count)))
    got = classes.where(near).select("node", "vector").toPandas().sort_values("node")
    x = _unit(np.frombuffer(b"".join(got["vector"]), np.float64).reshape(len(got), dims))
    x = x[np.random.default_rng(SEED).permutation(len(x))]
    chosen = x[:0]
    for at in range(0, len(x), 64):
        for v in x[at : at + 64][((x[at : at + 64] @ chosen.T) < APART).all(1)]:
            if len(chosen) < number and ((chosen @ v) < APART).all():
                chosen = np.concatenate([chosen, v[None]])
    return chosen


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # lengths of very large or small vectors stay finite
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def listed(classes: DataFrame, pivots: np.ndarray, nearest: int = NEAREST) -> DataFrame:
    """The inverted lists: (pivot, label, node, count, vector, described); `described` has the nearest points in order."""
    dims = pivots.shape[1]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = _unit(np.frombuffer(b"".join(batch["vector"]), np.float64).reshape(len(batch), dims)) if len(batch) else np.zeros((0, dims))
            take = min(nearest, len(pivots))
            out = []
            for at in range(0, len(x), 2048):
                s = x[at : at + 2048] @ pivots.T
                top = np.argpartition(-s, take - 1, axis=1)[:, :take]
                order = np.argsort(-np.take_along_axis(s, top, 1), axis=1, kind="stable")
                out += [t.astype(np.int32).tobytes() for t in np.take_along_axis(top, order, 1)]
            yield batch.assign(described=out)

    with_points = cut(classes.mapInPandas(run, "node long, label string, count long, vector binary, described binary"))
    places = F.sequence(F.lit(0), (F.length("described") / 4).cast("int") - 1)
    point = F.transform(places, lambda i: F.hex(F.substring("described", i * 4 + 1, F.lit(4))))
    return with_points.select("*", F.explode(point).alias("pivot"))


def _links(lists: DataFrame, pivots: int, dims: int, limit: float, shared: int) -> DataFrame:
    """Rows (node, partners, a, b): partners found by a task, or a link."""
    sizes = lists.groupBy("label", "pivot").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = lists.join(sizes, ["label", "pivot"]).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.withColumn("part", F.xxhash64("label", "pivot", F.least("block", "other"), F.greatest("block", "other")))
    groups = max(1, dealt.count() // _GROUP + 1)

    def compare(x, has, y, has_y, point, upper) -> np.ndarray:
        """Which pairs of two blocks of a list are links that this list counts."""
        common = has @ has_y.T
        earlier = has[:, :point] @ has_y[:, :point].T if point else np.zeros_like(common)
        ok = (common >= shared) & (earlier == 0)
        if upper:
            ok = np.triu(ok, 1)
        return ok & (x @ y.T >= limit) if ok.any() else ok

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["part", "block", "node"], ignore_index=True)
        x = _unit(np.frombuffer(b"".join(group["vector"]), np.float64).reshape(len(group), dims))
        near = np.frombuffer(b"".join(group["described"]), np.int32).reshape(len(group), -1)
        has = np.zeros((len(group), pivots), np.float32)
        has[np.arange(len(group))[:, None], near] = 1
        node, count = group["node"].to_numpy(), group["count"].to_numpy()
        part, block = group["part"].to_numpy(), group["block"].to_numpy()
        total = np.zeros(len(group), np.int64)
        links = []
        edges = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True])
        for s, e in zip(edges[:-1], edges[1:], strict=True):
            point = int(np.frombuffer(bytes.fromhex(group["pivot"].iat[s]), np.int32)[0])
            upper = block[s] == block[e - 1]
            if upper and group["other"].iat[s] != block[s]:
                continue  # the other block is empty
            m = e if upper else s + int(np.searchsorted(block[s:e], block[s], "right"))
            left, right = slice(s, m), slice(s, e) if upper else slice(m, e)
            found = compare(x[left], has[left], x[right], has[right], point, upper)
            total[left] += found @ count[right]
            total[right] += found.T @ count[left]
            i, j = np.nonzero(found)
            links.append(forest(i + left.start, j + right.start))
        pairs = np.concatenate(links) if links else np.zeros((0, 2), np.int64)
        some = np.flatnonzero(total)
        return pd.concat(
            [
                pd.DataFrame({"node": node[some], "partners": total[some]}).assign(a=pd.NA, b=pd.NA),
                pd.DataFrame({"a": node[pairs[:, 0]], "b": node[pairs[:, 1]]}).assign(node=pd.NA, partners=pd.NA),
            ]
        ).astype("Int64")[["node", "partners", "a", "b"]]

    dealt = dealt.withColumn("group", F.pmod("part", F.lit(groups)))
    return dealt.groupBy("group").applyInPandas(run, "node long, partners long, a long, b long")


def near_vectors(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", limit: float = LIMIT, nearest: int = NEAREST, shared: int = SHARED) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row."""
    all_ = cut(described(rows, vec_id, embedding, label))
    classes = all_.where("node IS NOT NULL").groupBy("node").agg(F.min("vec_id").alias("first"), F.count("*").alias("count"), F.first("label").alias("label"), F.first("vector").alias("vector"))
    classes = cut(classes)
    found = None
    for size in sorted(r[0] for r in classes.select(F.length("vector")).distinct().collect()):  # lengths of vectors: one, as a rule
        own = classes.where(F.length("vector") == size)
        pivots = reference_points(own, own.count(), size // 8)
        lists = listed(own.select("node", "label", "count", "vector"), pivots, nearest)
        part = _links(lists, len(pivots), size // 8, limit, min(shared, nearest, len(pivots)))
        found = part if found is None else found.unionAll(part)
    if found is None:
        found = rows.sparkSession.createDataFrame([], "node long, partners long, a long, b long")
    found = cut(found)
    sums = found.where("node IS NOT NULL").groupBy("node").agg(F.sum("partners").alias("partners"))
    joined = classes.select("node", "first", "count").join(sums, "node", "left").join(components(found.where("a IS NOT NULL").select("a", "b")), "node", "left")
    joined = joined.withColumn("component", F.coalesce("component", "node"))
    smallest = joined.groupBy("component").agg(F.min("first").alias("component_id"))
    per_node = joined.join(smallest, "component").select("node", "component_id", (F.coalesce("partners", F.lit(0)) + F.col("count") - 1).alias("n_links"))
    done = all_.select("vec_id", "node").join(per_node, "node", "left")
    component = F.coalesce("component_id", "vec_id")
    return done.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


@query("op5_embedding_neardup")
def op5_embedding_neardup(spark, sf_dir):
    """Links and components of all vectors of equal label."""
    return near_vectors(table(spark, sf_dir, "embeddings"))
