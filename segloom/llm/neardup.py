"""MinHash near-dedup with sequential Bayesian verification.

A document's set holds its distinct word shingles. Equal sets are one class.
Class signatures (`HASHES` minima of independent hashes) are cut into bands;
classes that share a band are candidates. A candidate pair is compared a batch
of minima after the other, and dropped as soon as the posterior probability
(uniform prior) that its similarity reaches the limit falls below `MISS`;
survivors are verified on their full sets.

Candidates are not written out as all pairs of a band. In each of `ROUNDS` rounds
every class of a band that holds more than one component meets one member of
another component, and links join components. Then `BEST` rounds compare what is
still apart within a band in blocks inside tasks, where each component keeps
only its likeliest partner by the signatures. At last the blocks come with their
full sets, every pair of different components that passes the signature test is
verified where it stands (in the first band that it shares), and a task gives out
what connects its classes, not its pairs. So a group of k near copies gives some
k rows, and every pair that shares a band is either compared or already
connected.

Cases: null text is empty text; documents without words link with nothing and
are components of their own; a null doc_id has the smallest doc_id of its group
as its component, or null; rows that repeat a doc_id with other texts are
compared each; an empty table gives an empty table; other columns are ignored.
`survivors` gives whole rows, one of each group whatever its doc_ids are, and
all rows without words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segloom.llm.common import query, row_key, table
from segloom.llm.graph import extended, forest
from segloom.llm.textbytes import parts, shingles
from segloom.runtime import cut, sized

BANDS, ROWS = 32, 5
HASHES = BANDS * ROWS
BATCH = 32
MISS = 1e-6
ROUNDS, BEST = 2, 1
BLOCK = 512
_GROUP = 24_000_000  # bytes that a task compares at once, about
_PAIRS = 8_192  # pairs whose signatures are compared at once
_CHARACTERS = 1 << 20  # characters of texts that are cut into shingles at once, about

_MULT = np.random.default_rng(11).integers(0, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Minima of all hashes, a row per set that is not empty."""
    full = [s for s in sets if len(s)]
    out = np.empty((len(full), HASHES), np.uint32)
    at = 0
    while at < len(full):  # some sets at a time, so that they stay in the processor's cache
        end, n = at, 0
        while end < len(full) and (end == at or n + len(full[end]) <= 20_000):
            n += len(full[end])
            end += 1
        flat = np.concatenate(full[at:end])
        starts = np.concatenate([[0], np.cumsum([len(s) for s in full[at : end - 1]])]).astype(np.int64)
        for k in range(HASHES):
            out[at:end, k] = np.minimum.reduceat(((flat * _MULT[k]) >> np.uint64(32)).astype(np.uint32), starts)
        at = end
    return out


def least_matches(percent: int, miss: float = MISS) -> list[int]:
    """For every batch the fewest matches so far with which a pair goes on.

    With a uniform prior, P(similarity >= t | m of n match) = P(Binomial(n + 1, t) <= m).
    """
    t = percent / 100
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        total, m = 0.0, -1
        while total < miss:
            m += 1
            total += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append(m)
    return out


def matching(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, least: list[int]) -> np.ndarray:
    """Matches of the rows a[i] and b[j] of two signature matrices that pass the sequential test; -1 for others.

    Only the columns of one batch of the pairs that are still alive are copied.
    """
    alive = np.arange(len(i))
    matches = np.zeros(len(i), np.int32)
    for k, need in enumerate(least):
        part = slice(k * BATCH, (k + 1) * BATCH)
        matches[alive] += (a[:, part][i[alive]] == b[:, part][j[alive]]).sum(1, dtype=np.int32)
        alive = alive[matches[alive] >= need]
    out = np.full(len(i), -1, np.int32)
    out[alive] = matches[alive]
    return out


def passes(a: np.ndarray, b: np.ndarray, least: list[int]) -> np.ndarray:
    rows = np.arange(len(a))
    return matching(a, b, rows, rows, least) >= 0


def _matrix(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint32).reshape(len(column), HASHES)


def described(docs: DataFrame, size: int) -> DataFrame:
    """(_key, doc_id, n_shingles, node, signature): node stands for the set, null for an empty one."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in parts(batch["text"], _CHARACTERS):
                part = batch.iloc[at]
                sets = shingles(part["text"], size)
                found = iter(signatures(sets))
                nodes = [_node(s) if len(s) else None for s in sets]
                yield pd.DataFrame(
                    {
                        "_key": part["_key"].to_numpy(),
                        "doc_id": part["doc_id"].to_numpy(),
                        "n_shingles": [len(s) for s in sets],
                        "node": pd.array(nodes, dtype="Int64"),
                        "signature": [next(found).tobytes() if len(s) else None for s in sets],
                    }
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInPandas(run, f"_key long, doc_id {kind}, n_shingles long, node long, signature binary")


def _node(shingle_set: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingle_set.tobytes(), digest_size=8).digest(), "big", signed=True)


def _sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(node, shingles) of the rows whose `_key` is in `wanted`, one per node."""
    texts = docs.join(wanted.select("_key"), "_key", "left_semi")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in parts(batch["text"], _CHARACTERS):
                found = shingles(batch["text"].iloc[at], size)
                yield pd.DataFrame({"node": [_node(s) for s in found], "shingles": [s.tobytes() for s in found]}).astype({"node": "int64", "shingles": object})

    made = texts.select("text").mapInPandas(run, "node long, shingles binary")
    # A repeated row brings the same set.
    return made.dropDuplicates(["node"])


def alike(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sets reach the limit."""
    if min(len(x), len(y)) * 100 < percent * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _verified(pairs: DataFrame, table_: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of nodes that reach the limit, as links."""
    least = least_matches(percent)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            batch = batch[passes(_matrix(batch["sa"]), _matrix(batch["sb"]), least)]
            keep = [alike(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent) for x, y in zip(batch["xa"], batch["xb"], strict=True)]
            yield batch.loc[keep, ["a", "b"]] if keep else batch[["a", "b"]]

    left = table_.select(F.col("node").alias("a"), F.col("signature").alias("sa"), F.col("shingles").alias("xa"))
    right = table_.select(F.col("node").alias("b"), F.col("signature").alias("sb"), F.col("shingles").alias("xb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "xa", "sb", "xb").mapInPandas(run, "a long, b long")


def _labelled(buckets: DataFrame, found: DataFrame | None) -> DataFrame:
    """Buckets with each node's component."""
    if found is None:
        return buckets.withColumn("component", F.col("node"))
    return buckets.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _mixed(rows: DataFrame) -> DataFrame:
    """Rows of buckets that hold several components, with a member of the first and of the last one."""
    place = F.struct("component", "node")
    ends = rows.groupBy("bucket").agg(F.min(place).alias("low"), F.max(place).alias("high"), F.count("*").alias("size"))
    return rows.join(ends.where("low.component < high.component"), "bucket")


def _likeliest(found: np.ndarray) -> np.ndarray:
    """Of pairs (a, b, component of a, component of b, matches) each component's with most matches."""
    ends = np.concatenate([found, found[:, [1, 0, 3, 2, 4]]])
    ends = ends[np.lexsort([ends[:, 1], ends[:, 0], -ends[:, 4], ends[:, 2]])]
    return ends[np.r_[True, ends[1:, 2] != ends[:-1, 2]]] if len(ends) else ends


def _apart(rows: DataFrame, table_: DataFrame, percent: int, best: bool) -> DataFrame:
    """Pairs (a, b) of different components within a bucket, block against block.

    With `best`, each component's likeliest partner by the signatures among those that a task compares; else links that connect what the
    verified pairs connect.
    """
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    carried = ["signature"] if best else ["signature", "shingles"]
    dealt = rows.join(table_.select("node", *carried), "node").withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    other = F.explode(F.sequence(F.lit(0), blocks - 1))
    dealt = dealt.select("bucket", "band", "node", "component", *carried, "block", other.alias("other"))
    dealt = dealt.withColumn("part", F.xxhash64("bucket", F.least("block", "other"), F.greatest("block", "other")))
    weight = F.lit(4 * HASHES) if best else F.length("shingles") + 4 * HASHES
    groups = int((dealt.agg(F.sum(weight).alias("n")).first()["n"] or 0) // _GROUP + 1)
    least = least_matches(percent)

    def pairs(s: int, e: int, block, sig, node, comp) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(i, j, matches) of rows s to e that pass, some at a time: all pairs of one block, or those across two."""
        one = block[s] == block[e - 1]
        m = e if one else s + int(np.searchsorted(block[s:e], block[s], "right"))
        j = np.arange(s, e) if one else np.arange(m, e)
        for at in range(s, m, 128):
            i = np.arange(at, min(m, at + 128))
            apart = comp[i][:, None] != comp[j][None, :]
            x, y = np.nonzero(apart & (node[i][:, None] < node[j][None, :]) if one else apart)
            for k in range(0, len(x), _PAIRS):
                left, right = i[x[k : k + _PAIRS]], j[y[k : k + _PAIRS]]
                matches = matching(sig, sig, left, right, least)
                ok = matches >= 0
                yield left[ok], right[ok], matches[ok]

    def run(group: pd.DataFrame) -> pd.DataFrame:
        found = [np.zeros((0, 2), np.int64)]
        top, pending, held = np.zeros((0, 5), np.int64), [], 0
        group = group.sort_values(["part", "block", "node"], ignore_index=True)
        sig, node, comp = _matrix(group["signature"]), group["node"].to_numpy(), group["component"].to_numpy()
        block, part, band = group["block"].to_numpy(), group["part"].to_numpy(), group["band"].to_numpy()
        sets = None if best else [np.frombuffer(x, np.uint64) for x in group["shingles"]]
        edges = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True])
        for s, e in zip(edges[:-1], edges[1:], strict=True):
            for i, j, matches in pairs(s, e, block, sig, node, comp):
                if best:
                    pending.append(np.column_stack([node[i], node[j], comp[i], comp[j], matches]))
                    held += len(i)
                    if held > 16 * _PAIRS:
                        top, pending, held = _likeliest(np.concatenate([top, *pending])), [], 0
                elif len(i):
                    same = (sig[i] == sig[j]).reshape(len(i), BANDS, ROWS).all(2)
                    here = np.flatnonzero(same.argmax(1) == band[s])
                    ok = [k for k in here if alike(sets[i[k]], sets[j[k]], percent)]
                    tied = forest(i[ok], j[ok])
                    found.append(np.column_stack([node[tied[:, 0]], node[tied[:, 1]]]))
        if best:
            found.append(_likeliest(np.concatenate([top, *pending]))[:, :2])
        out = np.unique(np.sort(np.concatenate(found), axis=1), axis=0)
        return pd.DataFrame(out, columns=["a", "b"])

    dealt = dealt.withColumn("group", F.pmod("part", F.lit(groups)))
    return dealt.groupBy("group").applyInPandas(run, "a long, b long").distinct()


def _grouped(own: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Rows as `described` gives them, and (node, _key, doc_id, component) of all nodes, of `own` (_key, doc_id, text).

    A node's `_key` is that of its row with the smallest doc_id, its doc_id the smallest or null.
    """
    rows = cut(described(own, size))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_key")).alias("first")
    classes = rows.where("node IS NOT NULL").groupBy("node").agg(first, F.first("signature").alias("signature"))
    classes = classes.select("node", "first._key", "first.doc_id", "signature")
    bands = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(b, F.substring("signature", b * (4 * ROWS) + 1, F.lit(4 * ROWS))))
    banded = classes.select("node", F.posexplode(bands).alias("band", "bucket"))
    shared = banded.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    buckets = cut(banded.join(shared, "bucket"))
    wanted = buckets.select("node").distinct()
    named = classes.join(wanted, "node", "left_semi")
    table_ = cut(named.join(_sets(own, named, size), "node"))

    found: DataFrame | None = None
    for _ in range(ROUNDS):
        mixed = _mixed(_labelled(buckets, found))
        partner = F.when(F.col("component") != F.col("low.component"), F.col("low.node")).otherwise(F.col("high.node"))
        pairs = mixed.select("node", partner.alias("partner")).groupBy("node").agg(F.min("partner").alias("partner"))
        pairs = pairs.select(F.least("node", "partner").alias("a"), F.greatest("node", "partner").alias("b")).distinct()
        found = extended(found, cut(_verified(pairs, table_, percent)))
    for k in range(BEST + 1):
        left = cut(_mixed(_labelled(buckets, found)).select("bucket", "band", "node", "component", "size"))
        new = _apart(left, table_, percent, best=k < BEST)
        found = extended(found, cut(_verified(new, table_, percent) if k < BEST else new))

    of_node = classes.select("node", "_key", "doc_id").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    return rows, of_node


def near_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row."""
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows, of_node = _grouped(own.withColumn("_key", row_key("doc_id", "text")), size, percent)
    smallest = of_node.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named_nodes = of_node.join(smallest, "component").select("node", "component_id")
    done = rows.select("doc_id", "n_shingles", "node").join(named_nodes, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return done.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def survivors(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs` that stay: exactly one of each group, with its smallest doc_id, and all without words."""
    key = row_key(*[f"`{c}`" for c in docs.columns]).alias("_key")
    own = docs.select(key, F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows, of_node = _grouped(own, size, percent)
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_key")
    best = of_node.groupBy("component").agg(F.min(place).alias("first")).select("first._key")
    counts = rows.where("node IS NOT NULL").groupBy("_key").agg(F.count("*").alias("n"))
    best = cut(best.join(counts, "_key"))
    bare = rows.where("node IS NULL").select("_key").distinct()
    keyed = docs.select(F.struct("*").alias("row"), key)
    single = keyed.join(best.where("n = 1").select("_key").unionAll(bare), "_key", "left_semi")
    # Rows that come more than once in all columns; only these meet their like.
    more = keyed.join(sized(best.where("n > 1").select("_key")), "_key", "left_semi").dropDuplicates(["_key"])
    return single.unionAll(more).select("row.*")


@query("op7_minhash_neardup")
def op7_minhash_neardup(spark, sf_dir):
    """Components of all documents whose four-word shingle sets are 0.8 alike."""
    return near_classes(table(spark, sf_dir, "documents"), size=4)
