"""Mixing sources to target weights by blocks.

The words of a source, documents in order, are one stream that is cut into
blocks of `block` words. Slots of the mixture are dealt over output shards:
how many slots of a shard each source gets is a multinomial draw under the
condition that the totals are the sources' quotas, made by halving the range
of shards again and again, so that any shard's counts (and where its slots
start in each source's sequence) follow from the seed alone. Slot k of a
source is block p(k mod n) of its n blocks, p a keyed permutation of the
indices that differs for each pass, and slots meet blocks by (source, block).
A block is so taken once per full pass over its source.

Targets: sources by code point (null last) have the weights 5, 2, 1 repeating
and share `share` times all words; no target is above `most` times its
source's words, and what is above goes to the others by weight.

Cases: null text has no words and is taken as it is never; null source is a
source; repeated rows are documents of their own; an empty table, or one
without words, gives targets of 0; other columns are ignored (`mixed_documents`
passes lang and the like through). Reruns agree.

The list of sources (one weight each) is held by the driver; texts, blocks and
slots never are.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segloom.llm.common import GAP, WORD, let, query, row_key, running_start, table
from segloom.runtime import cut

BLOCK = 256  # words
SHARD = 4096  # slots
WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2
SEED = 20
SPACE = " \t\n\v\f\r"
_EXACT = 5e8  # numpy draws up to this many; a larger range is halved in proportion


def shared(sizes: list[int], weights: list[float], total: float, most: float = MOST) -> list[float]:
    """Targets by weight, each at most `most` times its size, the excess going to the others by weight."""
    target = [0.0] * len(sizes)
    open_ = [i for i, n in enumerate(sizes) if n > 0]
    left = float(total)
    while open_:
        whole = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / whole > most * sizes[i]]
        if not full:
            for i in open_:
                target[i] = left * weights[i] / whole
            break
        for i in full:
            target[i] = float(most * sizes[i])
        left -= sum(target[i] for i in full)
        open_ = [i for i in open_ if i not in full]
    return target


def _half(rng: np.random.Generator, quota: np.ndarray, n: int) -> np.ndarray:
    """How many of each source's slots are among the first n, all orders of slots being alike."""
    whole = int(quota.sum())
    if whole < _EXACT:
        return rng.multivariate_hypergeometric(quota, n, method="marginals")
    share = quota * (n / whole)
    out = np.floor(share).astype(np.int64)
    out[np.argsort(out - share, kind="stable")[: n - int(out.sum())]] += 1
    return out


def shard_counts(shard: int, shards: int, quota: np.ndarray, size: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(slots of each source in the shard, slots of each source in earlier shards)."""
    lo, hi, start = 0, shards, np.zeros_like(quota)
    while hi - lo > 1:
        mid = (lo + hi) // 2
        left = _half(np.random.default_rng([seed, lo, hi]), quota, min(int(quota.sum()), (mid - lo) * size))
        if shard < mid:
            quota, hi = left, mid
        else:
            start, quota, lo = start + left, quota - left, mid
    return quota, start


def permuted(k: np.ndarray, n: int, key: int) -> np.ndarray:
    """A keyed permutation of 0..n-1 at k: a Feistel network on the next even number of bits, walked until below n."""
    half = max(1, ((max(n - 1, 1)).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = np.random.default_rng([key]).integers(0, 2**63, 4, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & mask
        for c in keys:
            mixed = (right + np.uint64(0x9E3779B9)) * c
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((mixed >> np.uint64(32)) & mask)
        return (left << np.uint64(half)) | right

    out = once(k.astype(np.uint64))
    while (far := out >= np.uint64(n)).any():
        out[far] = once(out[far])
    return out.astype(np.int64)


def source_plan(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, block: int = BLOCK) -> pd.DataFrame:
    """One row per source: source, number, source_size, target, blocks, quota (slots)."""
    found = sized.groupBy("source").agg(F.sum("size").alias("n")).collect()  # a row per source
    found = sorted(((r["source"], int(r["n"])) for r in found), key=lambda x: (x[0] is None, x[0] or ""))
    sizes = [n for _, n in found]
    target = shared(sizes, [weights[i % len(weights)] for i in range(len(sizes))], share * sum(sizes), most)
    blocks = [-(-n // block) for n in sizes]
    # A source's blocks have size/blocks words on average, as its last block is short.
    quota = [min(int(most) * b, round(t * b / n)) if n else 0 for t, n, b in zip(target, sizes, blocks, strict=True)]
    return pd.DataFrame({"source": [s for s, _ in found], "number": range(len(found)), "source_size": sizes, "target": target, "blocks": blocks, "quota": quota})


def slots(spark, plan: pd.DataFrame, shard: int = SHARD, seed: int = SEED) -> DataFrame:
    """The mixture: shard, number (of the source), pass, block; one row per slot."""
    quota, blocks = plan["quota"].to_numpy(np.int64), plan["blocks"].to_numpy(np.int64)
    total = int(quota.sum())
    shards = max(1, -(-total // shard))

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for s in batch["id"]:
                count, start = shard_counts(int(s), shards, quota, shard, seed)
                for i in np.flatnonzero(count):
                    k = np.arange(start[i], start[i] + count[i])
                    at, pass_ = k % blocks[i], k // blocks[i]
                    index = np.empty(len(k), np.int64)
                    for p in np.unique(pass_):
                        index[pass_ == p] = permuted(at[pass_ == p], int(blocks[i]), seed * 1_000_003 + int(i) * 1009 + int(p))
                    yield pd.DataFrame({"shard": int(s), "number": int(i), "pass": pass_, "block": index})

    return spark.range(0, shards if total else 0, numPartitions=max(1, min(shards, 2000))).mapInPandas(draw, "shard long, number int, pass long, block long")


def packed_blocks(sized: DataFrame, plan: pd.DataFrame, block: int = BLOCK) -> DataFrame:
    """What each block holds: number, block, doc_id, row, key, first (word of the document, from 0), words."""
    spark = sized.sparkSession
    numbers = spark.createDataFrame([(s, int(n)) for s, n in zip(plan["source"], plan["number"], strict=True)], "name string, number int")
    placed = running_start(sized.where("size > 0"), "source", ["doc_id", "row"], "size")
    placed = placed.join(F.broadcast(numbers), F.col("source").eqNullSafe(F.col("name"))).drop("name")
    last = F.floor((F.col("start") + F.col("size") - 1) / block)
    each = placed.select("number", "doc_id", "row", "key", "size", "start", F.explode(F.sequence(F.floor(F.col("start") / block), last)).alias("block"))
    begin = F.greatest(F.col("block") * block, F.col("start"))
    end = F.least((F.col("block") + 1) * block, F.col("start") + F.col("size"))
    return each.select("number", "block", "doc_id", "row", "key", (begin - F.col("start")).alias("first"), (end - begin).alias("words"))


def whole_key(columns: Iterable[str]):
    """A key of all values of a row, so that rows that differ in any column stay apart."""
    return row_key(*[f"`{c}`" for c in columns])


def sized(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", keyed: Iterable[str] | None = None) -> DataFrame:
    """doc_id, row (a number), key (of the row's values in the columns `keyed`), source, size (words), as a written table."""
    key = whole_key(keyed if keyed is not None else (doc_id, source, text)).alias("key")
    cols = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(source).alias("source"), key)
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return cut(cols.select("doc_id", F.monotonically_increasing_id().alias("row"), "key", "source", size.alias("size")))


def mix(sizes: DataFrame, plan: pd.DataFrame, block: int = BLOCK, shard: int = SHARD, seed: int = SEED) -> DataFrame:
    """Slots with what their blocks hold: shard, pass, number, block, doc_id, row, key, first, words."""
    return slots(sizes.sparkSession, plan, shard, seed).hint("merge").join(packed_blocks(sizes, plan, block), ["number", "block"])


def stretches(text: Column, ranges: Column) -> Column:
    """The text of each range (first word, words) with the white space between its words; a range of all words is the whole text.

    Texts stay in Spark's rows: batches of whole texts for Python would add to the memory of both sides.
    """

    def cut_out(tokens: Column) -> Column:
        def one(r: Column) -> Column:
            some = F.slice(tokens, (r["first"] + 1).cast("int"), r["words"].cast("int"))
            return F.when(r["words"] == F.size(tokens), text).otherwise(F.rtrim(F.array_join(some, ""), F.lit(SPACE)))

        return F.transform(ranges, one)

    return let(F.regexp_extract_all(text, F.lit(f"{WORD}(?:{GAP})?"), F.lit(0)), cut_out)


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The mixture as rows with the columns of `docs`.

    Neighbouring words of a document that a pass takes come as one row, cut out
    of the text with the white space between them; a document taken whole keeps
    its text. `n_chars`, where there is such a column, is set anew.
    """
    sizes = sized(docs, keyed=docs.columns)
    plan = source_plan(sizes)
    taken = mix(sizes, plan, **settings)
    # A range that starts where the one before it ends goes on with its stretch.
    inside = Window.partitionBy("row", "key", "pass").orderBy("first")
    ends = F.lag(F.col("first") + F.col("words")).over(inside)
    marked = taken.select("row", "key", "pass", "first", "words", F.when(ends == F.col("first"), 0).otherwise(1).alias("_new"))
    joined = marked.withColumn("_stretch", F.sum("_new").over(inside)).groupBy("row", "key", "pass", "_stretch").agg(F.min("first").alias("first"), F.sum("words").alias("words"))
    runs = joined.groupBy("row", "key", "pass").agg(F.collect_list(F.struct("first", "words")).alias("_ranges"))
    # Rows that repeat in all columns share a key, so one of them stands for all.
    whole = docs.select(F.struct("*").alias("_row"), whole_key(docs.columns).alias("key")).dropDuplicates(["key"])
    rows = whole.join(runs.select("key", "_ranges"), "key")
    done = rows.select("_row", F.explode(stretches(F.col("_row.text"), F.col("_ranges"))).alias("_text"))
    out = {c: F.col("_row")[c] for c in docs.columns} | {"text": F.col("_text")}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.length("_text").cast(docs.schema["n_chars"].dataType)
    return done.select(*[v.alias(c) for c, v in out.items()])


@query("op9_source_mixing")
def op9_source_mixing(spark, sf_dir):
    """Words of every document that the mixture takes."""
    sizes = sized(table(spark, sf_dir, "documents"))
    plan = source_plan(sizes)
    times = slots(spark, plan).groupBy("number", "block").agg(F.count("*").alias("times"))
    # Counts compress so well that their shuffle looks small enough for a broadcast; both sides grow with the words.
    taken = times.hint("merge").join(packed_blocks(sizes, plan), ["number", "block"]).groupBy("row").agg(F.sum(F.col("times") * F.col("words")).alias("taken"))
    known = spark.createDataFrame([(s, int(n), float(t)) for s, n, t in zip(plan["source"], plan["source_size"], plan["target"], strict=True)], "name string, source_size long, target double")
    rows = sizes.join(F.broadcast(known), F.col("source").eqNullSafe(F.col("name"))).join(taken, "row", "left")
    return rows.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
