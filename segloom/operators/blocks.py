"""All-against-all work inside a group, without a pair table.

Points of a group are dealt into blocks of bounded size. Every pair of blocks is
one task, which reduces its points to a few rows before anything is shuffled, so
neither a large group nor the square of its size ever meets in one place.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from segloom.runtime import sized

BLOCK = 1024


def with_block(points: DataFrame, by: Iterable[str], key: str, block: int = BLOCK) -> DataFrame:
    """Adds the block number and the number of blocks of the point's group."""
    by = list(by)
    sizes = points.groupBy(*by).agg(F.ceil(F.count("*") / block).cast("int").alias("_blocks"))
    return points.join(sizes, by).withColumn("_block", F.pmod(F.xxhash64(key), F.col("_blocks")).cast("int"))


def over_blocks(
    rows: DataFrame,
    others: DataFrame,
    by: Iterable[str],
    key: str,
    reduce: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame],
    schema: str,
    block: int = BLOCK,
    other_block: int | None = None,
) -> DataFrame:
    """`reduce(rows, others)` for each block of `rows` with each block of `others` of the same group.

    The two sides are dealt into blocks of their own, so a few rows are sent to
    all blocks of the others, and the others to the few blocks of the rows. The
    numbers of blocks are a table of their own, so a large group is dealt where
    its rows are, not in the task of its key.
    """
    by, keys = list(by), [*by, "_i", "_j"]
    others = others.toDF(*others.columns)

    def blocks(side: DataFrame, size: int, name: str) -> DataFrame:
        return side.groupBy(*by).agg(F.ceil(F.count("*") / size).cast("int").alias(name))

    sides = sized(blocks(rows, block, "_is").join(blocks(others, other_block or block, "_js"), by))

    def dealt(side: DataFrame, own: str, of: str, every: str, all_of: str) -> DataFrame:
        at = F.pmod(F.xxhash64(key), F.col(of)).cast("int").alias(own)
        return side.join(sides, by).select(*side.columns, at, F.explode(F.sequence(F.lit(0), F.col(all_of) - 1)).alias(every))

    left, right = dealt(rows, "_i", "_is", "_j", "_js"), dealt(others, "_j", "_js", "_i", "_is")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_reduced_arrow(reduce, schema), schema)


def _reduced_arrow(reduce: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], schema: str):
    """Arrays come and go as Arrow has them: as columns of a pandas function Spark would convert each of them."""
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    run = _reduced(reduce, schema)

    def run_arrow(rows: pa.Table, others: pa.Table) -> pa.Table:
        return pa.Table.from_pandas(run(rows.to_pandas(), others.to_pandas()), schema=arrow, preserve_index=False)

    return run_arrow


def _reduced(reduce: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], schema: str):
    def run(rows: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or others.empty:
            return pd.DataFrame(columns=[f.split()[0] for f in schema.split(", ")])
        return reduce(rows, others)

    return run


def over_block_pairs(
    points: DataFrame,
    by: Iterable[str],
    key: str,
    reduce: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame],
    schema: str,
    block: int = BLOCK,
) -> DataFrame:
    """`reduce(rows, others)` for each ordered pair of blocks of a group.

    Every point meets every other point of its group exactly once as `rows`.
    """
    by = list(by)
    dealt = with_block(points, by, key, block)
    everyone = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    left = dealt.withColumns({"_i": F.col("_block"), "_j": everyone})
    right = dealt.withColumns({"_j": F.col("_block"), "_i": everyone})
    right = right.toDF(*right.columns)  # fresh column identities for the self-cogroup
    keys = [*by, "_i", "_j"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(_reduced(reduce, schema), schema)
