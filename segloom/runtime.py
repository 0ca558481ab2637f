"""Session helpers: shared scratch folder, lineage cuts, size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A lookup table is broadcast only when a count shows that it has at most this
# many rows; a larger one goes through an ordinary shuffle join, where adaptive
# execution splits hot keys.
BROADCAST_ROWS = 100_000


def session(app: str = "segloom", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach.

    The cluster names it in spark.checkpoint.dir. A folder of our own is made
    only for a single-JVM session, where the driver is also the executor.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    named = named or context.getCheckpointDir()
    if named:
        return named
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="segloom-"))
    return context.getCheckpointDir()


_SCOPE: ContextVar[str | None] = ContextVar("scope", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{_SCOPE.get() or shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Tables cut inside go to one folder, which is removed at the end: for jobs that run again and again.

    What the job gives back must be written (or collected) before the end.
    """
    path = scratch_path(spark, "scope")
    token = _SCOPE.set(path)
    try:
        yield path
    finally:
        _SCOPE.reset(token)
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def cut(df: DataFrame) -> DataFrame:
    """Write the rows to a table in the shared folder and go on from there.

    A lost executor costs nothing that was written, the plan starts afresh, and
    the table's size is known to the planner.
    """
    path = scratch_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Rows that a task of `spread` gets on average.
TASK_ROWS = 200_000


def spread(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """Rows of equal keys together, in as many parts as `rows` (about their number) asks for.

    Parts that follow from Spark's defaults grow with the table up to 64 MB as shuffled, and what a
    task makes of them in memory is many times that. Groups by these keys need no further shuffle.
    """
    return df.repartition(max(1, -(-rows // TASK_ROWS)), *keys)


# Bytes on disk below which a table of few rows may be broadcast; columns of few rows can still be wide.
BROADCAST_BYTES = 64 << 20


def sized(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Cut `df`, and mark it for broadcast only if its rows and its bytes are few."""
    table = cut(df)
    return F.broadcast(table) if table.count() <= limit and written_bytes(table) <= BROADCAST_BYTES else table


def written_bytes(table: DataFrame) -> int:
    """Size of the files behind a table that was read from files."""
    return int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def beside(rows: DataFrame, one_row: DataFrame) -> DataFrame:
    """Appends the columns of a single-row table (an ungrouped aggregate) to every row."""
    key = "_beside"
    # An aggregate with a constant key has one row whatever it is given; more rows are an error, not a broadcast.
    single = one_row.withColumn(key, F.lit(0)).limit(2)
    return rows.withColumn(key, F.lit(0)).join(F.broadcast(single), key).drop(key)
