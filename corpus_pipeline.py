"""A corpus from `documents`: toxic texts go, boilerplate lines go, one of each group of near copies stays, sources are mixed, texts become ids.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of `documents`.
Nulls, empty and long texts, repeated rows and empty tables are as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segloom.llm import lines, mixing, neardup, pieces, toxicity
from segloom.llm.common import table
from segloom.runtime import cut

SHINGLE, PERCENT = 5, 80
BATCH_ROWS = 1_000  # whole texts that Python gets at once


def small_batches(spark: SparkSession) -> None:
    """For this session: batches for Python of BATCH_ROWS rows at most, as worker and executor each hold a batch's texts several times over."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    rows = int(spark.conf.get(name))
    if not 0 < rows <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon, learnt from the labels, scores below 0.5."""
    small_batches(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return toxicity.scored(docs.select(F.struct("*").alias("row"), "text"), model).where("predicted = 0").select("row.*")


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that are boilerplate among the different texts of their source; n_chars set anew."""
    # Columns of the documents that have the names of the operator's counts stand aside meanwhile.
    aside = {c: f"_own_{c}" for c in ("n_lines", "n_dropped") if c in docs.columns}
    cleaned = lines.drop_boilerplate(docs.withColumnsRenamed(aside), "text", "source").drop("n_lines", "n_dropped")
    back = cleaned.withColumnsRenamed({v: k for k, v in aside.items()})
    return back.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, with its smallest doc_id; all documents without words."""
    small_batches(spark)
    return neardup.survivors(docs, size=SHINGLE, percent=PERCENT)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: a row for each stretch of a document that a pass over its source takes."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, ids and their number of every row."""
    small_batches(spark)
    return pieces.encoded(docs.select("doc_id", "source", "text")).select("doc_id", "source", "ids", F.size("ids").cast("long").alias("n_ids"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_boilerplate),
    ("MinHash near-dedup", drop_near_copies),
    ("mixing sources", mix_sources),
    ("SentencePiece", encode),
]

#: No stage but the second has SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
