import random
import zlib

import pytest
from pyspark.sql import functions as F

from segloom.llm import toxicity


def test_fold():
    assert toxicity.fold("1D10T $tupid m0r0n.") == "idiot stupid moron."
    assert toxicity.fold("ѕсum ＳＣＵＭ śćúm") == "scum scum scum"
    assert toxicity.fold("in 1234 of 2024") == "in 1234 of 2024"
    assert toxicity.fold("word$$$ x!") == "word    x "
    assert toxicity.fold("") == ""


def test_boundaries_and_exceptions():
    model = toxicity.Model({"trash": 3.0, "clown": 2.0}, ("trash can",), 0.0, (1.0, 0.0))
    found = lambda t: toxicity._spans(model.automaton(), toxicity.fold(t))
    assert found("trash") == (3.0, 1)
    assert found("trashy strash") == (0, 0)
    assert found("a trash can, a clown") == (2.0, 1)
    assert found("trash cans") == (3.0, 1)
    assert found("TR4SH! (clown)") == (5.0, 2)


def made(spark, n=1500):
    rng = random.Random(8)
    bad = ["zorg", "blarf", "quux"]
    rows = []
    for i in range(n):
        w = ["".join(rng.choice("abcdef") for _ in range(5)) for _ in range(rng.randint(5, 60))]
        toxic = i % 4 == 0
        if toxic:
            w.insert(rng.randrange(len(w)), rng.choice(bad).replace("o", rng.choice(["o", "0"])).upper())
        elif i % 140 == 1:
            w[1:1] = ["zorg", "bay"]  # harmless together
        rows.append((i, " ".join(w), int(toxic)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    return docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int"), rows


def test_held_out(spark):
    docs, labels, rows = made(spark)
    model = toxicity.fit(docs, labels)
    assert set(model.weights) == {"blarf", "quux", "zorg"} and "zorg bay" in model.exceptions
    got = {r.doc_id: r for r in toxicity.scored(docs, model).withColumn("h", toxicity.held_out()).collect()}
    assert all(r.h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    test = [(r.predicted, rows[i][2]) for i, r in got.items() if r.h]
    assert sum(a == b for a, b in test) / len(test) > 0.98


def test_held_out_labels_are_not_used(spark):
    docs, labels, _ = made(spark, 300)
    other = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.fit(docs, labels) == toxicity.fit(docs, other)


def test_accuracy_on_the_tables(spark):
    read = lambda t: spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet")
    docs, labels = read("documents").select("doc_id", "text"), read("labels")
    model = toxicity.fit(docs, labels)
    got = toxicity.scored(docs, model).where(toxicity.held_out()).join(labels.select("doc_id", "toxic"), "doc_id").groupBy("toxic").agg(F.avg((F.col("predicted") == F.col("toxic")).cast("double")).alias("right"), F.count("*").alias("n")).collect()
    right = {r.toxic: r.right for r in got}
    # English toxic texts carry the words; others' labels follow nothing that a word can show.
    assert right[0] > 0.98 and right[1] > 0.5


@pytest.mark.parametrize("labels", [[], [(1, None)], [(1, 0), (2, 0)], [(None, 1)]])
def test_without_usable_labels(spark, labels, docs):
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert not model.weights
    assert {r.predicted for r in toxicity.scored(docs, model).collect()} == {0}


def test_odd_rows(spark, no_docs, clashing, rows):
    docs, labels, _ = made(spark, 300)
    model = toxicity.fit(docs, labels)
    assert toxicity.scored(no_docs, model).collect() == []
    assert toxicity.scored(clashing.drop("score"), model).where("score >= 0 AND score <= 1").count() == len(rows)
    rows = spark.createDataFrame([(None, None), (None, ""), (1, "blarf " * 50000), (1, "blarf " * 50000)], "doc_id long, text string")
    got = toxicity.scored(rows, model).select("score", toxicity.held_out().alias("h")).collect()
    assert got[0] == got[1] and got[2] == got[3] and got[2].score > 0.5 > got[0].score
