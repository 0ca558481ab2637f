import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, letters="abcdefghij"):
    return ["".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n)]


@pytest.fixture(scope="session")
def rows():
    """(doc_id, text, lang, source, n_chars): null and empty texts, copies, near copies, a long text, a null source."""
    rng = random.Random(4)
    head = " ".join(words(rng, 40))
    base = [" ".join(words(rng, rng.randint(1, 120))) for _ in range(25)]
    base += [head + "\n" + b for b in base[:10]]
    base += [None, "", "   ", "\n\n", "one", "One", "deux mots", "été à la plage 😀 " * 3, "a" * 3000, "ab " * 2000, " ".join(words(rng, 6000))]
    base += base[3:9]
    for b in base[10:20]:
        w = b.split(" ")
        base.append(" ".join([*w[:-1], "changed"]))
    rng.shuffle(base)
    return [(i * 3, t, "en", None if i % 7 == 0 else f"s{i % 4}", None if t is None else len(t)) for i, t in enumerate(base)]


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(docs):
    """The same rows with columns that are named like inner ones."""
    from pyspark.sql import functions as F

    names = ("key", "row", "node", "size", "words", "pos", "start", "bucket", "score", "ids", "n_lines", "count", "label", "vector", "_key", "_text", "_range", "block")
    return docs.withColumns({n: F.lit("x") for n in names})
