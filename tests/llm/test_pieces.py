import random

import pytest
import sentencepiece
from pyspark.sql import functions as F

from segloom.llm import pieces

ODD = [
    "", " ", "  ", "hello  world", "  lead", "trail  ", "a\nb\tc", "Ünïcödé 漢字 😀 <s> </s> <unk>", "▁x", "x▁▁y", "\x00a", "a" * 500,
    " " * 37 + "x" + " " * 5, "!!!!====----", "straightforwardly, representations 1234567890", "é" * 40, " ".join("ab" * 30), " " * 31, " " * 32,
]


@pytest.fixture(scope="module")
def tool():
    return pieces.Encoder(pieces.default_model())


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())


def test_odd_texts(tool, library):
    assert [x.tolist() for x in tool.encode(ODD)] == library.encode(ODD)


def test_random_texts(tool, library):
    rng = random.Random(3)
    letters = ["a", "b", "e", "t", "h", " ", "s", "i", "n", "g", "é", "ж", "_", "-", " ", "o", "r", "漢", "字"]
    words = [tool.v.pieces[i].replace("▁", " ") for i in tool.v.order]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(3000)]
    texts += ["".join(rng.choice(words) for _ in range(rng.randint(1, 12))) for _ in range(6000)]
    assert [x.tolist() for x in tool.encode(texts)] == library.encode(texts)


def test_memory_of_words_changes_nothing(tool, library, monkeypatch):
    monkeypatch.setattr(pieces, "_KNOWN", 3)
    monkeypatch.setattr(pieces, "_BATCH", 40)
    texts = ["the cat sat on the mat " * 3, "the dog", "on the mat"] * 5
    assert [x.tolist() for x in tool.encode(texts)] == library.encode(texts)


def test_decoding(tool, library):
    ids = library.encode(ODD) + [[0, 1, 2, 13], [3 + 0xE6], [259, 259]]
    assert [pieces.decode(tool.v, x) for x in ids] == [library.decode(x) for x in ids]


def test_round_trip_on_spark(docs, clashing, no_docs, rows, library):
    got = pieces.decoded(pieces.encoded(docs)).collect()
    assert all(r.decoded == r.text for r in got)
    assert all((r.ids is None) == (r.text is None) for r in got)
    assert all(r.ids == library.encode(r.text) for r in got if r.text is not None)
    assert pieces.encoded(clashing.drop("ids")).where(F.size("ids") >= 0).count() == sum(r[1] is not None for r in rows)
    assert pieces.encoded(no_docs).collect() == []


def test_documents(spark, sf, library):
    got = pieces.op4_sentencepiece(spark, sf).collect()
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(got) == len(text)
    assert all(r.ids == library.encode(text[r.doc_id]) and r.round_trip and r.n_ids == len(r.ids) for r in got)
