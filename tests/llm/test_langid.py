"""Language identification: held-out accuracy, defined answers for odd texts, nothing learned from held-out rows."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from newsmart.llm import langid

DOCS = "/root/testdata/sf0.01/documents.parquet"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(DOCS)


def test_held_out_accuracy(documents):
    truth = {r.doc_id: r.lang for r in documents.select("doc_id", "lang").collect()}
    got = langid.languages(documents).collect()
    assert len(got) == len(truth)
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) >= 0.97
    assert all(0 <= r.score <= 1 for r in got)
    assert np.mean([r.accepted for r in held]) > 0.9


def test_odd_rows(spark, documents):
    rows = [(1, None, "en", 5), (2, "", "en", 5), (3, "123 !? ٣ ½", "en", 5), (4, "the and of " * 40_000, None, 5), (None, "the thing of", "en", 5), (4, "é", None, 5)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    model = langid.fit(documents, most=60)
    got = langid.predict(odd, model).collect()
    assert [(r.lang_pred, r.score, r.accepted) for r in got[:3]] == [("und", 0.0, False)] * 3
    assert got[3].lang_pred == "en" and got[5].lang_pred != "und" and got[4].doc_id is None
    whole = langid.languages(odd.withColumnRenamed("score", "x"))
    assert whole.columns == ["doc_id", "held_out", "lang_pred", "score", "accepted"] and whole.count() == 6


def test_nothing_to_learn_from(spark):
    rows = spark.createDataFrame([(1, "some text", None), (2, "more", "")], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in langid.languages(rows).collect()} == {"und"}
    assert langid.languages(rows.limit(0)).collect() == []


def test_held_out_labels_do_not_count(spark, documents):
    from pyspark.sql import functions as F

    spoiled = documents.withColumn("lang", F.when(langid.held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang")))
    assert sorted(map(tuple, langid.languages(spoiled).collect())) == sorted(map(tuple, langid.languages(documents).collect()))


def test_a_text_scores_the_same_alone_and_among_others():
    texts = [b"the and of in " * 30, b"der die das und " * 30] * 6
    model = langid.train(texts, ["en", "de"] * 6)
    column = pa.array(["the of", "", "der", "x", "das und die", "a"])
    together = np.concatenate([model.probabilities(t) for t in langid.chunks(column)])
    alone = np.concatenate([model.probabilities(t) for t in langid.chunks(column, 1)])
    assert np.allclose(together, alone)


def test_every_language_is_learned(spark):
    ids = [i for i in range(4000) if zlib.crc32(str(i).encode()) % 3 != 1]
    rows = [(i, f"text number {i}", f"l{n % 500}" if n < 1000 else "many") for n, i in enumerate(ids)]
    sample = langid.labelled_sample(spark.createDataFrame(rows, "doc_id long, text string, lang string"), "doc_id", "text", "lang")
    assert {x for _, x in sample} == {f"l{n}" for n in range(500)} | {"many"}
    assert 300 < sum(x == "many" for _, x in sample) < 700  # about TOTAL / 501


def test_scores_of_many_languages_are_those_of_all_at_once(monkeypatch):
    texts, names = [f"word{i} text{i} ".encode() * 9 for i in range(120)], [f"l{i % 40}" for i in range(120)]
    model = langid.train(texts, names)
    (some,) = langid.chunks(pa.array([t.decode() for t in texts[:9]] + [""]))
    parts = model.probabilities(some)
    monkeypatch.setattr(langid, "ABREAST", 1000)
    assert parts.shape == (10, 40) and np.allclose(parts, model.probabilities(some))
