"""Toxicity: held-out recall and precision, odd rows, nothing learned from held-out labels, the label model."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from newsmart.llm import toxicity
from newsmart.llm.langid import held_out

DATA = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")


def test_held_out_accuracy(tables):
    docs, labels = tables
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == docs.count()
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    bad = [r.predicted for r in held if truth[r.doc_id] == 1]
    good = [r.predicted for r in held if truth[r.doc_id] == 0]
    # one in seven texts labelled toxic here has nothing toxic in it
    assert np.mean(bad) >= 0.78 and np.mean(good) <= 0.008
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)


def test_held_out_labels_do_not_count(tables):
    docs, labels = tables
    docs = docs.limit(400)
    spoiled = labels.withColumn("toxic", F.when(held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = (toxicity.toxicity(docs, x).collect() for x in (labels, spoiled))
    assert sorted(map(tuple, one)) == sorted(map(tuple, two))


def test_odd_rows(spark, tables):
    _, labels = tables
    rows = [(1, None, 1), (2, "", 1), (3, "you idiot, you pathetic worthless loser", 1), (4, "fine words " * 50_000, 1), (None, "ok", 1), (3, "fine", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    odd = labels.limit(0).union(spark.createDataFrame([(None, 1, 1), (3, 1, None)], labels.schema))
    got = toxicity.toxicity(docs, odd).collect()  # only the fixed voters
    assert [r.predicted for r in got] == [0, 0, 1, 0, 0, 0]
    kept = toxicity.acceptable_documents(docs, odd)
    assert kept.schema == docs.schema and kept.count() == 5
    assert toxicity.toxicity(docs.limit(0), odd).collect() == []


def test_label_model_finds_the_accuracies():
    r = np.random.default_rng(4)
    y = r.random(3000) < 0.3
    rates = [(0.7, 0.01), (0.5, 0.02), (0.4, 0.01), (0.6, 0.02)]
    votes = np.stack([np.where(y, r.random(3000) < a, r.random(3000) < b) for a, b in rates], axis=1).astype(float)
    noise = (r.random((3000, 1)) < 0.3).astype(float)  # a pattern that says nothing
    q = toxicity.label_model(np.concatenate([votes, votes[:, :1], noise], axis=1), 5, 0.3)
    assert np.mean((q > 0.5) == y) > 0.93


def test_scores_do_not_depend_on_the_batch():
    r = random.Random(1)
    texts = [" ".join(r.choice(["bad", "word", "idiot", "scum", "x"]) for _ in range(r.randint(0, 9))) for _ in range(50)]
    model, column = toxicity.fixed_model(), pa.array(texts)
    one = np.concatenate([model.scores(t) for t in toxicity.chunks(column)])
    many = np.concatenate([model.scores(t) for t in toxicity.chunks(column, 1)])
    assert np.allclose(one, many)
    assert ((one >= 0.7) == [len({"idiot", "scum"} & set(t.split())) > 1 for t in texts]).all()


def test_a_score_is_that_of_the_text_alone():
    r = random.Random(2)
    edges = ["!", "!!", "*", "**", "a", "b*", "a**", "hello there!", "!what is it", "ab", "**x", "", "é", "*!", "idiot!", "* *"]
    texts = [r.choice(edges) + r.choice(["", " ", " fine words "]) + r.choice(edges) for _ in range(400)]
    model = toxicity.fixed_model()
    alone = [float(model.scores(t)[0]) for x in texts for t in toxicity.chunks(pa.array([x]))]
    marks = [tuple(toxicity.patterns(t)[0]) for x in texts for t in toxicity.chunks(pa.array([x]))]
    for order in (range(400), r.sample(range(400), 400)):
        column = pa.array([texts[i] for i in order])
        together = np.concatenate([model.scores(t) for t in toxicity.chunks(column)])
        found = np.concatenate([toxicity.patterns(t) for t in toxicity.chunks(column)])
        assert together.tolist() == [alone[i] for i in order]
        assert [tuple(x) for x in found] == [marks[i] for i in order]
    assert [m[1:] for m in marks] == [("!!" in x, any(x[i : i + 1].isalpha() and x[i + 1 : i + 3] == "**" for i in range(len(x)))) for x in texts]
