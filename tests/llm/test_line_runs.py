"""Line dedup against a plain computation."""

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from newsmart.llm import line_runs
from newsmart.llm.arrow import Stage

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)


def expected(docs):
    n, keeper = defaultdict(int), defaultdict(lambda: float("-inf"))
    for d, t in docs:
        for k in {key(x) for x in (t or "").split("\n")}:
            n[k] += 1
            keeper[k] = max(keeper[k], float("-inf") if d is None else d)
    out = []
    for d, t in docs:
        lines = (t or "").split("\n")
        own = float("-inf") if d is None else d
        kept = [x for x in lines if len(key(x)) < 40 or n[key(x)] < 5 or own >= keeper[key(x)]]
        out.append((d, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def case(seed, n=120):
    r = random.Random(seed)
    pool = ["".join(r.choice("abcdé 日") for _ in range(r.choice([5, 38, 39, 40, 41, 60, 200]))) for _ in range(25)]
    edges = ["", " ", "\t", "\x0b\x0c", "\r", " ", "\x1c"]
    docs = []
    for d in r.sample(range(10_000), n):
        lines = [r.choice(edges) + (x.upper() if r.random() < 0.3 else x) + r.choice(edges) for x in r.choices(pool, k=r.randint(0, 12))]
        docs.append((d, "\n".join(lines) + r.choice(["", "\n", "\n\n"])))
    return docs + [(20_000, None), (20_001, ""), (20_002, "\n" * 50), (docs[0][0], docs[0][1]), (docs[1][0], pool[3] * 2), (None, pool[7] + "\n" + pool[8]), (None, None)]


def digest(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_plain(spark, seed):
    docs = case(seed)
    df = spark.createDataFrame([(*x, "s") for x in docs], "doc_id long, text string, drop string").repartition(3)
    got = line_runs.line_dedup(df)
    assert got.columns == ["doc_id", "n_lines", "n_dropped", "kept_sha256"]
    assert digest(got.collect()) == expected(docs)


def test_a_line_in_a_third_of_the_documents(spark):
    line = "this very common line is found in every third document"
    docs = [(i, (line + "\n" if i % 3 == 0 else "") + f"own line {i}") for i in range(3000)]
    assert digest(line_runs.line_dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()) == expected(docs)


def test_only_rows_without_ids(spark):
    docs = [(None, "x" * 50)] * 6
    assert digest(line_runs.line_dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()) == expected(docs)


def test_runs_count_and_keep(spark):
    runs = line_runs.Runs(spark, Stage(spark, "test"))
    for batch in ([(1, 1, 2, 90), (2, 2, 1, 80)], [(1, 1, 5, 70), (3, 3, 1, 60)], [(3, 3, 4, 50)], [(2, 2, 1, 40)], [(4, 4, 1, 30)]):
        runs.add(spark.createDataFrame(batch, "h1 long, h2 long, n long, last long"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert digest(runs.totals().collect()) == [(1, 1, 7, 90), (2, 2, 2, 80), (3, 3, 5, 60), (4, 4, 1, 30)]
    runs.close()


def test_documents_keep_their_columns(spark):
    line = "l" * 40
    docs = spark.createDataFrame([(i, line if i else None, i) for i in range(7)], "id long, body string, n_lines int")
    got = line_runs.documents_without_repeated_lines(docs, "id", "body")
    assert got.schema == docs.schema
    assert digest(got.collect()) == sorted([(0, None, 0), (6, line, 6)] + [(i, "", i) for i in range(1, 6)], key=repr)


def test_empty(spark):
    assert line_runs.line_dedup(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_documents_that_lose_many_keys(spark):
    docs = case(6) + [(50_000 + i, "\n".join(f"{k} common line that is long enough to be dropped" for k in range(30)) + f"\nown {i}\n") for i in range(6)]
    docs += [docs[-1], docs[-2], (50_000, docs[0][1])]
    df = spark.createDataFrame([(*x, "s") for x in docs], "doc_id long, text string, uid string").repartition(3)
    assert digest(line_runs.line_dedup(df).collect()) == expected(docs)
    kept = line_runs.documents_without_repeated_lines(df)
    assert kept.columns == df.columns and kept.count() == len(docs)


def test_a_document_of_very_many_dropped_lines(spark):
    text = "\n".join(f"line {i} of a very long list, long enough to be a key" for i in range(100_000))
    docs = [(i, text) for i in range(5)]
    got = line_runs.line_dedup(spark.createDataFrame(docs, "doc_id long, text string").repartition(5)).collect()
    assert sorted((r.doc_id, r.n_lines, r.n_dropped) for r in got) == [(i, 100_000, 100_000 if i < 4 else 0) for i in range(5)]


def test_runs_leave_no_tables_behind_when_a_job_fails(spark, monkeypatch):
    def stop(self, keys):
        line_runs.Runs._put(self, keys.select("h1", "h2", "n", F.col("last").alias("keeper")), 0)
        raise OSError("stopped")

    monkeypatch.setattr(line_runs.Runs, "add", stop)
    with pytest.raises(OSError, match="stopped"):
        line_runs.line_dedup(spark.createDataFrame(case(1), "doc_id long, text string"))
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("line_run")]
