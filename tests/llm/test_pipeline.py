"""The pipeline against the plain computations of its stages, and on odd tables."""

import hashlib

import public_tokenizers
import pytest
import test_decontam
import test_line_runs
import test_near_dup
from tokenizers import Tokenizer

import corpus_pipeline

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def write(spark, folder, docs, labels, benchmark):
    spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in docs], SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(benchmark, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def without_repeated_lines(docs):
    key = test_line_runs.key
    n, keeper = {}, {}
    for d, t in docs:
        for k in {key(x) for x in (t or "").split("\n")}:
            n[k], keeper[k] = n.get(k, 0) + 1, max(keeper.get(k, -1), d)
    out = []
    for d, t in docs:
        lines = [x for x in (t or "").split("\n") if len(key(x)) < 40 or n[key(x)] < 5 or d == keeper[key(x)]]
        out.append((d, t if t is None else "\n".join(lines)))
    return out


def plain(docs, benchmark):
    insults = {"idiot", "moron", "scum", "loser"}
    docs = [(d, t) for d, t in docs if len(insults & set((t or "").split())) < 2]
    docs = without_repeated_lines(docs)
    kept = {r[0] for r in test_near_dup.expected(docs, 5, 80) if r[3]}
    docs = [(d, t) for d, t in docs if d in kept]
    clean = {r[0] for r in test_decontam.expected(docs, benchmark) if not r[5]}
    out = []
    for d, t in docs:
        if d in clean:
            ids = LIBRARY.encode(t or "", add_special_tokens=False).ids
            packed = b"".join(i.to_bytes(4, "little") for i in ids)
            out.append((d, len(ids), packed, hashlib.sha256(packed).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out)


def test_against_plain_stages(spark, tmp_path):
    docs = test_near_dup.corpus(3, 14)
    line = "a line that very many of the documents have in common, word for word"
    docs = [(d, t + "\n" + line if t and d % 3 == 0 else t) for d, t in docs]
    item = docs[10][1] or docs[11][1] or "one two three"
    docs += [(500_001, "you idiot and scum of the earth"), (500_002, "loser moron"), (500_003, "only one idiot here"), (500_004, f"zero {item} end")]
    benchmark = [(1, item), (2, "never seen words at all in here"), (3, None)]
    folder = write(spark, tmp_path, docs, [], benchmark)
    got = corpus_pipeline.run(spark, folder).collect()
    assert sorted((r.doc_id, r.n_tokens, bytes(r.ids), r.ids_sha256, r.decoded_sha256) for r in got) == plain(docs, benchmark)


def test_stages_return_the_columns_of_documents(spark):
    data = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{data}/documents.parquet")
    for _, step in corpus_pipeline.STAGES[:-1]:
        assert step(spark, docs, data).schema == docs.schema


@pytest.mark.parametrize("rows", [[], [(None, None), (None, ""), (1, None), (1, ""), (1, "a b"), (1, "a b"), (None, "a b")]])
def test_odd_tables(spark, tmp_path, rows):
    folder = write(spark, tmp_path, rows, [(None, None, None)], [])
    got = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in got} == {d for d, _ in rows}
