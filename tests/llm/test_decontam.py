"""Passage search against a word-by-word search."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa

from newsmart.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def expected(docs, items, window=10):
    wins = {}
    for i, t in items:
        if i is None:
            continue
        w = words(t)
        for k in range(max(len(w) - window + 1, min(1, len(w)))):
            wins.setdefault(tuple(w[k : k + window]), set()).add(str(i))
    sizes = {len(x) for x in wins}
    out = []
    for d, t in docs:
        w, hit, ids = words(t), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if found := wins.get(tuple(w[k : k + n])):
                    hit.update(range(k, k + n))
                    ids |= found
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return out


def some_words(r, n, kinds="abcdefghij"):
    return [r.choice(kinds) + r.choice(["", "x", "yz", "é", "7"]) for _ in range(n)]


def case(seed, n_docs=60):
    r = random.Random(seed)
    items = [(i, " ".join(some_words(r, r.choice([1, 2, 3, 5, 9, 10, 11, 25, 40]), "abcdefghijklmnopqrst"))) for i in range(25)]
    items += [(7, "Same id, another text of the same item with more than ten words in it"), (None, "a b c"), (90, None), (91, " .. "), (92, "a" * 300)]
    docs = []
    for d in range(n_docs):
        parts = []
        for _ in range(r.randint(0, 5)):
            parts.append(" ".join(some_words(r, r.randint(0, 30), "abcdefghijklmnopqrst")))
            if r.random() < 0.6:
                w = (r.choice(items)[1] or "").split(" ")
                a = r.randint(0, max(0, len(w) - 5))
                parts.append(r.choice([" ", ", ", "\n--"]).join(w[a : a + r.randint(1, 30)]).upper() if r.random() < 0.3 else " ".join(w))
        docs.append((d, r.choice([" ", "\n", "!"]).join(parts)))
    return docs + [(500, None), (501, ""), (502, "..."), (503, "x " * 30_000), (0, docs[0][1]), (None, "b"), (504, "b" + "a" * 300)], items


def digest(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def test_against_word_search(spark):
    for seed in range(3):
        docs, items = case(seed)
        d = spark.createDataFrame([(*x, 1) for x in docs], "doc_id long, text string, spans int").repartition(3)
        b = spark.createDataFrame([(*x, "c") for x in items], "item_id long, text string, items string")
        got = decontam.decontamination(d, b)
        assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
        assert digest(got.collect()) == digest(expected(docs, items))


def test_small_blocks_give_the_same(spark):
    docs, items = case(11, 30)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    one = decontam.find_passages(d, b).collect()
    many = decontam.find_passages(d, b, block_bytes=4000).collect()
    assert digest(one) == digest(many)


def test_long_texts_and_many_windows():
    r = random.Random(5)
    text = " ".join(some_words(r, 20_000))
    w = text.split(" ")
    patterns = sorted({(" " + " ".join(w[k : k + 10]) + " ").encode() for k in range(0, 2000, 3)})
    search = decontam.Search(patterns, [["i"]] * len(patterns))
    column = pa.array(["q", text, None, text])
    got = {}
    for texts in decontam.chunks(column, 1000):
        got |= {texts.first + i: decontam.merged(s) for i, (s, _) in search.hits(texts)[1].items()}
    hit = np.zeros(len(w), bool)
    known = {p.decode().strip() for p in patterns}
    for k in range(len(w) - 9):
        if " ".join(w[k : k + 10]) in known:
            hit[k : k + 10] = True
    for i in (1, 3):
        assert sum(b - a for a, b in zip(got[i][::2], got[i][1::2], strict=True)) == hit.sum()


def test_clean_documents_keep_their_columns(spark):
    docs = spark.createDataFrame([(1, "one two three four five six seven eight nine ten", 5), (2, "fine", None), (3, None, 7)], "id long, text string, items long")
    bench = spark.createDataFrame([(1, "Zero one two three four five six seven eight nine ten eleven")], "item_id long, text string")
    got = decontam.clean_documents(docs, bench)
    assert got.schema == docs.schema
    assert digest(got.collect()) == [(2, "fine", None), (3, None, 7)]


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontam.decontamination(d, b.limit(0)).first().contaminated is False
    assert decontam.decontamination(d.limit(0), b).collect() == []
