"""Near-duplicates against all pairs, and components against a plain search."""

import random
import re

import numpy as np
import pytest

from newsmart.llm import near_dup
from newsmart.llm.arrow import Stage
from newsmart.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def shingle_set(text, k=3):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def roots_of(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def expected(docs, k=3, percent=85):
    sets = {d: shingle_set(t, k) for d, t in docs}
    ids = sorted(sets)
    edges = []
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)):
                common = len(x & y)
                if 100 * common >= percent * (len(x) + len(y) - common):
                    edges.append((a, b))
    root = roots_of(ids, edges)
    return sorted((d, len(sets[d]), root[d], root[d] == d) for d in ids)


def corpus(seed, groups=25, size=6, vocabulary=400):
    r = random.Random(seed)
    words = ["w%d" % i for i in range(vocabulary)]
    hot = " ".join(r.choice(words) for _ in range(40))
    texts = [None, "", " \n", "one", "ONE", "one two", "one two three", "one two three four"]
    for _ in range(groups):
        base = [r.choice(words) for _ in range(r.choice([5, 12, 30, 80, 200]))]
        if r.random() < 0.5:
            base = hot.split() + base
        for _ in range(r.randint(1, size)):
            copy = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, 5, 12])):
                copy[r.randrange(len(copy))] = r.choice(words)
            texts.append(r.choice([" ", "  ", "\n"]).join(copy).upper() if r.random() < 0.2 else " ".join(copy))
    r.shuffle(texts)
    return [(i * 7 % 100_003, t) for i, t in enumerate(texts)]


def digest(rows):
    return sorted(tuple(r) for r in rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    docs = corpus(seed)
    df = spark.createDataFrame([(*x, 1) for x in docs], "doc_id long, text string, low int").repartition(3)
    got = near_dup.near_duplicates(df)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert digest(got.collect()) == expected(docs)


def test_a_large_group_in_blocks(spark, monkeypatch):
    r = random.Random(9)
    monkeypatch.setattr(near_dup, "BLOCK_DOCS", 16)
    base = ["w%d" % r.randrange(10_000) for _ in range(120)]
    docs = []
    for i in range(150):
        copy = list(base)
        for _ in range(r.randint(0, 8)):
            copy[r.randrange(120)] = "x%d" % r.randrange(1000)
        docs.append((i, " ".join(copy)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert digest(near_dup.near_duplicates(df).collect()) == expected(docs)


def test_five_words_at_four_fifths(spark):
    docs = corpus(5, 12)
    got = near_dup.linked_documents(spark.createDataFrame(docs, "doc_id long, text string"))
    assert digest(got.collect()) == expected(docs, 5, 80)


def test_repeated_and_missing_ids(spark):
    a, b, c = ("alpha beta gamma delta epsilon", "one two three four five", "red green blue black white")
    rows = [(1, a), (1, b), (2, b), (5, a), (None, a), (None, c), (None, c), (7, None), (7, None), (3, "z " * 50_000)]
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, set()).add((r.component_id, r.kept))
    assert by[1] == {(1, True)} and by[2] == {(1, False)} and by[5] == {(1, False)} and by[7] == {(7, True)} and by[3] == {(3, True)}
    assert by[None] == {(1, False), (None, True)}
    docs = spark.createDataFrame([(*x, 0) for x in rows], "doc_id long, text string, gone int")
    kept = near_dup.one_of_each_group(docs)
    assert kept.schema == docs.schema


def test_empty(spark):
    assert near_dup.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_components(spark):
    r = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 300)] + [(r.randrange(400, 600), r.randrange(400, 600)) for _ in range(90)] + [(1000, 1000 + i) for i in range(1, 50)]
    edges = [(a, b) if r.random() < 0.5 else (b, a) for a, b in edges]
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    got = components(spark.createDataFrame(edges, "a long, b long"), Stage(spark, "test"))
    root = roots_of(nodes, edges)
    assert {x.node: x.root for x in got.collect()} == {n: k for n, k in root.items() if n != k}


def test_overlaps_count_shared_values():
    r = np.random.default_rng(1)
    sets = [np.unique(r.integers(0, 60, 40)) for _ in range(9)]
    owners = np.repeat(np.arange(9), [len(s) for s in sets])
    got = near_dup._overlaps(owners, np.concatenate(sets), 9)
    for i in range(9):
        for j in range(9):
            if i != j:
                assert got[i, j] == len(np.intersect1d(sets[i], sets[j]))


def test_estimates_are_the_shared_part_of_the_unions_sketch():
    r = np.random.default_rng(3)
    top = np.iinfo(np.uint64).max
    sets = [np.unique(r.integers(0, 400, n).astype(np.uint64)) for n in (1, 5, 63, 64, 90, 200, 300, 400)]
    sets += [sets[4], np.array([top], np.uint64), np.array([1, top], np.uint64)]
    low = np.full((len(sets), near_dup.SKETCH), top, np.uint64)
    for i, s in enumerate(sets):
        low[i, : min(len(s), near_dup.SKETCH)] = s[: near_dup.SKETCH]
    a, b = np.nonzero(np.ones((len(sets), len(sets)), dtype=bool))
    got = near_dup.union_estimates(low, np.array([len(s) for s in sets]), a, b)
    for i, j, estimate in zip(a, b, got, strict=True):
        union = np.union1d(sets[i], sets[j])[: near_dup.SKETCH]
        both = np.isin(union, sets[i]) & np.isin(union, sets[j])
        assert estimate == both.sum() / len(union)
