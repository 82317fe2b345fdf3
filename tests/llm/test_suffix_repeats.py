"""Repeated strings against a table of all strings, for pieces, slots, narrowing and whole corpora."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from newsmart.llm import pieces, suffix_repeats
from newsmart.llm.tokens import Texts


def expected(docs, length=200):
    raws = [(d, (t or "").encode()) for d, t in docs]
    n = Counter(r[i : i + length] for _, r in raws for i in range(len(r) - length + 1))
    out = []
    for d, r in raws:
        gone = np.zeros(len(r) + 1, dtype=bool)
        for i in range(len(r) - length + 1):
            if n[r[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = int(np.sum(gone[:-1] & ~np.concatenate([[False], gone[:-2]]))) if len(r) else 0
        kept = bytes(b for b, g in zip(r, gone, strict=False) if not g)
        out.append((d, len(r), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed, n=60, letters="abcdefé \n"):
    r = random.Random(seed)
    some = lambda k: "".join(r.choice(letters) for _ in range(k))
    shared = [some(r.choice([150, 198, 199, 200, 201, 260, 600])) for _ in range(8)]
    docs = []
    for d in range(n):
        text = "".join(r.choice([some(r.randint(0, 300)), r.choice(shared), r.choice(shared)[r.randint(0, 90) :]]) for _ in range(r.randint(0, 6)))
        docs.append((d, text))
    base = some(900)
    for d in range(n, n + 12):
        copy = list(base)
        for _ in range(r.randint(0, 4)):
            copy[r.randrange(900)] = "#"
        docs.append((d, "".join(copy)))
    docs += [(900, None), (901, ""), (902, "a" * 199), (903, "a" * 201), (904, "xy" * 400), (docs[5][0], docs[5][1]), (None, base), (None, base[:205])]
    return docs


def digest(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_whole_corpus(spark, seed):
    docs = corpus(seed)
    df = spark.createDataFrame([(*x, 1, 2) for x in docs], "doc_id long, text string, uid int, spans int").repartition(3)
    got = suffix_repeats.repeat_digests(df)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert digest(got.collect()) == expected(docs)


def test_keys_that_are_narrowed(spark):
    r = random.Random(4)
    some = lambda k: "".join(r.choice("abcdefgh ") for _ in range(k))
    passage = some(260)
    docs = [(i, some(r.randint(20, 150)) + passage[: r.choice([260, 230, 190])] + some(r.randint(20, 150))) for i in range(80)]
    docs += [(100 + i, docs[i][1][7:]) for i in range(5)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = suffix_repeats.remove_repeats(df, key_bytes=700).selectExpr("doc_id", "n_bytes", "n_removed", "n_spans", "sha2(kept, 256)")
    assert digest(got.collect()) == expected(docs)


def test_short_length_and_extra_columns(spark):
    docs = [(1, "abcdefgh"), (2, "xxabcdyy"), (3, "abcdefgh")]
    df = spark.createDataFrame([(*x, "r") for x in docs], "doc_id long, text string, row string")
    length = 64
    docs = [(i, (t or "") * 20) for i, t in docs]
    df = spark.createDataFrame([(*x, "r") for x in docs], df.schema)
    got = suffix_repeats.remove_repeats(df, length=length)
    assert got.columns == ["doc_id", "row", "n_bytes", "n_removed", "n_spans", "kept"]
    assert digest(got.selectExpr("doc_id", "n_bytes", "n_removed", "n_spans", "sha2(kept, 256)").collect()) == expected(docs, length)


def test_empty(spark):
    assert suffix_repeats.repeat_digests(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("letters", [b"ab", b"abcdefghijklmnop", bytes(range(256))])
def test_slot(letters):
    r = random.Random(len(letters))
    for length in (1, 3, 20):
        pool = [bytes(r.choice(letters) for _ in range(60)) for _ in range(3)]
        bodies = [p[a : a + r.randint(length, 50)] for p in r.choices(pool, k=12) for a in [r.randint(0, 9)]]
        bodies = [b for b in bodies if len(b) >= length]
        several = np.array([r.random() < 0.2 for _ in bodies])
        n = Counter(b[i : i + length] for b in bodies for i in range(len(b) - length + 1))
        got = {(p, i) for p, a, b in suffix_repeats.repeated_starts(bodies, several, length) for i in range(a, b)}
        assert got == {(p, i) for p, b in enumerate(bodies) for i in range(len(b) - length + 1) if several[p] or n[b[i : i + length]] > 1}


def test_equal_strings_have_equal_keys():
    r = random.Random(8)
    shared = bytes(r.choice(b"abc") for _ in range(400))
    texts = [bytes(r.choice(b"abc") for _ in range(r.randint(0, 300))) + shared + b"z" * 50 for _ in range(4)] + [b"q" * 900, b"", b"s"]
    buf = np.frombuffer(b"".join(texts), dtype=np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    sums = pieces.Sums(buf, pieces._BASES[0])
    found = pieces.first_pieces(Texts(buf, offsets, 0), 200, sums)
    for level in range(1, 9):
        found = pieces.narrow(found, 200)
        keys = pieces.keys_of(found, sums, level)
        at = {}
        for i in range(len(found)):
            for s in range(found.first[i], found.last[i] + 1):
                assert found.left[i] >= s and found.right[i] <= s + 200 and s not in at
                at[s] = (keys[i], found.left[i] - s)
        starts = [s for t in range(len(texts)) for s in range(offsets[t], offsets[t + 1] - 199)]
        assert sorted(at) == starts
        by = {}
        for s in starts:
            by.setdefault(buf[s : s + 200].tobytes(), set()).add(at[s])
        assert all(len(x) == 1 for x in by.values())
    assert set((found.right - found.left).tolist()) == {200}
