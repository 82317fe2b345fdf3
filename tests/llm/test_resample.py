"""Importance resampling against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from newsmart.llm import resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
COLUMNS = ["doc_id", "n_features", "weight", "score", "rank"]


def features(text, words=(1, 1)):
    w = WORD.findall((text or "").translate(LOWER))
    return len(w), [" ".join(w[i : i + n]) for n in range(words[0], words[1] + 1) for i in range(len(w) - n + 1)]


def expected(docs, items, words=(1, 1), buckets=10_000, seed="2024", least=20, percent=10):
    hashed = lambda t: Counter(zlib.crc32(f.encode()) % buckets for f in features(t, words)[1])
    have, want = Counter(), Counter()
    for _, t in docs:
        have += hashed(t)
    for _, t in items:
        want += hashed(t)
    many, wanted = sum(have.values()), sum(want.values())
    gain = lambda b: math.floor(1000 * math.log((want[b] + 1.0) * (many + buckets) / ((have[b] + 1.0) * (wanted + buckets))))
    out = []
    for i, t in docs:
        own = hashed(t)
        n = sum(own.values())
        weight = sum(gain(b) * c for b, c in own.items()) // n if n else 0
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, n, weight, score, None, features(t)[0]])
    able = sorted((r for r in out if r[0] is not None and r[5] >= least), key=lambda r: (-r[3], r[0], r[5], r[1]))
    for k, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=repr)


def some_docs(seed, n):
    r = random.Random(seed)
    kinds = [w + x for w in "abcdefghij" for x in ("", "é", "7", "中b")]
    text = lambda k: "".join(r.choice(kinds).upper() + r.choice([" ", "  ", "-", "\n", "_", "\x7f", "É "]) for _ in range(k))
    docs = [(i, text(r.randint(0, 60))) for i in range(n)]
    docs += [(n + 1, None), (n + 2, ""), (n + 3, "..."), (n + 4, "z" * 200_000 + " a b"), (n + 5, "a b " * 40_000), (None, text(40))]
    docs += [(3, docs[3][1]), (3, text(50)), (2**40, docs[5][1])] + [docs[7]] * 30
    return docs, [(i, text(r.randint(0, 30))) for i in range(12)] + [(1, None), (None, "é é")]


def frames(spark, docs, items):
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, score int, n_words string").repartition(3)
    return d, spark.createDataFrame([(*x, 5) for x in items], "item_id long, text string, rank int")


def listed(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_plain_python(spark, seed):
    docs, items = some_docs(seed, 200)
    got = resample.importance(*frames(spark, docs, items))
    assert got.columns == COLUMNS
    assert listed(got) == expected(docs, items)
    assert sum(r.rank is not None for r in got.collect()) > 10


def test_longer_features_and_other_settings(spark):
    docs, items = some_docs(5, 80)
    d, b = frames(spark, docs, items)
    got = resample.resampled(d, b, words=(2, 3), buckets=70_000, seed="s", least_words=5, percent=37).select(COLUMNS)
    assert listed(got) == expected(docs, items, (2, 3), 70_000, "s", 5, 37)


def test_long_texts_are_cut_between_words():
    cutter = resample.Cutter((1, 2), 10_000)
    r = random.Random(3)
    text = " ".join(r.choice(["aé", "b", "ccc中"]) * r.randint(1, 4) for _ in range(60_000))
    assert len(list(resample.parts(text.encode()))) > 5
    n, found = cutter.features(text.encode())
    assert n == 60_000
    want = Counter(zlib.crc32(f.encode()) % 10_000 for f in features(text, (1, 2))[1])
    assert Counter(x for part in found for x in part.tolist()) == want


def test_offsets_name_the_words():
    text = "one  twö-3, é中\x7fz"
    spans = resample.Cutter((1, 1), 10).spans(text)
    assert [text.encode()[a:b].decode() for a, b in spans] == WORD.findall(text)


def test_empty_tables(spark):
    d, b = frames(spark, [(1, "a " * 30), (2, "b " * 30)], [(1, "a")])
    assert resample.importance(d.limit(0), b).collect() == []
    assert listed(resample.importance(d, b.limit(0))) == expected([(1, "a " * 30), (2, "b " * 30)], [])
    assert resample.importance(d.limit(0), b.limit(0)).collect() == []


def test_draw_of_equal_rows_numbers_all_of_them(spark):
    docs = [(4, "a " * 20)] * 50 + [(i, "b " * 25) for i in range(10, 60)]
    got = resample.resampled(*frames(spark, docs, [(1, "a a")]), percent=60)
    ranks = sorted(r.rank for r in got.collect() if r.rank)
    assert ranks == list(range(1, 61))
