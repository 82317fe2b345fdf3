"""Hard negatives against plain inner products."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsmart.llm import hard_negatives as hn

COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def usable(row):
    i, label, v = row
    return i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)


def ints(v, scale):
    return [math.floor(scale * x) for x in v]


def expected(rows, is_anchor, scale=256, positives=5, negatives=3, low=50, high=95):
    rows = sorted({(i, label, tuple(ints(v, scale))) for i, label, v in filter(usable, rows)})
    out = []
    for i, label, v in rows:
        if not is_anchor(i):
            continue
        scored = [(-sum(a * b for a, b in zip(v, w, strict=False)), j, other) for j, other, w in rows if j != i]
        pos = sorted({(s, j) for s, j, other in scored if other == label})[:positives]
        for s, j in pos:
            neg = sorted({(t, k) for t, k, other in scored if other != label and low * -s <= 100 * -t <= high * -s})
            out += [(i, j, n + 1, k, -s, -t) for n, (t, k) in enumerate(neg[:negatives])]
    return sorted(out)


def some_rows(seed, n, dims, labels=4, spread=0.4):
    r = random.Random(seed)
    centre = [[r.gauss(0, spread) for _ in range(dims)] for _ in range(labels)]
    rows = []
    for i in range(n):
        label = r.randrange(labels)
        rows.append((i, label, [float(np.float32(c + r.gauss(0, 0.3))) for c in centre[r.choice([label, 0])]]))
    return rows


def frame(spark, rows, kind="float"):
    schema = f"vec_id long, rank int, label int, embedding array<{kind}>, planes string"
    return spark.createDataFrame([(i, 1, label, v, "x") for i, label, v in rows], schema).repartition(3)


def listed(df):
    return sorted(tuple(r) for r in df.collect())


def odd_rows(rows):
    """Nulls, values that aren't finite, shorter vectors, repeated rows, and one id with different vectors."""
    v = rows[1][2]
    return rows + [
        (10, None, v), (20, 1, None), (30, 1, [*v[:-1], None]), (40, 1, [math.nan, *v[1:]]), (50, 2, [math.inf, *v[1:]]), (None, 1, v),
        (60, 1, v[:3]), (70, 1, []), (80, 3, [0.0] * len(v)), *rows[:20], *[rows[10]] * 40, (0, 2, v), (5, 1, rows[9][2]), (200, -3, [2 * x for x in v]),
    ]


@pytest.mark.parametrize(("seed", "dims"), [(1, 64), (2, 13), (3, 1)])
def test_against_plain_products(spark, seed, dims):
    rows = odd_rows(some_rows(seed, 150, dims))
    got = hn.mine(frame(spark, rows), F.col("vec_id") % 10 == 0)
    assert got.columns == COLUMNS
    want = expected(rows, lambda i: i % 10 == 0)
    assert listed(got) == want
    assert want


def test_blocks_of_anchors_and_tiles_change_nothing(spark, monkeypatch):
    rows = odd_rows(some_rows(7, 120, 10))
    monkeypatch.setattr(hn, "TILE", 3)
    monkeypatch.setattr(hn, "ROWS", 7)
    got = hn.mine(frame(spark, rows), F.col("vec_id") % 4 == 0, positives=2, negatives=4, low=10, high=99, block=6)
    assert listed(got) == expected(rows, lambda i: i % 4 == 0, 256, 2, 4, 10, 99)


def test_query_moves_labels(spark):
    rows = [(i, label, v) for i, label, v in some_rows(9, 400, 8, 10)]
    moved = [(i, (label + 1) % 10 if i % 7 == 0 else label, v) for i, label, v in rows]
    assert listed(hn.hard_negatives(frame(spark, rows, "double"))) == expected(moved, lambda i: i % 50 == 0)


@pytest.mark.parametrize("size", [0.01, 1.0, 50.0, 30_000.0])
def test_scores_are_exact(size):
    r = np.random.default_rng(4)
    a, c = (np.floor(256 * r.normal(0, size, (n, 16))).astype(np.int64) for n in (5, 40))
    top = int(max(np.abs(a).max(), np.abs(c).max()))
    packed = hn.pack(c, top.bit_length() + 1, 2)
    assert (hn.unpack(packed) == c).all()
    assert (hn.Tables(a, top).scores(packed) == c @ a.T).all()


def test_extreme_numbers():
    a = np.array([[-128] * 8, [127] * 8, [0] * 8])
    packed = hn.pack(a, 8, 1)
    assert (hn.Tables(a, 128).scores(packed) == a @ a.T).all()


def test_too_large_components_are_an_error(spark):
    rows = [(0, 1, [1e20, 0.0]), (1, 1, [1.0, 0.0])]
    with pytest.raises(Exception, match="long"):
        hn.mine(frame(spark, rows), F.col("vec_id") == 0).collect()


def test_empty_tables_and_no_anchors(spark):
    rows = some_rows(1, 10, 4)
    assert hn.mine(frame(spark, rows).limit(0), F.col("vec_id") == 0).collect() == []
    assert hn.mine(frame(spark, rows), F.col("vec_id") < 0).collect() == []
    assert hn.mine(frame(spark, [(1, None, None)]), F.col("vec_id") == 1).collect() == []
    alone = hn.mine(frame(spark, [(1, 1, [1.0])]), F.col("vec_id") == 1)
    assert alone.collect() == []
    assert alone.columns == COLUMNS


def test_lists_keep_the_best_with_ties_by_id():
    r = random.Random(8)
    best, given = hn.Best(4, 3), [[] for _ in range(4)]
    for _ in range(30):
        rows = [(r.randrange(4), r.randrange(-5, 5), r.randrange(30)) for _ in range(r.randint(0, 12))]
        best.add(*(np.array([x[i] for x in rows], dtype=np.int64) for i in range(3)))
        for who, score, i in rows:
            given[who].append((-score, i))
    for who in range(4):
        want = sorted(set(given[who]))[:3]
        assert [(-s, i) for s, i in zip(best.score[who], best.id[who], strict=True)] == want
