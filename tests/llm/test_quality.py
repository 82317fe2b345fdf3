"""Counts against a plain computation, bounds against the binomial distribution, and the guarantee on labels."""

import math
import random
import re
from collections import Counter

import numpy as np

from newsmart.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def expected(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    wins = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if wins[tuple(w[i : i + 3])] > 1 for k in range(3)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def some_texts():
    r = random.Random(1)
    out = [None, "", " ", "\n\n", "a", "a b", "a b c", "a b c a b c", "x\nx\nx ", "é日本 # ** <>\n\ta\x0bb\x0cc\rd", "a a a a a", "w " * 30_000]
    for _ in range(80):
        lines = [" ".join(r.choice("ab#é") * r.randint(1, 2) for _ in range(r.randint(0, 9))) for _ in range(r.randint(1, 9))]
        out.append("\n".join(r.choice(lines) for _ in range(r.randint(1, 12))))
    return out


def test_counts(spark):
    texts = some_texts()
    docs = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)] + [(None, "a", 0), (0, None, 0)], "doc_id long, text string, kept int")
    labels = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, quality int")
    got = quality.quality(docs, labels).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        n, chars, symbols, dup, rep = expected(texts[r.doc_id] if r.doc_id is not None else "a")
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, rep)
        assert r.base_failed == (n < 50 or 100 * rep > 50 * n)
        assert r.kept == (not r.base_failed)  # without labels nothing more is rejected


def test_bound_is_the_exact_one():
    for k, n in ((0, 10), (3, 50), (40, 1000), (5, 5)):
        p = quality.upper_bound(k, n, 0.01)
        tail = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert p == 1 if k == n else abs(tail - 0.01) < 1e-6


def test_cutoffs_stop_at_the_first_failure():
    rows = [("symbols", 0, 10, 5000), ("symbols", 0, 150, 40), ("repeats", 1, 3, 5000)]
    cut = quality.choose_cutoffs(rows, alpha=0.02)
    assert 10 <= cut["symbols", 0] < 150 and cut["repeats", 1] == 3
    assert cut["symbols", 1] == quality.GRID  # no labels: nothing is rejected


def labelled(*n, steps=None):
    """n[s] good documents in stratum s, at step 0 of the rules but for what `steps` says."""
    steps = steps or {}
    return [(rule, s, steps.get(rule, 0), m) for rule in quality.rates_names() for s, m in enumerate(n) if m]


def test_every_stratum_is_tested_on_its_own_labels():
    table = labelled(739, 1408, 824, 100, steps={"long_words": 30})
    cut = quality.choose_cutoffs(table)
    report = {s: (n, rate) for rule, s, n, rate, _, _ in quality.cutoff_report(table, cut) if rule == "symbols"}
    assert report[1] == (1408, quality.ALPHA) and report[3] == (100, None)
    for s in range(3):
        assert cut["symbols", s] == 0 and cut["long_words", s] == 30
        n, rate = report[s]
        assert quality.ALPHA <= rate <= quality.MOST_ALPHA and quality.upper_bound(0, n, quality.DELTA / 20) <= rate
    assert {cut[rule, 3] for rule in quality.rates_names()} == {quality.GRID}  # 100 labels certify nothing
    # what the other strata hold makes no difference
    alone = quality.choose_cutoffs([row for row in table if row[1] == 0])
    assert all(alone[rule, 0] == cut[rule, 0] for rule in quality.rates_names())


def test_a_stratum_has_its_bound_whatever_its_neighbours_hold():
    table = [("symbols", 0, 0, 5000), ("symbols", 1, 0, 1400), ("symbols", 1, 40, 70)]
    assert quality.upper_bound(70, 6470, quality.DELTA / 20) < 0.02 < quality.upper_bound(70, 1470, quality.DELTA)
    cut = quality.choose_cutoffs(table, alpha=0.02)
    assert cut["symbols", 0] == 0 and cut["symbols", 1] == 40


def test_false_rejections_over_repeated_draws():
    r = np.random.default_rng(5)
    weights = 0.75 ** np.arange(60)
    chance = weights / weights.sum()
    beyond = np.concatenate([np.cumsum(chance[::-1])[::-1][1:], [0.0]])  # of a good document above each step
    sizes, draws, broken, active = (150, 400, 1500, 60), 150, 0, 0
    for _ in range(draws):
        table = [
            (rule, s, int(step), int(n))
            for rule in quality.rates_names() for s, size in enumerate(sizes)
            for step, n in enumerate(r.multinomial(size, chance)) if n
        ]
        cut, allowed = quality.choose_cutoffs(table), quality.allowed_rates(table)
        bad = [q for q, c in cut.items() if c < quality.GRID and beyond[min(c, 59)] > allowed[q]]
        broken += bool(bad)
        active += sum(c < quality.GRID for c in cut.values())
    assert active == 15 * draws  # all but the stratum of 60
    assert broken <= 0.05 * draws + 3 * math.sqrt(0.05 * 0.95 * draws)


def test_finished_sequences_hand_their_risk_on():
    # nineteen sequences of twenty end at once, and the last has the whole risk
    table = [row for row in labelled(5004, 5004, 5004, 5004) if row[:2] != ("repeats", 0)]
    table += [("repeats", 0, 0, 4990), ("repeats", 0, 9, 14)]
    even, whole = (quality.upper_bound(14, 5004, risk) for risk in (quality.DELTA / 20, quality.DELTA))
    assert whole < even
    assert quality.choose_cutoffs(table, (even + whole) / 2)["repeats", 0] == 0
    assert quality.choose_cutoffs(table, whole * 0.99)["repeats", 0] == 9


def test_the_allowed_rate_is_the_least_that_can_be_certified():
    risk = quality.DELTA / 20
    assert quality.allowed_rate(1408, risk) == quality.ALPHA and quality.allowed_rate(0, risk) is None
    for n in (150, 272, 739):
        rate = quality.allowed_rate(n, risk)
        assert quality.upper_bound(0, n, risk) <= rate < quality.upper_bound(0, n, risk) * 1.001
    assert quality.allowed_rate(100, risk) is None
    assert quality.allowed_rate(100, risk, alpha=0.07) == 0.07  # the caller's rate holds


def test_rules_reject_junk_and_keep_good_documents(spark):
    r = random.Random(2)
    words = ["".join(r.choice("abcdefghijklm") for _ in range(r.randint(2, 9))) for _ in range(500)]
    good = [" ".join(r.choice(words) for _ in range(100)) for _ in range(1500)]
    bad = [" ".join(r.choice(words) + "###" for _ in range(100)) for _ in range(50)]
    docs = spark.createDataFrame(list(enumerate(good + bad)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 1500)) for i in range(1400)] + [(i, 0) for i in range(1500, 1520)] + [(3, 1), (3, 0)], "doc_id long, quality int")
    got = {x.doc_id: x.kept for x in quality.quality(docs, labels, alpha=0.01).collect()}
    assert not any(got[i] for i in range(1500, 1550))
    assert sum(not got[i] for i in range(1500)) <= 0.02 * 1500


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert quality.quality(docs, spark.createDataFrame([], "doc_id long, quality int")).collect() == []
