"""Quality rules with thresholds whose false rejections are bounded on labelled documents.

Every document gets counts over its whole text. A rule compares a rate with a cutoff of its stratum (a
class of document length). Cutoffs come from labelled documents: for each rule and stratum the cutoffs
are tested from the laxest to the strictest, each by an exact (Clopper-Pearson) upper bound on the rate
of good documents that the cutoff rejects, and the last one that passes before the first failure is used.
The order is fixed beforehand, so one level holds for a whole sequence; the risk is divided evenly among the
sequences, and one that passes to its end hands its share to those still open (Holm, as a graph). Every
stratum is tested on its own labels alone. The rate allowed in it is ALPHA, or, where its labels are too few
to certify ALPHA at an even share of the risk, the lowest rate that they can certify (`allowed_rate`), which
depends on their number only. A stratum that can't certify MOST_ALPHA has no rules and rejects nothing.
With probability 1 - DELTA no rule rejects more than the allowed rate of the good documents of any stratum.
`cutoff_report` gives labels, allowed rate and cutoff of each rule and stratum.

Null and empty texts have no words and fail the base rule. Documents are judged row by row; labels without
id or grade are ignored, and a document with labels of both kinds counts as bad.
"""

from __future__ import annotations

import logging
import math
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsmart.llm.arrow import Stage, add_columns
from newsmart.llm.tokens import NOT_NEWLINE, Texts, byte_set, chunks, hash_spans, hash_words, runs, split_words, windows

#: Allowed rate of good documents that a rule rejects in a stratum, the highest one that a stratum with few labels
#: may have in its place, and the risk that any rule exceeds it.
ALPHA = 0.005
MOST_ALPHA = 0.05
DELTA = 0.05
#: Strata: documents of at least so many words.
STRATA = (50, 150, 400, 1000)
#: Cutoffs of every rate: GRID equal steps up to 1 (or TOP times a rate's unit).
GRID = 200

_SYMBOLS = byte_set([(ord(c), ord(c)) for c in "#*$%&|<>"])
_CONTINUED = byte_set([(0x80, 0xBF)])
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def _totals(marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Marked positions of each text."""
    sums = np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _repeats(owners: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether each value, of an owner, is found twice or more with that owner."""
    order = np.lexsort((values, owners))
    begin = np.zeros(len(order), dtype=bool)
    o, v = owners[order], values[order]
    begin[runs(o)] = True
    begin[runs(v)] = True
    length = np.diff(np.append(np.flatnonzero(begin), len(order)))
    out = np.empty(len(order), dtype=bool)
    out[order] = np.repeat(length > 1, length)
    return out


def counts(texts: Texts) -> list[np.ndarray]:
    """The COUNTS of each text."""
    words = split_words(texts)
    hashes = hash_words(words)
    n_words = words.counts()
    owners = words.owners()
    sums = np.concatenate([[0], np.cumsum(_CONTINUED[texts.buf], dtype=np.int64)])
    chars = (words.ends - words.starts) - (sums[words.ends] - sums[words.starts])
    word_chars = np.bincount(owners, chars, len(texts)).astype(np.int64)
    symbols = _totals(_SYMBOLS[texts.buf], texts.offsets)

    lines = split_words(texts, NOT_NEWLINE)
    written = np.searchsorted(words.starts, lines.ends) > np.searchsorted(words.starts, lines.starts)
    line_owner = lines.owners()[written]
    line_hash = hash_spans(texts.buf, lines.starts, lines.ends)[written]
    n_lines = np.bincount(line_owner, minlength=len(texts))
    order = np.lexsort((line_hash, line_owner))
    same = (line_hash[order][1:] == line_hash[order][:-1]) & (line_owner[order][1:] == line_owner[order][:-1])
    n_dup = np.bincount(line_owner[order][1:][same], minlength=len(texts))

    three = windows(hashes, 3)
    whole = owners[2:] == owners[:-2]
    at = np.flatnonzero(whole)
    again = at[_repeats(owners[:-2][whole], three[whole])] if len(at) else at
    covered = np.zeros(len(words) + 3, dtype=bool)
    for i in range(3):
        covered[again + i] = True
    n_repeat = _totals(covered, words.bounds)
    return [n_words, word_chars, symbols, n_dup, n_repeat, n_lines]


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the COUNTS as columns."""

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        found = [counts(t) for t in chunks(batch.column(batch.schema.get_field_index(text)))]
        return [pa.array(np.concatenate([f[i] for f in found]) if found else [], pa.int64()) for i in range(len(COUNTS))]

    return add_columns(docs, text, [T.StructField(c, T.LongType()) for c in COUNTS], compute)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def rates() -> dict[str, Column]:
    """The rate of each rule, between 0 and 1; a higher one is worse."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    mean = F.col("word_chars") / words
    return {
        "symbols": F.least(F.col("n_symbols") / words, F.lit(1.0)),
        "dup_lines": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeats": F.col("n_repeat_words") / words,
        "short_words": F.greatest(F.lit(0.0), 1 - mean / 10),
        "long_words": F.least(F.lit(1.0), mean / 40),
    }


def stratum() -> Column:
    """The index of the document's length class."""
    return sum((F.col("n_words") >= least).cast("int") for least in STRATA[1:])


def _steps() -> dict[str, Column]:
    """Each rate as a whole number of grid steps, from 0 to GRID."""
    return {name: F.least(F.lit(GRID), F.floor(rate * GRID + 1e-9)).cast("int") for name, rate in rates().items()}


def _beta_cdf(a: float, b: float, x: float) -> float:
    """The regularised incomplete beta function, by its continued fraction."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - _beta_cdf(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    c, d = 1.0, 1 / max(1 - (a + b) * x / (a + 1), 1e-300)
    total = d
    for m in range(1, 1000):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for step in (even, odd):
            d = 1 + step * d
            d = 1 / (d if abs(d) > 1e-300 else 1e-300)
            c = 1 + step / (c if abs(c) > 1e-300 else 1e-300)
            total *= c * d
        if abs(c * d - 1) < 1e-12:
            break
    return front * total / a


@cache
def upper_bound(k: int, n: int, risk: float) -> float:
    """The exact upper bound on a rate after k of n, wrong with probability `risk` at most."""
    if k >= n:
        return 1.0
    low, high = k / n, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        if 1 - _beta_cdf(k + 1, n - k, mid) > risk:
            low = mid
        else:
            high = mid
    return high


def allowed_rate(n: int, risk: float, alpha: float = ALPHA, most: float = MOST_ALPHA) -> float | None:
    """alpha, or the lowest rate that n good labels certify by a cutoff that rejects none of them; None beyond `most`."""
    least = -math.expm1(math.log(risk) / n) if n else 1.0
    rate = max(alpha, least * (1 + 1e-9))
    return rate if rate <= max(alpha, most) else None


def _good(table: list[tuple[str, int, int, int]]) -> dict[str, np.ndarray]:
    """Good documents of each rule by stratum and step."""
    good = {rule: np.zeros((len(STRATA), GRID + 1), np.int64) for rule in rates_names()}
    for rule, s, step, n in table:
        good[rule][s, step] += n
    return good


def allowed_rates(
    table: list[tuple[str, int, int, int]], alpha: float = ALPHA, delta: float = DELTA, most: float = MOST_ALPHA
) -> dict[tuple[str, int], float | None]:
    """(rule, stratum) to the rate of good documents that the rule may reject there; None where it is not tested."""
    good = _good(table)
    share = delta / (len(good) * len(STRATA))
    return {(rule, s): allowed_rate(int(good[rule][s].sum()), share, alpha, most) for rule in good for s in range(len(STRATA))}


def choose_cutoffs(
    table: list[tuple[str, int, int, int]], alpha: float = ALPHA, delta: float = DELTA, most: float = MOST_ALPHA
) -> dict[tuple[str, int], int]:
    """(rule, stratum) to the step above which documents are rejected. table: rule, stratum, step, good documents there."""
    good = _good(table)
    allowed = {q: rate for q, rate in allowed_rates(table, alpha, delta, most).items() if rate is not None}
    # for each sequence, a rule in a stratum, the good documents at each step or higher
    above = {(rule, s): np.cumsum(good[rule][s][::-1])[::-1] for rule, s in allowed}
    cut = dict.fromkeys(above, GRID)
    # sequences that aren't tested leave their share unused
    share = dict.fromkeys(above, delta / (len(good) * len(STRATA)))
    waiting = list(above)
    while waiting:
        q = waiting.pop(0)
        # rejecting what lies at step cut or higher
        while share[q] and cut[q] and upper_bound(int(above[q][cut[q]]), int(above[q][0]), share[q]) <= allowed[q]:
            cut[q] -= 1
        to = [x for x in above if cut[x]]
        if not cut[q] and to:
            for x in to:
                share[x] += share[q] / len(to)
            share[q], waiting = 0.0, to
    return {(rule, s): cut.get((rule, s), GRID) for rule in good for s in range(len(STRATA))}


def rates_names() -> tuple[str, ...]:
    return ("symbols", "dup_lines", "repeats", "short_words", "long_words")


def label_table(counted: DataFrame, labels: DataFrame, doc_id: str = "doc_id", grade: str = "quality") -> list[tuple[str, int, int, int]]:
    """(rule, stratum, step, good documents there), of all labelled documents that pass the base rule."""
    good = labels.where(F.col(doc_id).isNotNull() & F.col(grade).isNotNull()).groupBy(F.col(doc_id).alias("label_id")).agg(F.min(grade).alias("grade"))
    pairs = F.array(*[F.struct(F.lit(name).alias("rule"), step.alias("step")) for name, step in _steps().items()])
    rows = (
        counted.where(~base_failed()).select(F.col(doc_id).alias("label_id"), stratum().alias("stratum"), F.explode(pairs).alias("p"))
        .join(good.where("grade = 1"), "label_id")
        .groupBy("p.rule", "stratum", "p.step").count()
    )
    return [(r[0], r[1], r[2], r[3]) for r in rows.collect()]  # strata x rules x steps rows


def learn_cutoffs(counted: DataFrame, labels: DataFrame, doc_id: str = "doc_id", grade: str = "quality", alpha: float = ALPHA, delta: float = DELTA, most: float = MOST_ALPHA) -> dict[tuple[str, int], int]:
    """Cutoffs from all labelled documents that pass the base rule."""
    table = label_table(counted, labels, doc_id, grade)
    cutoffs = choose_cutoffs(table, alpha, delta, most)
    for row in cutoff_report(table, cutoffs, alpha, delta, most):
        logging.getLogger(__name__).log(
            logging.INFO if row[-1] else logging.WARNING, "rule %s, stratum %d: %d good labels, allowed rate %s, cutoff %.3f, active: %s", *row
        )
    return cutoffs


def cutoff_report(
    table: list[tuple[str, int, int, int]], cutoffs: dict[tuple[str, int], int], alpha: float = ALPHA, delta: float = DELTA, most: float = MOST_ALPHA
) -> list[tuple[str, int, int, float | None, float, bool]]:
    """(rule, stratum, good labels, allowed rate, cutoff as a rate, whether it can reject anything)."""
    good, allowed = _good(table), allowed_rates(table, alpha, delta, most)
    return [(rule, s, int(good[rule][s].sum()), allowed[rule, s], cut / GRID, cut < GRID) for (rule, s), cut in cutoffs.items()]


def verdict(cutoffs: dict[tuple[str, int], int]) -> Column:
    """Whether a document passes every rule."""
    ok = F.lit(True)
    for name, step in _steps().items():
        limit = F.element_at(F.array(*[F.lit(cutoffs[name, s]) for s in range(len(STRATA))]), stratum() + 1)
        ok = ok & (step <= limit)
    return ok


def quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", alpha: float = ALPHA, delta: float = DELTA, most: float = MOST_ALPHA) -> DataFrame:
    """One row a document: the counts, base_failed and kept."""
    stage = Stage(docs.sparkSession, "quality")
    counted = stage.save(with_counts(docs.select(doc_id, F.col(text).alias("text")), "text").drop("text"), "counts")
    cutoffs = learn_cutoffs(counted, labels, doc_id, alpha=alpha, delta=delta, most=most)
    return counted.select(
        doc_id, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"), (~base_failed() & verdict(cutoffs)).alias("kept"),
    )
