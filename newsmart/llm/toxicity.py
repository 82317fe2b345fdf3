"""Toxicity by weak supervision: many voters, a generative model of them, a linear classifier on its labels.

Voters are terms and patterns. Terms are whole words and beginnings of words of 4, 5 and 6 bytes; those
tied to labelled toxic texts become voters, beside a short fixed lexicon. Patterns are fixed. A label model
(two classes, a firing rate for each voter and class, fitted by expectation maximisation) estimates how
accurate each voter is. Voters that fire together beyond what the class explains share their weight. Its
posterior labels, not the given ones, train a logistic regression on the voters' terms and patterns; the
given labels then scale its scores so that they are probabilities.

The model is fitted on the driver with numpy on a bounded sample of labelled texts. Scores read whole
texts, row by row. Null and empty texts are scored like texts in which nothing fires. Rows held out,
without id, text or label aren't learned from; a document with both labels counts as toxic. Without
labelled toxic texts only the fixed voters count, with fixed weights.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsmart.llm.arrow import add_columns
from newsmart.llm.langid import held_out
from newsmart.llm.tokens import FOLDED, Texts, byte_set, chunks, hash_spans, mixed, split_words

#: Labelled texts of each label that are learned from, at most, and the bytes such a text may have.
SAMPLE = {1: 1500, 0: 3000}
MOST_BYTES = 1 << 16
#: Voters mined from labelled texts, at most.
VOTERS = 400
#: A mined term's share of toxic texts is at least this, by the lower end of its interval of so many
#: standard deviations: as very many terms are tried, some fit by chance.
PRECISION = 0.6
SURE = 1.96
#: A term fires on clean texts at this part of its rate on toxic ones, at most.
MOST_RATIO = 0.1
THRESHOLD = 0.7
BEGINNINGS = (4, 5, 6)
#: Words that vote whatever the labels say.
LEXICON = (
    "idiot moron stupid loser scum trash pathetic worthless disgusting imbecile cretin bastard dumbass "
    "arschloch dummkopf trottel idiota imbécil estúpido pendejo connard imbécile crétin salaud"
).split()
PATTERNS = ("shouting", "exclaiming", "masked")

_WORD = byte_set([(0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)])
_UPPER = byte_set([(0x41, 0x5A)])
_LOWER = byte_set([(0x61, 0x7A)])
_SALTS = {n: np.uint64(mixed(np.array([n + 1], dtype=np.uint64))[0]) for n in (0, *BEGINNINGS)}


def terms(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """(owner, term hash) of every word and every beginning of a longer word, with repeats."""
    words = split_words(texts, _WORD)
    owners, size = words.owners(), words.ends - words.starts
    all_owners, all_hashes = [owners], [hash_spans(texts.buf, words.starts, words.ends, FOLDED) ^ _SALTS[0]]
    for n in BEGINNINGS:
        long = size > n
        begin = words.starts[long]
        all_owners.append(owners[long])
        all_hashes.append(hash_spans(texts.buf, begin, begin + n, FOLDED) ^ _SALTS[n])
    return np.concatenate(all_owners), np.concatenate(all_hashes)


def word_terms(words: list[str]) -> np.ndarray:
    """The term hashes of whole words."""
    raw = [w.encode() for w in words]
    bounds = np.cumsum([0, *map(len, raw)])
    return hash_spans(np.frombuffer(b"".join(raw), dtype=np.uint8), bounds[:-1], bounds[1:], FOLDED) ^ _SALTS[0]


def patterns(texts: Texts) -> np.ndarray:
    """Whether each of PATTERNS fires in each text: mostly capitals, runs of exclamation marks, letters beside asterisks."""

    def total(marks: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])
        ends = np.minimum(texts.offsets, len(marks))
        return sums[ends[1:]] - sums[ends[:-1]]

    def within(marks: np.ndarray, width: int) -> np.ndarray:
        """Marks of runs of `width` bytes that don't reach into the next text."""
        marks = marks.copy()
        for back in range(1, width):
            at = texts.offsets[1:-1] - back
            marks[at[(at >= 0) & (at < len(marks))]] = False
        return marks

    buf = texts.buf
    upper, lower = total(_UPPER[buf]), total(_LOWER[buf])
    bang = buf == ord("!")
    star = buf == ord("*")
    exclaiming = total(within(bang[:-1] & bang[1:], 2)) > 0
    masked = total(within(_WORD[buf[:-2]] & star[1:-1] & star[2:], 3)) > 0
    return np.stack([(upper > lower) & (upper >= 10), exclaiming, masked], axis=1)


def _unique_pairs(owners: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((owners, values))
    owners, values = owners[order], values[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (owners[1:] != owners[:-1])
    return owners[new], values[new]


def _lower_end(k: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The lower end of the Wilson interval of a share."""
    z2 = SURE**2
    return (k + z2 / 2 - SURE * np.sqrt(np.maximum(k * (n - k) / n, 0) + z2 / 4)) / (n + z2)


def mine(owners: np.ndarray, values: np.ndarray, toxic: np.ndarray, most: int = VOTERS) -> np.ndarray:
    """Hashes of the terms whose texts are toxic for the most part, the surest and commonest first."""
    if not len(values):
        return np.zeros(0, np.uint64)
    begin = np.concatenate([[0], np.flatnonzero(values[1:] != values[:-1]) + 1])
    both = np.diff(np.append(begin, len(values)))
    bad = np.add.reduceat(toxic[owners].astype(np.int64), begin)
    sure = _lower_end(bad, both)
    chosen = np.flatnonzero((sure > PRECISION) & (bad >= 3))
    return values[begin[chosen[np.lexsort((values[begin[chosen]], -bad[chosen], -sure[chosen]))][:most]]]


def unlike(texts: Texts, keys: int = 6, width: int = 3) -> np.ndarray:
    """Indexes of texts that are no near copies of one another, so that copies don't pass off their words as toxic.

    Texts are alike when their smallest hashes of long words agree under `width` orders, for one of `keys` choices.
    """
    words = split_words(texts, _WORD)
    long = words.ends - words.starts > 6
    owners = words.owners()[long]
    hashes = hash_spans(texts.buf, words.starts[long], words.ends[long], FOLDED)
    group = np.arange(len(texts))
    if not len(owners):
        return group
    begin = np.concatenate([[0], np.flatnonzero(owners[1:] != owners[:-1]) + 1])
    have = owners[begin]
    for key in range(keys):
        total = np.zeros(len(have), dtype=np.uint64)
        for i in range(width):
            seed = np.uint64(1 + key * width + i)
            least = np.minimum.reduceat(mixed(hashes ^ mixed(np.array([seed]))[0]), begin)
            total = mixed(total + least)
        order = np.argsort(total, kind="stable")
        same = total[order][1:] == total[order][:-1]
        first = have[order][np.maximum.accumulate(np.where(np.concatenate([[True], ~same]), np.arange(len(order)), 0))]
        group[have[order]] = np.minimum(group[have[order]], group[first])
    return np.flatnonzero(group == np.arange(len(texts)))


@dataclass
class Model:
    keys: np.ndarray  # rising term hashes
    weights: np.ndarray  # of the terms, of PATTERNS, and of one, two or more, and three or more terms that fire
    bias: float
    scale: float
    shift: float

    def fires(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """(owner, index of the term), each pair once."""
        owners, values = terms(texts)
        if not len(self.keys) or not len(values):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        known = np.zeros(1 << 16, dtype=bool)
        known[(self.keys >> np.uint64(48)).astype(np.int64)] = True
        maybe = known[(values >> np.uint64(48)).astype(np.int64)]
        owners, values = owners[maybe], values[maybe]
        at = np.minimum(np.searchsorted(self.keys, values), len(self.keys) - 1)
        hit = self.keys[at] == values
        pairs = np.unique(owners[hit] * len(self.keys) + at[hit])
        return pairs // len(self.keys), pairs % len(self.keys)

    def logits(self, texts: Texts) -> np.ndarray:
        owners, at = self.fires(texts)
        out = np.bincount(owners, self.weights[at], len(texts)) + self.bias
        many = several(np.bincount(owners, minlength=len(texts)))
        return out + np.column_stack([patterns(texts), many]) @ self.weights[len(self.keys) :]

    def scores(self, texts: Texts) -> np.ndarray:
        return _sigmoid(self.scale * self.logits(texts) + self.shift)


def several(fired: np.ndarray) -> np.ndarray:
    """Whether one, two and three terms fire at least."""
    return fired[:, None] >= np.arange(1, 4)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def label_model(votes: np.ndarray, n_terms: int, prior: float, rounds: int = 30) -> np.ndarray:
    """The posterior of being toxic for each row of 0/1 votes, of which the first n_terms are by terms.

    Whether any term fires is a voter too. Terms are held to be better than chance; patterns needn't be.
    """
    anything = votes[:, :n_terms].any(axis=1)
    q = anything * 0.8 + 0.1
    votes = np.column_stack([anything, votes])
    most = np.where(np.arange(votes.shape[1]) <= n_terms, MOST_RATIO, 1e9)
    for _ in range(rounds):
        bad, good = q.sum() + 1e-9, (1 - q).sum() + 1e-9
        rate1 = np.clip((q @ votes + 0.5 * prior) / (bad + 1), 1e-4, 1 - 1e-4)
        rate0 = np.clip(((1 - q) @ votes + 0.01) / (good + 1), 1e-5, 1 - 1e-4)
        rate0 = np.minimum(rate0, rate1 * most)
        expected = q[:, None] * rate1 + (1 - q)[:, None] * rate0
        rest = votes - expected
        norm = np.sqrt((rest**2).sum(axis=0)) + 1e-9
        together = np.clip((rest.T @ rest) / norm[:, None] / norm, 0, 1)
        np.fill_diagonal(together, 0)
        share = 1 / (1 + (together * (together > 0.1)).sum(axis=1))  # correlated voters count as fewer
        # a single voter that doesn't fire abstains; that none does is told by the first one
        nothing = np.log((1 - rate1[0]) / (1 - rate0[0])) * (1 - votes[:, 0])
        logit = np.log(prior / (1 - prior)) + votes @ (share * np.log(rate1 / rate0)) + nothing
        q_new = _sigmoid(logit)
        if np.abs(q_new - q).max() < 1e-6:
            break
        q = q_new
    return q


def _regression(x: np.ndarray, y: np.ndarray, ridge: float, rounds: int = 25) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels, by Newton's method with a ridge on the weights."""
    full = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(full.shape[1])
    penalty = np.append(np.full(x.shape[1], ridge), 1e-6)
    for _ in range(rounds):
        p = _sigmoid(full @ w)
        slope = full.T @ (p - y) + penalty * w
        bend = (full * (p * (1 - p))[:, None]).T @ full + np.diag(penalty)
        step = np.linalg.solve(bend, slope)
        w -= step * min(1.0, 4.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def fixed_model() -> Model:
    """The fixed voters with fixed weights."""
    keys = np.sort(word_terms(LEXICON))
    return Model(keys, np.concatenate([np.full(len(keys), 4.0), [0.5, 0.5, 0.5, 0.0, 0.0, 0.0]]), -4.0, 1.0, 0.0)


def train(texts: list[bytes], labels: np.ndarray) -> Model:
    """A model from labelled texts."""
    join = lambda: Texts(np.frombuffer(b"".join(texts), dtype=np.uint8), np.cumsum([0, *map(len, texts)], dtype=np.int64), 0)
    chosen = unlike(join())
    texts, toxic = [texts[i] for i in chosen], np.asarray(labels)[chosen] == 1
    if not toxic.any() or toxic.all():
        return fixed_model()
    joined = join()
    mined = mine(*_unique_pairs(*terms(joined)), toxic)
    keys = np.unique(np.concatenate([mined, word_terms(LEXICON)]))
    model = Model(keys, np.zeros(len(keys) + len(PATTERNS)), 0.0, 1.0, 0.0)
    votes = np.zeros((len(texts), len(keys) + len(PATTERNS)))
    votes[model.fires(joined)] = 1
    votes[:, len(keys) :] = patterns(joined)
    posterior = label_model(votes, len(keys), float(np.clip(toxic.mean(), 0.01, 0.5)))
    rows = np.column_stack([votes, several(votes[:, : len(keys)].sum(axis=1))])
    model.weights, model.bias = _regression(rows, posterior, 0.1)
    logits = rows @ model.weights + model.bias
    line, shift = _regression(logits[:, None], np.where(toxic, 1 - 0.5 / toxic.sum(), 0.5 / (~toxic).sum()), 1e-3)
    if line[0] > 0:
        model.scale, model.shift = float(line[0]), float(shift)
    return model


def labelled_sample(docs: DataFrame, labels: DataFrame, doc_id: str, text: str) -> tuple[list[bytes], np.ndarray]:
    """Labelled texts that aren't held out, chosen by their ids' hash: about as many of each label as SAMPLE says."""
    marks = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    marks = marks.groupBy(F.col("doc_id").alias("i")).agg(F.max("toxic").cast("int").alias("y"))
    found = {r.y: r["count"] for r in marks.where("y IN (0, 1)").groupBy("y").count().collect()}
    chance = lambda y: min(1.0, SAMPLE[y] / max(1, found.get(y, 0)))
    place = F.pmod(F.xxhash64(F.col("i").cast("string")), F.lit(1 << 20)) / (1 << 20)
    marks = marks.where(((F.col("y") == 1) & (place < chance(1))) | ((F.col("y") == 0) & (place < chance(0))))
    marks = F.broadcast(marks.limit(2 * sum(SAMPLE.values())))  # so many small rows at most
    rows = docs.select(F.col(doc_id).alias("i"), F.col(text).cast("string").alias("t")).where("t IS NOT NULL").where(F.octet_length("t") <= MOST_BYTES)
    chosen = rows.join(marks, "i").select("t", "y").orderBy(F.xxhash64("t"), "y").limit(2 * sum(SAMPLE.values())).collect()
    return [r.t.encode() for r in chosen], np.array([r.y for r in chosen], dtype=np.int64)


_FIELDS = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with score and predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        own = [shared.value.scores(t) for t in chunks(batch.column(batch.schema.get_field_index(text)))]
        score = np.concatenate(own) if own else np.zeros(0)
        return [pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))]

    return add_columns(docs, text, _FIELDS, compute)


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Model:
    return train(*labelled_sample(docs, labels, doc_id, text))


def toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: held_out, score, predicted."""
    rows = docs.select(F.col(doc_id), F.col(text).cast("string").alias("text"), held_out(F.col(doc_id)).alias("held_out"))
    return predict(rows, fit(docs, labels, doc_id, text), "text").select(doc_id, "held_out", "score", "predicted")


def acceptable_documents(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that aren't predicted toxic, with the columns they had."""
    columns = docs.columns
    renamed = docs.toDF(*[f"c{i}" for i in range(len(columns))])
    scored = predict(renamed, fit(docs, labels, doc_id, text), f"c{columns.index(text)}")
    return scored.where("predicted = 0").drop("score", "predicted").toDF(*columns)
