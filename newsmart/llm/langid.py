"""Language of a text from averaged hashed subword embeddings and a linear softmax.

Subwords are the runs of 2, 3 and 4 bytes of the text, with ASCII letters lower-cased and other ASCII
turned to blanks, so that word edges count. Each is hashed to a row of an embedding table; the mean of the
rows goes through a linear layer and a softmax. Training is stochastic gradient descent in numpy on the
driver, on short pieces of a bounded sample of labelled texts. Part of the sample is held back to fit a
temperature, which makes scores probabilities, and a score below which a prediction is rejected.

As mean and linear layer are both linear, prediction uses one table of a row of scores for each hash; a
text costs one lookup for each subword and is read whole.

Texts that are null or have no letter get `und` with score 0. Predictions are made row by row. Rows
without text, id or language, and languages given as the empty text or `und`, aren't learned from. Without
any labelled row every text gets `und`.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsmart.llm.arrow import add_columns
from newsmart.llm.tokens import FOLDED, Texts, byte_set, chunks

#: Labelled texts that are learned from, at most, for each language; and the bytes such a text may have.
SAMPLE = 600
MOST_BYTES = 1 << 17
#: Labelled texts for all languages together, about, if that leaves LEAST for each.
TOTAL = 240_000
LEAST = 8
#: Languages whose scores are summed at once.
ABREAST = 32
BITS = 16
WIDTH = 16
GRAMS = (2, 3, 4)
#: Bytes of the pieces trained on, smallest and largest.
PIECE = (12, 400)
EPOCHS = 6
UNKNOWN = "und"

_PLAIN = FOLDED.copy()
_PLAIN[~byte_set([(0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)])] = 0x20
_TURN = np.uint32(0x9E3779B1)


def held_out(doc_id: Column) -> Column:
    """Whether a document belongs to the third that nothing is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def subwords(buf: np.ndarray) -> list[np.ndarray]:
    """The hash of the run of n bytes that begins at each byte, for each n of GRAMS."""
    plain = _PLAIN[buf].astype(np.uint32)
    out = []
    for n in GRAMS:
        code = np.full(max(len(plain) - n + 1, 0), n, dtype=np.uint32)
        for i in range(n):
            code = (code << np.uint32(8)) ^ plain[i : i + len(code)] ^ (code >> np.uint32(24))
        code *= _TURN
        code ^= code >> np.uint32(15)
        code *= np.uint32(0x85EBCA77)
        out.append((code >> np.uint32(32 - BITS)).astype(np.intp))
    return out


def _sums(rows: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Sums of rows[begin:end] for each pair; empty pairs give 0."""
    out = np.zeros((len(begin), rows.shape[1]), dtype=np.float64)
    full = np.flatnonzero(end > begin)
    if len(full):
        # what lies between one pair's end and the next one's begin is summed too and left out
        edges = np.empty(2 * len(full), dtype=np.int64)
        edges[::2], edges[1::2] = begin[full], end[full]
        if edges[-1] == len(rows):
            edges = edges[:-1]
        out[full] = np.add.reduceat(rows, edges, axis=0)[::2]
    return out


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # a row of scores for each hash
    bias: np.ndarray
    temperature: float
    least: float  # scores below it are rejected

    def probabilities(self, texts: Texts) -> np.ndarray:
        n = len(texts)
        total = np.zeros((n, len(self.languages)))
        count = np.zeros(n)
        for size, codes in zip(GRAMS, subwords(texts.buf), strict=True):
            begin = texts.offsets[:-1]
            end = np.maximum(texts.offsets[1:] - size + 1, begin)
            begin, end = np.minimum(begin, len(codes)), np.minimum(end, len(codes))
            for a in range(0, len(self.languages), ABREAST):
                total[:, a : a + ABREAST] += _sums(self.table[:, a : a + ABREAST][codes], begin, end)
            count += end - begin
        return softmax((total / np.maximum(count, 1)[:, None] + self.bias) / self.temperature)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _pieces(texts: list[bytes], labels: np.ndarray, rng: np.random.Generator) -> tuple[list[bytes], np.ndarray]:
    """A few random pieces of every text, of lengths spread evenly in their logarithm."""
    out, own = [], []
    for text, label in zip(texts, labels, strict=True):
        for _ in range(3):
            size = int(np.exp(rng.uniform(*np.log(PIECE))))
            at = int(rng.integers(0, max(1, len(text) - size + 1)))
            out.append(text[at : at + size])
            own.append(label)
    return out, np.array(own)


def _batch(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Subword hashes of the pieces and the piece of each."""
    codes, owners = [], []
    for i, piece in enumerate(pieces):
        for c in subwords(np.frombuffer(piece, dtype=np.uint8)):
            codes.append(c)
            owners.append(np.full(len(c), i))
    return np.concatenate(codes), np.concatenate(owners)


def train(texts: list[bytes], names: list[str], seed: int = 7) -> Model:
    """A model from labelled texts; every fifth text calibrates."""
    languages = sorted(set(names))
    rng = np.random.default_rng(seed)
    place = {x: i for i, x in enumerate(languages)}
    labels = np.array([place[x] for x in names])
    order = rng.permutation(len(texts))
    kept, held = order[len(order) // 5 :], order[: len(order) // 5]
    if not len(held):
        held = kept
    emb = rng.normal(0, 0.1, (1 << BITS, WIDTH)).astype(np.float32)
    out = np.zeros((WIDTH, len(languages)), dtype=np.float32)
    out += rng.normal(0, 0.1, out.shape)
    bias = np.zeros(len(languages), dtype=np.float32)
    share = np.bincount(labels[kept], minlength=len(languages))
    weight = (len(kept) / np.maximum(share, 1) / len(languages)).astype(np.float32)  # languages count alike
    for epoch in range(EPOCHS):
        pieces, own = _pieces([texts[i] for i in kept], labels[kept], rng)
        rate = 4.0 * (1 - epoch / EPOCHS)
        turn = rng.permutation(len(pieces))
        for at in range(0, len(turn), 64):
            part = turn[at : at + 64]
            codes, owners = _batch([pieces[i] for i in part])
            size = np.maximum(np.bincount(owners, minlength=len(part)), 1).astype(np.float32)
            # a sparse mean: sums over owners, which rise
            mean = _sums(emb[codes], np.searchsorted(owners, np.arange(len(part))), np.searchsorted(owners, np.arange(len(part)), "right"))
            mean = (mean / size[:, None]).astype(np.float32)
            p = softmax(mean @ out + bias)
            p[np.arange(len(part)), own[part]] -= 1
            p *= weight[own[part]][:, None] / len(part)
            back = (p @ out.T) / size[:, None]
            out -= rate * mean.T @ p
            bias -= 0.1 * rate * p.sum(axis=0)
            np.subtract.at(emb, codes, (rate * 20 * back)[owners].astype(np.float32))
    model = Model(languages, (emb @ out).astype(np.float32), bias.astype(np.float64), 1.0, 0.0)
    return calibrate(model, [texts[i] for i in held], labels[held], rng)


def calibrate(model: Model, texts: list[bytes], labels: np.ndarray, rng: np.random.Generator) -> Model:
    """The temperature of the least loss, and the lowest score from which 99 of 100 accepted pieces are right."""
    pieces, own = _pieces(texts, labels, rng)
    joined = Texts(np.frombuffer(b"".join(pieces), dtype=np.uint8), np.cumsum([0, *map(len, pieces)]), 0)
    model.temperature = 1.0
    raw = np.log(np.maximum(model.probabilities(joined), 1e-30))
    loss = lambda t: -np.log(np.maximum(softmax(raw / t)[np.arange(len(own)), own], 1e-12)).mean()
    model.temperature = float(min(np.geomspace(0.05, 5, 60), key=loss))
    p = softmax(raw / model.temperature)
    score, right = p.max(axis=1), p.argmax(axis=1) == own
    order = np.argsort(-score)
    rate = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
    fine = np.flatnonzero(rate >= 0.99)
    model.least = float(score[order][fine[-1]]) if len(fine) else 1.0
    return model


def labelled_sample(docs: DataFrame, doc_id: str, text: str, lang: str, most: int = SAMPLE) -> list[tuple[bytes, str]]:
    """About `most` labelled texts of each language, fewer of each if there are many languages, chosen by their ids' hash, from rows that aren't held out."""
    rows = docs.select(F.col(doc_id).alias("i"), F.col(text).alias("t"), F.col(lang).cast("string").alias("l"))
    rows = rows.where(F.col("i").isNotNull() & F.col("t").isNotNull() & F.col("l").isNotNull() & ~held_out(F.col("i")))
    rows = rows.where(~F.col("l").isin("", UNKNOWN))
    found = rows.groupBy("l").count().collect()
    if not found:
        return []
    most = min(most, max(LEAST, TOTAL // len(found)))
    large = {r[0]: most / r[1] for r in found if r[1] > most}
    chosen = rows.where(F.octet_length("t") <= MOST_BYTES)
    if large:
        chance = F.create_map(*[F.lit(x) for r in large.items() for x in r])
        place = F.pmod(F.xxhash64(F.col("i").cast("string")), F.lit(1 << 20)) / (1 << 20)
        chosen = chosen.where(place < F.coalesce(F.try_element_at(chance, F.col("l")), F.lit(1.0)))
    return [(r.t.encode(), r.l) for r in chosen.select("t", "l").orderBy(F.xxhash64("t"), "l").limit(2 * most * len(found)).collect()]


def _letters(column: pa.Array) -> np.ndarray:
    """Whether each text has a letter."""
    out = []
    ascii_letter = byte_set([(0x41, 0x5A), (0x61, 0x7A)])
    high = byte_set([(0x80, 0xFF)])
    for texts in chunks(column):
        sums = np.concatenate([[0], np.cumsum(ascii_letter[texts.buf], dtype=np.int64)])
        found = sums[texts.offsets[1:]] > sums[texts.offsets[:-1]]
        more = np.concatenate([[0], np.cumsum(high[texts.buf], dtype=np.int64)])
        for i in np.flatnonzero(~found & (more[texts.offsets[1:]] > more[texts.offsets[:-1]])):
            raw = texts.buf[texts.offsets[i] : texts.offsets[i + 1]].tobytes().decode(errors="replace")
            found[i] = any(c.isalpha() for c in raw)
        out.append(found)
    return np.concatenate(out) if out else np.zeros(0, bool)


_FIELDS = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("accepted", T.BooleanType())]


def predict(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """docs with lang_pred, score and accepted (the score is high enough to be trusted)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        own: Model | None = shared.value
        column = batch.column(batch.schema.get_field_index(text))
        written = _letters(column)
        names = np.full(len(written), UNKNOWN, dtype=object)
        score = np.zeros(len(written))
        if own is not None:
            for texts in chunks(column):
                p = own.probabilities(texts)
                at = slice(texts.first, texts.first + len(texts))
                score[at] = p.max(axis=1)
                names[at] = np.array(own.languages, dtype=object)[p.argmax(axis=1)]
        names[~written], score[~written] = UNKNOWN, 0.0
        return [pa.array(names, pa.string()), pa.array(score), pa.array(written & (score >= (own.least if own else 2.0)))]

    return add_columns(docs, text, _FIELDS, compute)


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", most: int = SAMPLE) -> Model | None:
    sample = labelled_sample(docs, doc_id, text, lang, most)
    return train([t for t, _ in sample], [x for _, x in sample]) if sample else None


def languages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row a document: held_out, lang_pred, score, accepted."""
    model = fit(docs, doc_id, text, lang)
    rows = docs.select(F.col(doc_id), F.col(text).cast("string").alias("text"), held_out(F.col(doc_id)).alias("held_out"))
    return predict(rows, model, "text").select(doc_id, "held_out", "lang_pred", "score", "accepted")
