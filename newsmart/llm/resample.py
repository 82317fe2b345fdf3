"""Documents drawn by importance towards a target set of texts.

Texts are lower-cased (A to Z only) and cut into words by a Split pre-tokenizer, which is given as a pattern
and needs no training; it returns every word with its offsets. A feature is a run of following words, taken
as a window of offset pairs and joined by single blanks; its bucket is the CRC-32 of its UTF-8 bytes modulo
`buckets`. The counts of the buckets over all documents and all target texts give each bucket a gain; a
document's weight is the floored mean of its features' gains. Gumbel noise from a hash of the document's id
makes the highest scores a draw without replacement.

Buckets of a document's features are written once, two bytes each (four beyond 65,536 buckets), so texts are
cut only once. The driver sees the counts of the buckets and the number of documents at each score; scores
are whole numbers within a range that the gains and the noise bound (below 150,000 values).

Nulls and texts without words have no features and the weight 0. A null id has no noise: its score and rank are
null and it takes no part in the draw. Rows that repeat an id are documents of their own, each with a rank;
among equal scores and ids the one with fewer features comes first. With an empty table or fewer than
100 / percent documents nobody is drawn; without target texts all gains come from the documents alone. Other
columns of the tables aren't read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsmart.llm.arrow import Stage, slices

#: Words of a feature, from and to.
WORDS = (1, 1)
BUCKETS = 10_000
SEED = "2024"
#: Documents with fewer words aren't drawn.
LEAST_WORDS = 20
PERCENT = 10

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_GAP = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
#: Bytes of text that the pre-tokenizer gets at once; the next gap ends the part.
_PART = 1 << 16
#: Features whose buckets a task remembers.
_KNOWN = 1 << 17


def parts(raw: bytes) -> Iterator[bytes]:
    """The text in parts of about _PART bytes that end where a word ends."""
    at = 0
    while at < len(raw):
        gap = _GAP.search(raw, at + _PART)
        stop = gap.start() if gap else len(raw)
        yield raw[at:stop]
        at = stop


class Buckets(dict):
    """The bucket of a feature; what was asked for lately is remembered."""

    def __init__(self, buckets: int) -> None:
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= _KNOWN:
            self.clear()
        self[feature] = found = zlib.crc32(feature) % self.buckets
        return found


class Cutter:
    """Cuts texts into words and gives the buckets of their features."""

    def __init__(self, words: tuple[int, int], buckets: int) -> None:
        from tokenizers import PreTokenizedString, Regex, pre_tokenizers

        self.split = pre_tokenizers.Split(Regex(_WORD), "removed", invert=True)
        self.open = PreTokenizedString
        self.first, self.last = words
        self.bucket = Buckets(buckets)
        self.kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")

    def spans(self, text: str) -> list[tuple[int, int]]:
        """Byte offsets of the words."""
        cut = self.open(text)
        self.split.pre_tokenize(cut)
        return [span for _, span, _ in cut.get_splits(offset_referential="original", offset_type="byte")]

    def features(self, raw: bytes) -> tuple[int, list[np.ndarray]]:
        """Number of words, and the buckets of all features, in pieces."""
        n, out, tail = 0, [], []
        for part in parts(raw.lower()):
            text = part.decode("utf-8", "replace")
            part = text.encode()  # the offsets are those of what is cut
            spans = self.spans(text)
            n += len(spans)
            found: list[int] = []
            if self.first <= 1:
                found.extend(map(self.bucket.__getitem__, [part[a:b] for a, b in spans]))
            if self.last > 1:
                words = tail + [part[a:b] for a, b in spans]
                for k in range(max(2, self.first), self.last + 1):
                    # windows that end in this part; those before ended in an earlier one
                    found.extend(
                        self.bucket[b" ".join(words[e - k : e])] for e in range(max(k, len(tail) + 1), len(words) + 1)
                    )
                tail = words[-(self.last - 1) :]
            out.append(np.array(found, dtype=self.kind))
        return n, out


def hashed_features(texts: DataFrame, text: str, words: tuple[int, int], buckets: int) -> DataFrame:
    """The columns of texts but `text`, with n_words, n_features and the features' buckets (integers, little-endian)."""
    kept = [c for c in texts.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = Cutter(words, buckets)
        for whole in batches:
            for batch in slices(whole, text):
                column = batch.column(batch.schema.get_field_index(text)).cast(pa.large_binary())
                counts, sizes, coded = [], [], []
                for value in column:
                    raw = value.as_py() or b""
                    n, found = cutter.features(raw)
                    counts.append(n)
                    sizes.append(sum(map(len, found)))
                    coded.append(b"".join(x.tobytes() for x in found))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(batch.schema.get_field_index(c)) for c in kept]
                    + [pa.array(counts, pa.int64()), pa.array(sizes, pa.int64()), pa.array(coded, pa.binary())],
                    names=[*kept, "n_words", "n_features", "buckets"],
                )

    fields = [f"`{c}` {texts.schema[c].dataType.simpleString()}" for c in kept]
    return texts.mapInArrow(run, ", ".join([*fields, "n_words bigint, n_features bigint, buckets binary"]))


def _flat(column: pa.Array, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """All values of the column one after the other, and where each row's begin (one more at the end)."""
    column = column.cast(pa.large_binary())
    bounds = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return np.frombuffer(raw[bounds[0] : bounds[-1]].tobytes(), dtype=kind), (bounds - bounds[0]) // kind.itemsize


def bucket_counts(features: DataFrame, buckets: int) -> np.ndarray:
    """How many features each bucket holds; the driver gets one row a bucket."""
    kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            total += np.bincount(_flat(batch.column(0), kind)[0], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["bucket", "n"])

    rows = features.select("buckets").mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, dtype=np.int64)
    for r in rows.collect():
        out[r.bucket] = r.n
    return out


def gains(docs: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Each bucket's log ratio of target to documents, smoothed by one, in thousandths, floored."""
    many, wanted = float(docs.sum() + len(docs)), float(target.sum() + len(target))
    return np.array(
        [math.floor(1000 * math.log(((t + 1.0) * many) / ((s + 1.0) * wanted))) for s, t in zip(docs.tolist(), target.tolist(), strict=True)],
        dtype=np.int64,
    )


def weights(features: DataFrame, gain: np.ndarray) -> DataFrame:
    """The floored mean gain of each row's features, as weight in place of the buckets."""
    kind = np.dtype("<u2" if len(gain) <= 1 << 16 else "<u4")
    kept = [c for c in features.columns if c != "buckets"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, bounds = _flat(batch.column(batch.schema.get_field_index("buckets")), kind)
            sums = np.concatenate([[0], np.cumsum(gain[values])])
            n = np.diff(bounds)
            weight = (sums[bounds[1:]] - sums[bounds[:-1]]) // np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)) for c in kept] + [pa.array(weight, pa.int64())],
                names=[*kept, "weight"],
            )

    fields = [f"`{c}` {features.schema[c].dataType.simpleString()}" for c in kept]
    return features.mapInArrow(run, ", ".join([*fields, "weight bigint"]))


def noise(doc_id: str, seed: str) -> Column:
    """Gumbel noise in thousandths from a hash of the id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col(doc_id).cast("string")), 256), 1, 8), 16, 10)
    share = (h.cast("bigint").cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000.0 * F.log(-F.log(share))).cast("bigint")


def drawn_ranks(scored: DataFrame, doc_id: str, able: Column, percent: int) -> DataFrame:
    """scored with rank 1, 2, 3 ... for the highest `percent` in a hundred scores of the able rows, ties by id; else null.

    The rows at each score are counted first, which says where its ranks begin, so no window holds more than the
    rows of one score; rows that are equal in every column are counted once there and get their ranks one by one.
    """
    spark = scored.sparkSession
    levels = scored.where(able).groupBy("score").agg(F.count(F.lit(1)).alias("n")).collect()
    draw = sum(r.n for r in levels) * percent // 100
    begin, above = [], 0
    for r in sorted(levels, key=lambda r: -r.score):
        if above >= draw:
            break
        begin.append((r.score, above))
        above += r.n
    if not begin:
        return scored.withColumn("rank", F.lit(None).cast("bigint"))
    lowest = begin[-1][0]
    starts = F.broadcast(spark.createDataFrame(begin, "score bigint, above bigint"))
    high = able & (F.col("score") >= lowest)
    others = [c for c in scored.columns if c not in (doc_id, "score")]
    before = Window.partitionBy("score").orderBy(doc_id, *others).rowsBetween(Window.unboundedPreceding, -1)
    groups = (
        scored.where(high).groupBy(*scored.columns).agg(F.count(F.lit(1)).alias("_n")).join(starts, "score")
        .withColumn("_first", F.col("above") + F.coalesce(F.sum("_n").over(before), F.lit(0)) + 1)
    )
    ranked = groups.withColumn("rank", F.explode(F.sequence("_first", F.col("_first") + F.col("_n") - 1)))
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= draw, F.col("rank"))).select(*scored.columns, "rank")
    return ranked.unionByName(scored.where(~F.coalesce(high, F.lit(False))).withColumn("rank", F.lit(None).cast("bigint")))


def resampled(
    docs: DataFrame,
    target: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    words: tuple[int, int] = WORDS,
    buckets: int = BUCKETS,
    seed: str = SEED,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """One row a document: its id, n_words, n_features, weight, score and rank (null: not drawn)."""
    stage = Stage(docs.sparkSession, "resample")
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    features = stage.save(hashed_features(rows, "text", words, buckets), "features")
    wanted = hashed_features(target.select(F.col(target_text).cast("string").alias("text")), "text", words, buckets)
    gain = gains(bucket_counts(features, buckets), bucket_counts(wanted, buckets))
    scored = weights(features, gain).withColumn("score", F.col("weight") + noise("id", seed))
    scored = stage.save(scored, "scores")
    able = F.col("id").isNotNull() & (F.col("n_words") >= least_words)
    return drawn_ranks(scored, "id", able, percent).withColumnRenamed("id", doc_id)


def importance(docs: DataFrame, target: DataFrame) -> DataFrame:
    """doc_id, n_features, weight, score, rank."""
    return resampled(docs, target).select("doc_id", "n_features", "weight", "score", "rank")
