"""Benchmark passages in documents, found by Wu-Manber search for many strings at once.

Texts are reduced to words (ASCII letters lower-cased, everything that is no letter, digit or longer code
point is a gap) written with one blank before, between and after them. A window of the benchmark is such
a string too, so that a hit always covers whole words.

The search looks at the last bytes of the shortest window's length: a table over hashed blocks says how
far no window can end, and the position jumps there. Where the table says nothing, windows that begin and
end with the same blocks are taken from a bucket and compared byte by byte. All stretches of a chunk of
text advance together as numpy arrays.

The windows are broadcast in blocks of a checked size; each block is searched in all documents.

Nulls and texts without words have no words and no hits. Benchmark items without id, text or words are
left out; rows with the same id are one item. Documents are handled row by row, so repeated rows give
repeated results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsmart.llm.arrow import add_columns
from newsmart.llm.tokens import ALNUM, FOLDED, Texts, Words, chunks, split_words

#: Words of a benchmark window.
WINDOW = 10
#: Bytes of windows and item ids that are broadcast at once.
BLOCK_BYTES = 16 << 20
#: Lengths from which a group of windows has blocks of so many bytes.
_BLOCKS = ((16, 8), (8, 4), (3, 2))
_SHIFT_BITS = 20
_STRETCH = 2048
_DTYPES = {8: np.uint64, 4: np.uint32, 2: np.uint16}
_TURN = np.uint64(0x9E3779B97F4A7C15)


def plain(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, Words]:
    """Texts as words between single blanks: the bytes, each word's leading blank, each text's start, the words."""
    words = split_words(texts, ALNUM)
    lengths = words.ends - words.starts
    n = len(texts)
    counts = words.counts()
    # a text takes its words with a blank each, a closing blank and a zero byte
    at = np.concatenate([[0], np.cumsum(lengths + 1)])
    begins = at[:-1] + 2 * words.owners()
    size = int(at[-1] + 2 * n)
    out = np.full(size, 0x20, dtype=np.uint8)
    edges = at[words.bounds] + 2 * np.arange(n + 1)
    out[edges[1:] - 1] = 0
    inside = ALNUM[texts.buf]
    source = FOLDED[texts.buf[inside]]
    to = np.arange(len(source)) + np.repeat(begins + 1 - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
    out[to] = source
    del counts
    return out, begins, edges, words


def windows_of(column: pa.Array, window: int = WINDOW) -> Iterator[tuple[int, bytes]]:
    """(row, window) for every window of every text; a text of fewer words is one window."""
    for texts in chunks(column):
        out, begins, edges, words = plain(texts)
        raw = out.tobytes()
        for i in range(len(texts)):
            a, b = int(words.bounds[i]), int(words.bounds[i + 1])
            last = int(edges[i + 1]) - 1  # the closing blank is at last - 1
            for k in range(a, max(a + (b > a), b - window + 1)):
                stop = int(begins[k + window]) + 1 if k + window < b else last
                yield texts.first + i, raw[int(begins[k]) : stop]


def _loads(buf: np.ndarray, size: int) -> np.ndarray:
    """The integer of `size` bytes at every position."""
    return np.ndarray((max(len(buf) - size + 1, 0),), dtype=_DTYPES[size], buffer=buf, strides=(1,))


def _slot(blocks: np.ndarray) -> np.ndarray:
    return ((blocks.astype(np.uint64) * _TURN) >> np.uint64(64 - _SHIFT_BITS)).astype(np.int64)


class Group:
    """Windows whose lengths call for the same block size, with their shift table and buckets."""

    def __init__(self, patterns: list[bytes], numbers: list[int], block: int) -> None:
        self.block = block
        self.m = m = min(map(len, patterns))
        self.patterns = patterns
        self.numbers = numbers
        heads = np.frombuffer(b"".join(p[:m] for p in patterns), dtype=np.uint8).reshape(len(patterns), m)
        self.shift = np.full(1 << _SHIFT_BITS, m - block + 1, dtype=np.int32)
        for j in range(m - block + 1):
            values = np.ascontiguousarray(heads[:, j : j + block]).view(_DTYPES[block]).ravel()
            np.minimum.at(self.shift, _slot(values), m - block - j)
        first = np.ascontiguousarray(heads[:, :block]).view(_DTYPES[block]).ravel()
        last = np.ascontiguousarray(heads[:, m - block :]).view(_DTYPES[block]).ravel()
        keys = self._key(first, last)
        order = np.argsort(keys, kind="stable")
        self.order, self.keys = order, keys[order]

    @staticmethod
    def _key(first: np.ndarray, last: np.ndarray) -> np.ndarray:
        return (first.astype(np.uint64) * _TURN) ^ (last.astype(np.uint64) * np.uint64(0xD1342543DE82EF95))

    def search(self, buf: np.ndarray) -> Iterator[tuple[int, int]]:
        """(position, window number) of every occurrence in buf."""
        m, size = self.m, self.block
        spots = len(buf) - m + 1
        if spots <= 0:
            return
        loads = _loads(buf, size)
        begin = np.arange(0, spots, _STRETCH, dtype=np.int64)
        stop = np.minimum(begin + _STRETCH, spots)
        found = []
        while len(begin):
            jump = self.shift[_slot(loads[begin + (m - size)])]
            halt = jump == 0
            if halt.any():
                found.append(begin[halt])
            begin = begin + np.maximum(jump, 1)
            go = begin < stop
            if not go.all():
                begin, stop = begin[go], stop[go]
        if not found:
            return
        spots = np.concatenate(found)
        keys = self._key(loads[spots], loads[spots + (m - size)])
        low = np.searchsorted(self.keys, keys, side="left")
        high = np.searchsorted(self.keys, keys, side="right")
        hit = high > low
        for p, a, b in zip(spots[hit].tolist(), low[hit].tolist(), high[hit].tolist(), strict=True):
            for k in self.order[a:b].tolist():
                pattern = self.patterns[k]
                if buf[p : p + len(pattern)].tobytes() == pattern:
                    yield p, self.numbers[k]


class Search:
    """All windows of a block; items[i] are the ids of those that window i belongs to, lengths[i] its words."""

    def __init__(self, patterns: list[bytes], items: list[list[str]]) -> None:
        self.items = items
        self.lengths = [p.count(b" ") - 1 for p in patterns]
        self.groups = []
        left = sorted(range(len(patterns)), key=lambda i: -len(patterns[i]))
        for least, block in _BLOCKS:
            own = [i for i in left if len(patterns[i]) >= least]
            left = left[len(own) :]
            if own:
                self.groups.append(Group([patterns[i] for i in own], own, block))

    def hits(self, texts: Texts) -> tuple[np.ndarray, dict[int, tuple[list[tuple[int, int]], set[str]]]]:
        """Number of words of each text; for texts with hits the word spans and the items."""
        buf, begins, edges, words = plain(texts)
        out: dict[int, tuple[list[tuple[int, int]], set[str]]] = {}
        for group in self.groups:
            for p, number in group.search(buf):
                text = int(np.searchsorted(edges, p, side="right")) - 1
                word = int(np.searchsorted(begins, p)) - int(words.bounds[text])
                spans, items = out.setdefault(text, ([], set()))
                spans.append((word, word + self.lengths[number]))
                items.update(self.items[number])
        return words.counts(), out


def merged(spans: list[tuple[int, int]]) -> list[int]:
    """The spans' union as from, to, from, to and so on."""
    out: list[int] = []
    for a, b in sorted(spans):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def benchmark_windows(benchmark: DataFrame, item: str, text: str, window: int = WINDOW) -> DataFrame:
    """Distinct (pattern, item): the windows of every item, ids as strings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            found = list(windows_of(batch.column(1), window))
            yield pa.RecordBatch.from_arrays(
                [pa.array([p for _, p in found], pa.binary()), ids.take(pa.array([i for i, _ in found], pa.int64()))],
                names=["pattern", "item"],
            )

    rows = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).cast("string").alias("text"))
    return rows.where("item IS NOT NULL AND text IS NOT NULL").mapInArrow(run, "pattern binary, item string").distinct()


_FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.LongType())),
    T.StructField("items", T.ArrayType(T.StringType())),
]


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """docs with n_words, spans (hit words as from, to, from, to ...) and items (sorted ids of items found)."""
    spark = docs.sparkSession
    rows = benchmark_windows(benchmark, item, item_text, window)
    size = rows.select(F.sum(F.length("pattern") + F.length("item") + 64)).first()[0] or 0
    n = max(1, math.ceil(size / block_bytes))
    if n > 1:
        rows = rows.withColumn("block", F.pmod(F.xxhash64("pattern", "item"), F.lit(n)))
    out = docs
    for k in range(n):
        part = rows if n == 1 else rows.where(F.col("block") == k)
        gathered: dict[bytes, list[str]] = {}
        for r in part.select("pattern", "item").toLocalIterator():
            gathered.setdefault(bytes(r[0]), []).append(r[1])
        patterns = sorted(gathered)
        block = spark.sparkContext.broadcast((patterns, [gathered[p] for p in patterns]))
        out = _search_block(out, text, block, k > 0)
    return out


def _search_block(docs: DataFrame, text: str, block: object, more: bool) -> DataFrame:
    state: dict[str, Search] = {}

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        if not state:
            state["search"] = Search(*block.value)
        col = lambda name: batch.column(batch.schema.get_field_index(name))
        n = batch.num_rows
        counts = np.zeros(n, dtype=np.int64)
        spans: list[list[int]] = [[]] * n
        items: list[list[str]] = [[]] * n
        old_spans, old_items = (col("spans"), col("items")) if more else (None, None)
        for texts in chunks(col(text)):
            counts[texts.first : texts.first + len(texts)], found = state["search"].hits(texts)
            for i, (own, ids) in found.items():
                spans[texts.first + i], items[texts.first + i] = merged(own), sorted(ids)
        if more:
            for i in range(n):
                if before := old_spans[i].as_py():
                    pairs = [*zip(before[::2], before[1::2], strict=True), *zip(spans[i][::2], spans[i][1::2], strict=True)]
                    spans[i], items[i] = merged(pairs), sorted({*old_items[i].as_py(), *items[i]})
        return [pa.array(counts), pa.array(spans, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))]

    return add_columns(docs, text, _FIELDS, compute)


def n_hit(spans: Column | str = "spans") -> Column:
    """Words covered by the spans."""
    return F.aggregate(
        F.transform(spans, lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)), F.lit(0).cast("bigint"), lambda a, x: a + x
    )


def decontamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: n_words, n_hit, n_items, items_sha256, contaminated."""
    found = find_passages(docs.select(doc_id, F.col(text).alias("text")), benchmark)
    return found.select(
        doc_id, "n_words", n_hit().alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents without any benchmark passage, with the columns they had."""
    columns = docs.columns
    renamed = docs.toDF(*[f"c{i}" for i in range(len(columns))])
    found = find_passages(renamed, benchmark, text=f"c{columns.index(text)}")
    return found.where(F.size("spans") == 0).drop("n_words", "spans", "items").toDF(*columns)
