"""Words, lines and shingles of many texts at once, as numpy arrays over one buffer of UTF-8 bytes.

A batch of texts is one byte array and the offsets of its texts. Words never cross a text. A word's hash
is a polynomial over its bytes modulo 2**64, taken from differences of running sums, then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once inside a task; a longer single text is handled alone.
CHUNK_BYTES = 1 << 20

_P = 0x9E3779B97F4A7C15 | 1
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_BASE = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)


def byte_set(spans: list[tuple[int, int]]) -> np.ndarray:
    """A table over the 256 byte values that is true for those in the closed spans."""
    table = np.zeros(256, dtype=bool)
    for first, last in spans:
        table[first : last + 1] = True
    return table


#: Every byte but the blank and \t to \r belongs to a word; bytes of longer code points always do.
NOT_BLANK = ~byte_set([(0x20, 0x20), (0x09, 0x0D)])
#: Digits, letters and everything beyond ASCII.
ALNUM = byte_set([(0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)])
NOT_NEWLINE = ~byte_set([(0x0A, 0x0A)])
AS_IS = np.arange(256, dtype=np.uint8)
FOLDED = AS_IS.copy()
FOLDED[0x41:0x5B] += 0x20


def mixed(h: np.ndarray) -> np.ndarray:
    """The 64-bit values scattered over the whole range."""
    h = h ^ (h >> np.uint64(30))
    h = h * _MIX[0]
    h ^= h >> np.uint64(27)
    h *= _MIX[1]
    h ^= h >> np.uint64(31)
    return h


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_LETTERS = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_P))
_CACHE: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_CACHE.get("up", ())) < n:
        _CACHE["up"] = _powers(n, _P)
        _CACHE["down"] = _powers(n, pow(_P, -1, 1 << 64))
    return _CACHE["up"], _CACHE["down"]


@dataclass
class Texts:
    """Texts of a batch: bytes of text i are buf[offsets[i]:offsets[i + 1]]; first is its row in the batch."""

    buf: np.ndarray
    offsets: np.ndarray
    first: int

    def __len__(self) -> int:
        return len(self.offsets) - 1


def chunks(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[Texts]:
    """The column's texts (null: empty) in row order, in pieces of about `most` bytes."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    if n == 0:
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1)
        j = min(j, n)
        yield Texts(buf[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], i)
        i = j


@dataclass
class Words:
    """Words of the texts: byte spans, and the index of each text's first word (one more at the end)."""

    texts: Texts
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.starts)

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def owners(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.texts)), self.counts())


def split_words(texts: Texts, in_word: np.ndarray = NOT_BLANK) -> Words:
    """Runs of bytes that the table marks, cut where a text ends."""
    inside = in_word[texts.buf]
    edges = texts.offsets[:-1]
    edges = edges[edges < len(inside)]
    before = np.empty(len(inside) + 1, dtype=bool)
    before[0] = False
    before[1:] = inside
    after = before[1:].copy()  # after[i]: the byte i is inside; shifted below
    before = before[:-1]
    before[edges] = False
    starts = np.flatnonzero(inside & ~before)
    after[:-1] = inside[1:]
    after[-1:] = False
    after[edges[edges > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(texts, starts, ends, np.searchsorted(starts, texts.offsets))


def hash_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray = AS_IS) -> np.ndarray:
    """A 64-bit hash of every byte span; spans are ordered and don't overlap. Empty spans have one hash too."""
    out = np.zeros(len(starts), dtype=np.uint64)
    letters = _LETTERS[fold]
    i = 0
    while i < len(starts):
        a = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, a + CHUNK_BYTES, side="right")))
        b = int(ends[j - 1])
        up, down = _power_tables(max(b - a, CHUNK_BYTES))
        sums = np.empty(b - a + 1, dtype=np.uint64)
        sums[0] = 0
        np.cumsum(letters[buf[a:b]] * up[: b - a], out=sums[1:])
        lo, hi = starts[i:j] - a, ends[i:j] - a
        out[i:j] = (sums[hi] - sums[lo]) * down[np.minimum(lo, len(down) - 1)]
        i = j
    return mixed(out)


def hash_words(words: Words, fold: np.ndarray = AS_IS) -> np.ndarray:
    return hash_spans(words.texts.buf, words.starts, words.ends, fold)


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """The hash of each run of k following values, wherever a text ends; len(hashes) - k + 1 of them."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for i in range(k):
        total = total * _BASE[0] + hashes[i : i + n]
    return mixed(total + np.uint64(k))


def shingles(words: Words, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of k words as (owner, hash), in order. A text with fewer words has its whole sequence as one."""
    counts = words.counts()
    have = np.maximum(counts - k + 1, 0)
    owners = np.repeat(np.arange(len(counts)), have)
    first = np.repeat(words.bounds[:-1] - np.concatenate([[0], np.cumsum(have)[:-1]]), have)
    values = windows(hashes, k)[first + np.arange(len(owners))] if len(owners) else np.zeros(0, np.uint64)
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        whole = np.zeros(len(short), dtype=np.uint64)
        for i in range(k - 1):
            there = counts[short] > i
            at = np.minimum(words.bounds[short] + i, max(len(hashes) - 1, 0))
            whole = np.where(there, whole * _BASE[1] + hashes[at], whole)
        owners = np.concatenate([owners, short])
        values = np.concatenate([values, mixed(whole + counts[short].astype(np.uint64) * _BASE[2])])
        order = np.argsort(owners, kind="stable")
        owners, values = owners[order], values[order]
    return owners, values


def runs(keys: np.ndarray) -> np.ndarray:
    """Where a new value begins in keys."""
    if not len(keys):
        return np.zeros(0, dtype=np.int64)
    return np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1])


def distinct_sorted(owners: np.ndarray, values: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Each owner's distinct values in rising order, with the bounds of the n owners. owners never falls."""
    order = np.lexsort((values, owners))
    owners, values = owners[order], values[order]
    if len(values):
        new = np.ones(len(values), dtype=bool)
        new[1:] = (values[1:] != values[:-1]) | (owners[1:] != owners[:-1])
        owners, values = owners[new], values[new]
    return values, np.searchsorted(owners, np.arange(n + 1))
