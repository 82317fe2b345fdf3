"""Stretches of text around anchors, so that equal strings of a given length meet under one key.

Every string of `length` bytes has an anchor that only its own bytes decide: first its lowest hashed run of
GRAM bytes, then that run with as many bytes again on the side where the string has more room. Following
strings with the same anchor make one piece. Equal strings anywhere have equal anchors at the same place
within them, so it is enough to compare pieces whose anchors are equal. `narrow` takes anchors that are
still too common a step further, until the anchor is the string itself.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from newsmart.llm.tokens import _LETTERS, Texts, mixed

GRAM = 32
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _tables(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    if base not in _TABLES or len(_TABLES[base][0]) < n:
        up, down = np.full(n, base, np.uint64), np.full(n, pow(base, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _TABLES[base] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _TABLES[base]


class Sums:
    """Hashes of any span of a buffer, from running sums."""

    def __init__(self, buf: np.ndarray, base: int) -> None:
        up, self.down = _tables(base, len(buf) + 1)
        self.sums = np.empty(len(buf) + 1, dtype=np.uint64)
        self.sums[0] = 0
        np.cumsum(_LETTERS[buf] * up[: len(buf)], out=self.sums[1:])

    def span(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[begin]) * self.down[begin]


@dataclass
class Pieces:
    """Pieces of a buffer: strings begin at first..last; the anchor is [left, right)."""

    first: np.ndarray
    last: np.ndarray
    left: np.ndarray
    right: np.ndarray

    def __len__(self) -> int:
        return len(self.first)

    def take(self, at: np.ndarray) -> Pieces:
        return Pieces(self.first[at], self.last[at], self.left[at], self.right[at])


def _window_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` following values."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def first_pieces(texts: Texts, length: int, sums: Sums) -> Pieces:
    """The pieces of all strings of `length` bytes that lie within one text, by their lowest runs of GRAM bytes."""
    n = len(texts.buf)
    none = np.zeros(0, np.int64)
    if n < length:
        return Pieces(none, none, none, none)
    place = np.arange(n - GRAM + 1, dtype=np.int64)
    bits = np.uint64(max(1, int(n).bit_length()))
    runs = mixed(sums.span(place, place + GRAM))
    runs = (runs >> bits << bits) | place.astype(np.uint64)  # equal runs: the leftmost
    lowest = (_window_least(runs, length - GRAM + 1) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    owner_end = np.repeat(texts.offsets[1:], np.diff(texts.offsets))[: len(lowest)]
    good = np.arange(len(lowest)) + length <= owner_end
    new = np.ones(len(lowest), dtype=bool)
    new[1:] = (lowest[1:] != lowest[:-1]) | ~good[:-1]
    first = np.flatnonzero(new & good)
    stop = np.ones(len(lowest), dtype=bool)
    stop[:-1] = new[1:] | ~good[1:]
    last = np.flatnonzero(stop & good)
    return Pieces(first, last, lowest[first], lowest[first] + GRAM)


def narrow(pieces: Pieces, length: int) -> Pieces:
    """The same strings with anchors half the rest longer: to the right where there is room, else to the left."""
    room = length - (pieces.right - pieces.left)
    more = (room + 1) // 2
    edge = pieces.right + more - length  # strings from here on reach far enough to the right
    here = np.maximum(pieces.first, edge)
    ahead = Pieces(here, pieces.last, pieces.left, pieces.right + more)
    behind = Pieces(pieces.first, np.minimum(pieces.last, edge - 1), pieces.left - more, pieces.right)
    out = [x.take(np.flatnonzero(x.first <= x.last)) for x in (ahead, behind)]
    return Pieces(*(np.concatenate([getattr(x, f) for x in out]) for f in ("first", "last", "left", "right")))


def keys_of(pieces: Pieces, sums: Sums, side: int) -> np.ndarray:
    """A hash of each anchor; `side` tells levels of narrowing apart."""
    size = (pieces.right - pieces.left).astype(np.uint64)
    return mixed(sums.span(pieces.left, pieces.right) ^ mixed(size + np.uint64(side << 20)))


def digests_of(pieces: Pieces, length: int, sums: Sums) -> np.ndarray:
    """A hash of each piece's bytes and the place of its anchor."""
    return mixed(sums.span(pieces.first, pieces.last + length) ^ mixed((pieces.left - pieces.first).astype(np.uint64)))
