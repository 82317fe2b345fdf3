"""Byte-level BPE encoding and decoding with a public vocabulary.

A text is cut into pieces by the vocabulary's pattern. Within a piece, a segment tree over the ranks of
neighbouring pairs has the lowest rank, and the leftmost of equals, at its root. Each merge updates the
ranks beside it in logarithmic time; it ends when no pair has a rank. Pieces met before are looked up in
tables of bounded size that live as long as the Python worker.

The vocabulary file is read on the driver and broadcast; its size is bounded by MOST_VOCABULARY_BYTES.
Null is the empty text. Texts are encoded row by row and whole.
"""

from __future__ import annotations

import hashlib
import json
import os
import struct
import sys
import types

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsmart.llm.arrow import add_columns

MOST_VOCABULARY_BYTES = 64 << 20
#: Pieces kept in a worker's younger table; when it is full it becomes the older one, which is given up.
MOST_PIECES = 150_000
_NONE = 1 << 62

#: Fixed value: the cutting pattern of the published byte-level vocabulary.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a vocabulary file, to the byte: printable bytes are themselves."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {chr(b): b for b in shown}
    rest = [b for b in range(256) if b not in set(shown)]
    return out | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens' bytes by id, ids by bytes, the rank and result of each mergeable pair, and special tokens."""

    def __init__(self, source: str) -> None:
        file = json.loads(source)
        letters = byte_letters()
        model = file["model"]
        as_bytes = lambda token: bytes(letters[c] for c in token)
        self.special = {a["content"]: a["id"] for a in file.get("added_tokens", [])}
        self.ids = {as_bytes(t): i for t, i in model["vocab"].items() if t not in self.special}
        self.tokens = {i: b for b, i in self.ids.items()} | {i: s.encode() for s, i in self.special.items()}
        n = max(self.tokens) + 1
        self.by_id = [self.tokens.get(i, b"") for i in range(n)]
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = (as_bytes(x) for x in (pair.split(" ") if isinstance(pair, str) else pair))
            self.pairs.setdefault((self.ids[left], self.ids[right]), (rank, self.ids[left + right]))
        self.singles = [self.ids[bytes([b])] for b in range(256)]
        names = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one piece."""
        ids = [self.singles[b] for b in piece]
        n = len(ids)
        pairs = self.pairs
        if n < 3:
            hit = pairs.get((ids[0], ids[1])) if n == 2 else None
            return [hit[1]] if hit else ids
        width = 1 << (n - 2).bit_length()  # leaves: the pair that begins at each place
        # a node holds rank * width + place, so that the least is the leftmost of the lowest rank
        tree = [_NONE] * (2 * width)
        for i in range(n - 1):
            if hit := pairs.get((ids[i], ids[i + 1])):
                tree[width + i] = hit[0] * width + i
        for k in range(width - 1, 0, -1):
            a, b = tree[2 * k], tree[2 * k + 1]
            tree[k] = a if a < b else b
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))

        def put(place: int, value: int) -> None:
            k = width + place
            if tree[k] == value:
                return
            tree[k] = value
            k >>= 1
            while k:
                a, b = tree[2 * k], tree[2 * k + 1]
                low = a if a < b else b
                if tree[k] == low:
                    return
                tree[k] = low
                k >>= 1

        while tree[1] != _NONE:
            i = tree[1] % width
            j = after[i]
            ids[i] = pairs[ids[i], ids[j]][1]
            ids[j] = -1
            k = after[i] = after[j]
            if j < n - 1:
                put(j, _NONE)
            if k < n:
                before[k] = i
                hit = pairs.get((ids[i], ids[k]))
                put(i, hit[0] * width + i if hit else _NONE)
            else:
                put(i, _NONE)
            h = before[i]
            if h >= 0:
                hit = pairs.get((ids[h], ids[i]))
                put(h, hit[0] * width + h if hit else _NONE)
        return [x for x in ids if x >= 0]


class Coder:
    """Encodes and decodes with a vocabulary.

    The tables map a piece to its ids as little-endian 32-bit integers. Pieces found in the older table
    go on into the younger one, so that common pieces stay when rare ones are given up.
    """

    def __init__(self, source: str) -> None:
        self.vocabulary = Vocabulary(source)
        self.pieces = regex.compile(PIECES)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _missing(self, piece: str) -> bytes:
        out = self.young.get(piece) or self.old.get(piece)
        if out is None:
            ids = self.vocabulary.merge(piece.encode())
            out = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= 64:
            if len(self.young) >= MOST_PIECES:
                self.old, self.young = self.young, {}
            self.young[piece] = out
        return out

    def _ordinary(self, text: str) -> bytes:
        get, missing = self.young.get, self._missing
        return b"".join([get(p) or missing(p) for p in self.pieces.findall(text)])

    def encode(self, text: str) -> bytes:
        """The text's ids; special tokens' strings become their ids."""
        cut = self.vocabulary.cut
        if cut is None or not any(s in text for s in self.vocabulary.special):
            return self._ordinary(text)
        special = self.vocabulary.special
        return b"".join(
            special[part].to_bytes(4, "little") if part in special else self._ordinary(part) for part in cut.split(text) if part
        )

    def decode(self, packed: bytes) -> bytes:
        """The bytes of the decoded text in UTF-8; bytes that form no character become U+FFFD."""
        by_id = self.vocabulary.by_id
        raw = b"".join([by_id[i] for i in np.frombuffer(packed, dtype="<u4").tolist()])
        try:
            raw.decode()
            return raw
        except UnicodeDecodeError:
            return raw.decode("utf-8", "replace").encode()


def coder_of(source: str) -> Coder:
    """The worker's coder for a vocabulary, kept from task to task."""
    kept = sys.modules.setdefault("_kept_coders", types.ModuleType("_kept_coders"))
    key = hashlib.sha256(source.encode()).hexdigest()
    if getattr(kept, "key", None) != key:
        kept.key, kept.coder = key, Coder(source)
    return kept.coder


def read_vocabulary(path: str) -> str:
    if os.path.getsize(path) > MOST_VOCABULARY_BYTES:
        raise ValueError(f"a vocabulary file may have {MOST_VOCABULARY_BYTES} bytes at most")
    with open(path, encoding="utf-8") as file:
        return file.read()


def with_tokens(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """docs with ids (packed 32-bit integers) and decoded (text after encoding and decoding)."""
    source = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        coder = coder_of(source.value)
        ids = [coder.encode(t or "") for t in _texts(batch, text)]
        return [pa.array(ids, pa.binary()), pa.array([coder.decode(x).decode() for x in ids], pa.string())]

    fields = [T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())]
    return add_columns(docs, text, fields, compute)


def _texts(batch: pa.RecordBatch, text: str):
    for value in batch.column(batch.schema.get_field_index(text)):
        yield value.as_py()


def token_digests(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: n_tokens, ids_sha256, decoded_sha256."""
    source = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        coder = coder_of(source.value)
        n, ids, decoded = [], [], []
        for value in _texts(batch, "text"):
            packed = coder.encode(value or "")
            n.append(len(packed) // 4)
            ids.append(hashlib.sha256(packed).hexdigest())
            decoded.append(hashlib.sha256(coder.decode(packed)).hexdigest())
        return [pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())]

    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    return add_columns(docs.select(F.col(doc_id), F.col(text).cast("string").alias("text")), "text", fields, compute).drop("text")
