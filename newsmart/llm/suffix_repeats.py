"""Strings of a given number of bytes that start at more than one place of a corpus, and their removal.

The corpus is cut into pieces (see `pieces`): equal strings lie in pieces of one key. Keys, counted over all
documents, leave only pieces whose key is found again. Equal pieces are kept once, with a mark that there are
several. Where a key has unequal pieces, these are compared: their texts are dealt into slots of bounded
size, and within a slot a Burrows-Wheeler transform is searched by threshold-bounded interval expansion.
Starting from the interval of the empty string, breadth first, each interval is extended backward by every
byte that precedes it; an interval whose end has no common-prefix value yet gets the current length there and
is extended further. Values so come in rising order, and the search stops at the wanted length: ends without
a value are neighbours that share at least that much.

A key whose pieces are too large for a slot is narrowed: its strings get longer anchors, hence more keys,
until they fit, at the latest when the anchor is the whole string. So no task or group grows with a passage
that a third of all documents share.

Texts are UTF-8 bytes (null: empty); strings never cross documents. Texts shorter than the length lose
nothing. Documents are rows: repeated rows are copies of one another and lose everything that is long enough.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsmart.llm.arrow import Stage, add_columns
from newsmart.llm.pieces import _BASES, Sums, digests_of, first_pieces, keys_of, narrow
from newsmart.llm.tokens import Texts, chunks

LENGTH = 200
#: Bytes of pieces that a slot has, about, and that a key may have before it is narrowed.
SLOT_BYTES = 1 << 20
KEY_BYTES = 4 << 20
_ARRAYS = ("keys", "marks", "first", "n")


# ---- within a slot


def suffix_order(text: np.ndarray, bits: int, depth: int) -> np.ndarray:
    """Places of text ordered by the `depth` symbols from there on, at least."""
    n = len(text)
    have = 64 // bits
    padded = np.concatenate([text.astype(np.uint64), np.zeros(have, np.uint64)])
    packed = np.zeros(n, dtype=np.uint64)
    for i in range(have):
        packed = (packed << np.uint64(bits)) | padded[i : i + n]
    order = np.argsort(packed, kind="stable")
    ordered = packed[order]
    while True:
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(np.concatenate([[1], (ordered[1:] != ordered[:-1]).astype(np.int64)]))
        if have >= depth or rank[order[-1]] == n:
            return order
        key = rank * np.int64(n + 1)
        key[: n - have] += rank[have:] if have < n else 0
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        have *= 2


class Transform:
    """A Burrows-Wheeler transform as bit vectors, one for each bit of a symbol, with running counts."""

    def __init__(self, text: np.ndarray, order: np.ndarray, bits: int) -> None:
        self.bits = bits
        row = text[order - 1].astype(np.int64)
        size = 1 << bits
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=size))])
        self.ones, self.zeros = [], []
        for b in range(bits - 1, -1, -1):
            bit = (row >> b) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]).astype(np.int32))
            self.zeros.append(len(row) - int(self.ones[-1][-1]))
            row = np.concatenate([row[bit == 0], row[bit == 1]])
        codes = np.arange(size)
        self.leaf = np.zeros(size, dtype=np.int64)
        for k, b in enumerate(range(bits - 1, -1, -1)):
            one = self.ones[k][self.leaf]
            self.leaf = np.where((codes >> b) & 1, self.zeros[k] + one, self.leaf - one)

    def extend(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(symbol, low, high) of each interval, extended by every symbol that precedes one of its places."""
        code = np.zeros(len(low), dtype=np.int64)
        for ones, zeros in zip(self.ones, self.zeros, strict=True):
            a, b = ones[low].astype(np.int64), ones[high].astype(np.int64)
            left, right = (high - b) > (low - a), b > a
            code = np.concatenate([code[left] << 1, (code[right] << 1) | 1])
            low, high = (
                np.concatenate([(low - a)[left], zeros + a[right]]),
                np.concatenate([(high - b)[left], zeros + b[right]]),
            )
        shift = self.starts[code] - self.leaf[code]
        return code, low + shift, high + shift


def common_prefixes(transform: Transform, n: int, length: int) -> np.ndarray:
    """For each place in the order the prefix it shares with the one before: -1 where that has `length` or more.

    Strings with the separating symbol 0 aren't followed, so that a value is right between strings without it.
    """
    value = np.full(n + 1, -1, dtype=np.int32)
    value[0] = value[n] = 0
    low, high = np.array([0]), np.array([n])
    for reached in range(length):
        if not len(low):
            break
        code, low, high = transform.extend(low, high)
        fresh = value[high] < 0
        value[high[fresh]] = reached
        go = fresh & (code > 0)
        low, high = low[go], high[go]
    return value[:n]


def repeated_starts(bodies: list[bytes], several: np.ndarray, length: int) -> list[tuple[int, int, int]]:
    """(piece, from, to): where strings begin that begin elsewhere too, in these pieces or, as `several` says, in equal ones."""
    sizes = np.array([len(b) for b in bodies], dtype=np.int64)
    ends = np.cumsum(sizes + 1)
    raw = np.zeros(int(ends[-1]), dtype=np.uint8)
    inside = np.ones(len(raw), dtype=bool)
    inside[ends - 1] = False
    raw[inside] = np.frombuffer(b"".join(bodies), dtype=np.uint8)
    used = np.flatnonzero(np.bincount(raw[inside], minlength=256))
    dense = np.zeros(256, dtype=np.uint16)
    dense[used] = np.arange(1, len(used) + 1)
    text = np.where(inside, dense[raw], 0).astype(np.uint16)
    bits = max(1, int(len(used)).bit_length())
    order = suffix_order(text, bits, length)
    value = common_prefixes(Transform(text, order, bits), len(text), length)
    owner = np.repeat(np.arange(len(bodies)), sizes + 1)
    whole = np.arange(len(text)) + length <= (ends - 1)[owner]
    group = np.cumsum(value >= 0)
    rows = np.flatnonzero(whole[order])
    many = np.bincount(group[rows], minlength=int(group[-1]) + 1) > 1
    place = order[rows]
    place = np.sort(place[many[group[rows]] | several[owner[place]]])
    if not len(place):
        return []
    cut = np.flatnonzero((np.diff(place) > 1) | (np.diff(owner[place]) > 0)) + 1
    begin, stop = place[np.concatenate([[0], cut])], place[np.concatenate([cut - 1, [len(place) - 1]])] + 1
    base = (ends - sizes - 1)[owner[begin]]
    return list(zip(owner[begin].tolist(), (begin - base).tolist(), (stop - base).tolist(), strict=True))


# ---- over the corpus


def with_pieces(docs: DataFrame, length: int) -> DataFrame:
    """Rows (uid, text, ...) with the pieces of each text: keys, marks (digests of whole pieces), first starts, numbers of starts."""

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        parts: list[list[pa.Array]] = [[], [], [], []]
        for texts in chunks(batch.column(batch.schema.get_field_index("text"))):
            sums = Sums(texts.buf, _BASES[0])
            found = narrow(first_pieces(texts, length, sums), length)
            owner = np.searchsorted(texts.offsets, found.first, side="right") - 1
            at = np.lexsort((found.first, owner))
            found, owner = found.take(at), owner[at]
            marks = digests_of(found, length, Sums(texts.buf, _BASES[1]))
            bounds = pa.array(np.searchsorted(owner, np.arange(len(texts) + 1)).astype(np.int32))
            begin = texts.offsets[owner] if len(owner) else owner
            for part, values in zip(
                parts,
                (keys_of(found, sums, 1).view(np.int64), marks.view(np.int64), (found.first - begin).astype(np.int32), (found.last - found.first + 1).astype(np.int32)),
                strict=True,
            ):
                part.append(pa.ListArray.from_arrays(bounds, pa.array(values)))
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        return [pa.concat_arrays(p) if p else pa.array([], pa.list_(k)) for p, k in zip(parts, kinds, strict=True)]

    long, short = T.ArrayType(T.LongType()), T.ArrayType(T.IntegerType())
    return add_columns(docs, "text", [T.StructField(c, t) for c, t in zip(_ARRAYS, (long, long, short, short), strict=True)], compute)


def _narrowed(work: DataFrame, length: int, level: int) -> DataFrame:
    """Pieces (key, mark, several, body) of level - 1 cut by longer anchors: (key, mark, off, key2, mark2, several, body2)."""

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        off, keys, marks, bodies = [], [], [], []
        for body in batch.column(batch.schema.get_field_index("body")).to_pylist():
            buf = np.frombuffer(body, dtype=np.uint8)
            sums, other = Sums(buf, _BASES[0]), Sums(buf, _BASES[1])
            found = first_pieces(Texts(buf, np.array([0, len(buf)]), 0), length, sums)
            for _ in range(level):
                found = narrow(found, length)
            off.append(found.first.tolist())
            keys.append(keys_of(found, sums, level).view(np.int64).tolist())
            marks.append(digests_of(found, length, other).view(np.int64).tolist())
            bodies.append([body[a : b + length] for a, b in zip(found.first.tolist(), found.last.tolist(), strict=True)])
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return [pa.array(x, pa.list_(k)) for x, k in zip((off, keys, marks, bodies), kinds, strict=True)]

    kinds = (T.LongType(), T.LongType(), T.LongType(), T.BinaryType())
    fields = [T.StructField(c, T.ArrayType(k)) for c, k in zip(("offs", "keys2", "marks2", "bodies2"), kinds, strict=True)]
    rows = add_columns(work, "body", fields, compute).drop("body")
    rows = rows.select("key", "mark", "several", F.explode(F.arrays_zip("offs", "keys2", "marks2", "bodies2")).alias("p"))
    return rows.select("key", "mark", "several", F.col("p.offs").alias("off"), F.col("p.keys2").alias("key2"), F.col("p.marks2").alias("mark2"), F.col("p.bodies2").alias("body2"))


def _search(work: DataFrame, slots: int, length: int) -> DataFrame:
    """(key, mark, start, stop) of the repeated starts within pieces (key, mark, several, body), slot by slot."""

    def run(table: pa.Table) -> pa.Table:
        bodies = table.column("body").to_pylist()
        found = repeated_starts(bodies, table.column("several").to_numpy(), length)
        at = pa.array([p for p, _, _ in found], pa.int64())
        return pa.table(
            {
                "key": table.column("key").take(at), "mark": table.column("mark").take(at),
                "start": pa.array([a for _, a, _ in found], pa.int64()), "stop": pa.array([b for _, _, b in found], pa.int64()),
            }
        )

    rows = work.withColumn("slot", F.pmod(F.xxhash64("key"), F.lit(slots)))
    return rows.groupBy("slot").applyInArrow(run, "key bigint, mark bigint, start bigint, stop bigint")


def repeats_in_pieces(work: DataFrame, stage: Stage, length: int, key_bytes: int = KEY_BYTES, level: int = 1) -> DataFrame:
    """(key, mark, start, stop) for distinct pieces (key, mark, several, body), stored tables."""
    size = work.groupBy("key").agg(F.sum(F.octet_length("body") + 1).alias("bytes"))
    total = size.agg(F.sum("bytes")).first()[0] or 0
    large = stage.save(size.where(F.col("bytes") > key_bytes).select("key"), f"large-{level}")
    slots = max(1, int(total // SLOT_BYTES) + 1)
    if large.isEmpty():
        return stage.save(_search(work, slots, length), f"found-{level}")
    found = stage.save(_search(work.join(large, "key", "left_anti"), slots, length), f"found-{level}")
    cut = stage.save(_narrowed(work.join(large, "key", "left_semi"), length, level + 1), f"cut-{level}")
    again = cut.groupBy("key2").agg(F.count(F.lit(1)).alias("rows"), F.max("several").alias("any")).where("rows > 1 OR any").select("key2")
    again = stage.save(cut.join(again, "key2", "left_semi"), f"again-{level}")
    below = again.groupBy("key2", "mark2").agg((F.max("several") | (F.count(F.lit(1)) > 1)).alias("several"), F.first("body2").alias("body"))
    below = stage.save(below.withColumnsRenamed({"key2": "key", "mark2": "mark"}), f"below-{level}")
    deep = repeats_in_pieces(below, stage, length, key_bytes, level + 1)
    deep = deep.select(F.col("key").alias("key2"), F.col("mark").alias("mark2"), "start", "stop")
    back = again.drop("body2").join(deep, ["key2", "mark2"])
    return found.unionByName(back.select("key", "mark", (F.col("start") + F.col("off")).alias("start"), (F.col("stop") + F.col("off")).alias("stop")))


def repeated_spans(docs: DataFrame, stage: Stage, length: int = LENGTH, key_bytes: int = KEY_BYTES) -> tuple[DataFrame, DataFrame]:
    """The stored documents (a row id `uid` beside their columns, which have `text`), and (uid, spans): byte spans to remove."""
    staged = stage.save(with_pieces(docs.withColumn("uid", F.monotonically_increasing_id()), length), "docs")
    rows = staged.select("uid", F.explode(F.arrays_zip(*_ARRAYS)).alias("p"))
    rows = rows.select("uid", F.col("p.keys").alias("key"), F.col("p.marks").alias("mark"), F.col("p.first").alias("first"), F.col("p.n").alias("n"))
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("rows"), F.min("mark").alias("a"), F.max("mark").alias("b")).where("rows > 1")
    shared = stage.save(shared.select("key", (F.col("a") != F.col("b")).alias("varied")), "shared")
    again = stage.save(rows.join(shared, "key"), "again")
    # unequal pieces of a key, each once, with one place of it
    each = again.where("varied").groupBy("key", "mark").agg((F.count(F.lit(1)) > 1).alias("several"), F.min(F.struct("uid", "first", "n")).alias("at"))
    wanted = each.groupBy("at.uid").agg(F.collect_list(F.struct("key", "mark", "several", F.col("at.first").alias("first"), F.col("at.n").alias("n"))).alias("w"))
    texts = staged.select("uid", F.col("text").cast("binary").alias("raw")).join(wanted, "uid").select("raw", F.explode("w").alias("w"))
    work = texts.select("w.key", "w.mark", "w.several", F.substring("raw", F.col("w.first") + 1, F.col("w.n") + (length - 1)).alias("body"))
    found = repeats_in_pieces(stage.save(work, "work"), stage, length, key_bytes)
    starts = again.where("varied").join(found, ["key", "mark"]).select("uid", (F.col("first") + F.col("start")).alias("a"), (F.col("first") + F.col("stop") - 1 + length).alias("b"))
    equal = again.where("NOT varied").select("uid", F.col("first").cast("bigint").alias("a"), (F.col("first") + F.col("n") - 1 + length).cast("bigint").alias("b"))
    spans = starts.unionByName(equal).groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("spans"))
    return staged.drop(*_ARRAYS), stage.save(spans, "spans")


def _merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for span in spans or []:
        a, b = span["a"], span["b"]
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def without_spans(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The bytes outside the spans."""
    kept, at = [], 0
    for a, b in spans:
        kept.append(raw[at:a])
        at = b
    return b"".join([*kept, raw[at:]])


def remove_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH, key_bytes: int = KEY_BYTES) -> DataFrame:
    """The other columns of docs with n_bytes, n_removed, n_spans and kept (the bytes that stay)."""
    stage = Stage(docs.sparkSession, "repeats")
    others = [c for c in docs.columns if c != text]
    plain = docs.select(F.struct(*others).alias("row"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    staged, spans = repeated_spans(plain, stage, length, key_bytes)
    joined = staged.join(spans, "uid", "left")

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        size, gone, number, kept = [], [], [], []
        texts, lists = (batch.column(batch.schema.get_field_index(c)) for c in ("text", "spans"))
        for value, own in zip(texts, lists, strict=True):
            raw, merged = value.as_py().encode(), _merged(own.as_py())
            size.append(len(raw))
            gone.append(sum(b - a for a, b in merged))
            number.append(len(merged))
            kept.append(without_spans(raw, merged))
        return [pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array(number, pa.int64()), pa.array(kept, pa.binary())]

    fields = [T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")] + [T.StructField("kept", T.BinaryType())]
    found = add_columns(joined, "text", fields, compute).drop("uid", "text", "spans")
    return found.select("row.*", "n_bytes", "n_removed", "n_spans", "kept")


def repeat_digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: n_bytes, n_removed, n_spans, kept_sha256."""
    out = remove_repeats(docs.select(doc_id, text), text)
    return out.select(doc_id, "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
