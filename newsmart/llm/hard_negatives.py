"""Hard negatives for anchor rows of a table of vectors, by exact scores from table look-ups.

Components become whole numbers. A candidate's components are cut into bit planes (two's complement), and
eight dimensions of a plane make a byte. For an anchor, a table of 256 entries for each group of eight
dimensions holds the sums of all subsets of its components; the byte of a plane picks the sum that the plane
contributes. Adding the groups' sums of a plane, and shifting between planes, gives the full exact inner product.

All candidates are written once as packed planes. Anchors are taken in blocks of at most about ANCHORS rows,
which are broadcast and given up after use; tables are built tile by tile inside the tasks. For each block all
candidates are scored twice: the first pass finds the anchors' positives, which fix the range of scores of
their negatives, the second the best scores in each range. A task keeps the best few of each list, the lists of
all tasks are merged by a window. The driver sees the anchors and positives of one block at a time.

Rows with a null id, label, vector or component, or a component that isn't finite, take no part. A missing
component of a shorter vector counts as 0. "Other rows" are those with another id. Equal anchor rows are one
anchor, different rows with one id are anchors of their own; a list holds an id with the same score once. Ties go
to the smaller id. No anchors, no positives or an empty table give no rows. Columns that aren't named are not
read. Scores that could go beyond a long are an OverflowError, as in ANSI SQL.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsmart.llm.arrow import Stage

#: Component x counts as floor(SCALE * x).
SCALE = 256
#: Positives of an anchor and negatives of a positive.
POSITIVES, NEGATIVES = 5, 3
#: A negative's score is within these percentages of its positive's.
LOW, HIGH = 50, 95
#: Anchors that are broadcast at once, and those whose tables exist at once in a task.
ANCHORS, TILE = 1 << 16, 256
#: Candidates scored at once against a tile, and rows of a task.
ROWS, TASK_ROWS = 512, 1 << 14

_LEAST = np.iinfo(np.int64).min


def integers(column: pa.Array, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of finite components, and their scaled components, floored, as a matrix filled up with zeros."""
    n = len(column)
    lists = column.cast(pa.large_list(pa.float64()))
    bounds = np.frombuffer(lists.buffers()[1], dtype=np.int64)[lists.offset : lists.offset + n + 1] if n else np.zeros(1, np.int64)
    flat = lists.values.to_numpy(zero_copy_only=False)  # null components become NaN
    sizes = np.diff(bounds)
    there = np.asarray(lists.is_valid())
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    good = np.flatnonzero(there & (bad[bounds[1:]] == bad[bounds[:-1]]))
    sizes, starts = sizes[good], bounds[:-1][good]
    dims = int(sizes.max(initial=0))
    out = np.zeros((len(good), dims), dtype=np.int64)
    inside = np.arange(dims) < sizes[:, None]
    if inside.any():
        values = np.floor(scale * flat[(starts[:, None] + np.arange(dims))[inside]])
        if np.abs(values).max() >= 2.0**40:
            raise OverflowError("a component is too large for scores that fit in a long")
        out[inside] = values
    return good, out


def pack(values: np.ndarray, planes: int, groups: int) -> np.ndarray:
    """Bit planes of each row, lowest first, as (rows, planes, groups) bytes; the last plane is the sign."""
    n, dims = values.shape
    full = np.zeros((n, groups * 8), dtype=np.int64)
    full[:, :dims] = values
    out = np.empty((n, planes, groups), dtype=np.uint8)
    for k in range(planes):
        out[:, k] = np.packbits(((full >> k) & 1).astype(np.uint8), axis=1, bitorder="little")
    return out


def unpack(packed: np.ndarray) -> np.ndarray:
    """The numbers that pack was given, filled up with zeros."""
    planes = packed.shape[1]
    out = np.zeros((len(packed), packed.shape[2] * 8), dtype=np.int64)
    for k in range(planes):
        bits = np.unpackbits(packed[:, k], axis=1, bitorder="little").astype(np.int64)
        out += bits * (-(1 << k) if k == planes - 1 else 1 << k)
    return out


def _kind(most: int) -> type:
    return np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.int64


class Tables:
    """Subset sums of a tile of anchors: for each group of eight dimensions 256 rows with a sum for each anchor."""

    def __init__(self, anchors: np.ndarray, top: int) -> None:
        n, dims = anchors.shape
        most = int(np.abs(anchors).max(initial=0))
        self.kind = _kind(dims * most)  # sums over all groups of a plane fit too
        self.wide = _kind(max(2 * dims * most * max(top, 1), 1 << 15))
        self.sums = np.zeros((dims // 8, 256, n), dtype=self.kind)
        for g in range(dims // 8):
            for d in range(8):
                np.add(self.sums[g, : 1 << d], anchors[:, 8 * g + d].astype(self.kind), out=self.sums[g, 1 << d : 2 << d])

    def scores(self, packed: np.ndarray) -> np.ndarray:
        """Inner products of the packed candidates (rows) with the anchors (columns)."""
        n, planes, groups = packed.shape
        width = self.sums.shape[2]
        total = np.zeros((n, width), dtype=self.wide)
        plane, part = np.empty((2, n, width), dtype=self.kind)
        at = np.ascontiguousarray(packed.transpose(1, 2, 0)).astype(np.intp)
        for k in range(planes - 1, -1, -1):
            plane.fill(0)
            for g in range(groups):
                np.take(self.sums[g], at[k, g], axis=0, out=part, mode="clip")
                plane += part
            if k == planes - 1:
                total -= plane
            else:
                total <<= 1
                total += plane
        return total


class Best:
    """For each of n lists the `most` highest scores, ties to smaller ids; a list holds (score, id) once."""

    def __init__(self, n: int, most: int) -> None:
        self.score = np.full((n, most), _LEAST, dtype=np.int64)
        self.id = np.zeros((n, most), dtype=np.int64)
        self.n = np.zeros(n, dtype=np.int64)

    def enough(self) -> np.ndarray:
        """The score that a newcomer must reach."""
        return self.score[:, -1]

    def add(self, who: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(who):
            return
        lists = np.unique(who)
        most = self.score.shape[1]
        old = np.arange(most) < self.n[lists][:, None]
        who = np.concatenate([who, np.repeat(lists, self.n[lists])])
        score = np.concatenate([score, self.score[lists][old]])
        ids = np.concatenate([ids, self.id[lists][old]])
        order = np.lexsort((ids, -score, who))
        who, score, ids = who[order], score[order], ids[order]
        new = np.ones(len(who), dtype=bool)
        new[1:] = (who[1:] != who[:-1]) | (score[1:] != score[:-1]) | (ids[1:] != ids[:-1])
        who, score, ids = who[new], score[new], ids[new]
        begin = np.searchsorted(who, lists)
        place = np.arange(len(who)) - np.repeat(begin, np.diff(np.append(begin, len(who))))
        keep = place < most
        self.score[who[keep], place[keep]] = score[keep]
        self.id[who[keep], place[keep]] = ids[keep]
        self.n[lists] = np.minimum(np.diff(np.append(begin, len(who))), most)

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(list, score, id) of everything kept."""
        there = np.arange(self.score.shape[1]) < self.n[:, None]
        return np.repeat(np.arange(len(self.n)), self.n), self.score[there], self.id[there]


class Anchors:
    """A block of anchors in the order of their labels."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, packed: np.ndarray, top: int) -> None:
        order = np.lexsort((ids, labels))
        self.ids, self.labels, self.packed, self.top = ids[order], labels[order], packed[order], top

    def __len__(self) -> int:
        return len(self.ids)

    def tiles(self) -> Iterator[tuple[slice, Tables]]:
        for a in range(0, len(self), TILE):
            part = slice(a, min(a + TILE, len(self)))
            yield part, Tables(unpack(self.packed[part]), self.top)

    def add_positives(self, best: Best, ids: np.ndarray, labels: np.ndarray, packed: np.ndarray) -> None:
        """Takes candidates, in the order of labels, into the lists of the anchors that have their label."""
        for part, tables in self.tiles():
            own = self.labels[part]
            first, last = np.searchsorted(labels, own[0], "left"), np.searchsorted(labels, own[-1], "right")
            for i in range(first, last, ROWS):
                rows = slice(i, min(i + ROWS, last))
                found = tables.scores(packed[rows])
                r, a = np.nonzero((found >= best.enough()[part]) & (labels[rows, None] == own))
                r, a, score = r + i, a + part.start, found[r, a].astype(np.int64)
                other = ids[r] != self.ids[a]
                best.add(a[other], score[other], ids[r[other]])

    def add_negatives(self, best: Best, low: np.ndarray, high: np.ndarray, ids: np.ndarray, labels: np.ndarray, packed: np.ndarray) -> None:
        """Takes candidates of other labels into the lists of each anchor's score ranges (low, high: anchor by range)."""
        n = low.shape[1]
        for part, tables in self.tiles():
            below = high[part].max(axis=1)
            if (low[part] > high[part]).all():
                continue
            for i in range(0, len(ids), ROWS):
                rows = slice(i, min(i + ROWS, len(ids)))
                found = tables.scores(packed[rows])
                least = np.maximum(low[part], best.enough().reshape(-1, n)[part])
                r, a = np.nonzero((found >= least.min(axis=1)) & (found <= below))
                other = (labels[r + i] != self.labels[a + part.start]) & (ids[r + i] != self.ids[a + part.start])
                r, a = r[other], a[other]
                score = found[r, a].astype(np.int64)
                hit, which = np.nonzero((score[:, None] >= least[a]) & (score[:, None] <= high[part][a]))
                best.add((a[hit] + part.start) * n + which, score[hit], ids[r[hit] + i])


def _planes(column: pa.Array, planes: int, groups: int) -> np.ndarray:
    column = column.cast(pa.large_binary())
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, dtype=np.uint8).reshape(len(column), planes, groups)


def _batches(batches: Iterator[pa.RecordBatch], planes: int, groups: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, labels and planes of each batch in the order of labels."""
    for batch in batches:
        labels = batch.column(1).to_numpy()
        order = np.argsort(labels, kind="stable")
        yield batch.column(0).to_numpy()[order], labels[order], _planes(batch.column(2), planes, groups)[order]


def packed_rows(rows: DataFrame, scale: float) -> tuple[DataFrame, int, int, int]:
    """rows (id, label, anchor, vector) with packed planes in place of vectors; planes, groups and the largest size."""

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = integers(batch.column(0), scale)[1]
            yield pa.RecordBatch.from_pydict({"dims": [values.shape[1]], "top": [int(np.abs(values).max(initial=0))]}, pa.schema([("dims", pa.int64()), ("top", pa.int64())]))

    most = rows.select("vector").mapInArrow(sizes, "dims bigint, top bigint").agg(F.max("dims"), F.max("top")).first()
    groups, top = max(1, math.ceil((most[0] or 0) / 8)), most[1] or 0
    planes = top.bit_length() + 1
    if 8 * groups * (1 << (planes - 1)) ** 2 >= 1 << 62:
        raise OverflowError("scores could go beyond a long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, values = integers(batch.column(3), scale)
            coded = pack(values, planes, groups).reshape(len(good), -1)
            kept = batch.take(pa.array(good))
            yield pa.RecordBatch.from_arrays(
                [kept.column(0), kept.column(1), pa.array([x.tobytes() for x in coded], pa.binary()), kept.column(2)],
                names=["id", "label", "planes", "anchor"],
            )

    return rows.mapInArrow(run, "id bigint, label bigint, planes binary, anchor boolean"), planes, groups, top


_RESULT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def _first(df: DataFrame, key: list[str], most: int) -> DataFrame:
    """The `most` best rows of each key with their rank; equal ones are one."""
    best = Window.partitionBy(*key).orderBy(F.desc("score"), "id")
    return df.distinct().withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= most)


def _mine_block(candidates: DataFrame, anchors: Anchors, planes: int, groups: int, counts: tuple[int, int], low: int, high: int) -> tuple[DataFrame, list]:
    """The negatives of a block's anchors, and the broadcasts to give up when they are stored."""
    context = candidates.sparkSession.sparkContext
    block = context.broadcast(anchors)
    n_pos, n_neg = counts

    def positives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = block.value
        best = Best(len(own), n_pos)
        for ids, labels, packed in _batches(batches, planes, groups):
            own.add_positives(best, ids, labels, packed)
        who, score, ids = best.entries()
        yield pa.RecordBatch.from_arrays([pa.array(who), pa.array(score), pa.array(ids)], names=["anchor", "score", "id"])

    found = _first(candidates.mapInArrow(positives, "anchor bigint, score bigint, id bigint"), ["anchor"], n_pos).toArrow()
    who, place = found["anchor"].to_numpy(), found["rank"].to_numpy() - 1
    score, ids = np.zeros((len(anchors), n_pos), np.int64), np.zeros((len(anchors), n_pos), np.int64)
    there = np.zeros((len(anchors), n_pos), dtype=bool)
    score[who, place], ids[who, place], there[who, place] = found["score"].to_numpy(), found["id"].to_numpy(), True
    # 100 * s >= low * p and 100 * s <= high * p; an empty range where there is no positive
    ranges = context.broadcast((np.where(there, -((-low * score) // 100), 1), np.where(there, (high * score) // 100, 0), score, ids))

    def negatives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = block.value
        least, most, own_score, own_id = ranges.value
        best = Best(least.size, n_neg)
        for ids, labels, packed in _batches(batches, planes, groups):
            own.add_negatives(best, least, most, ids, labels, packed)
        which, score, ids = best.entries()
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (which, own.ids[which // n_pos], own_id.ravel()[which], own_score.ravel()[which], score, ids)],
            names=["list", "anchor_id", "positive_id", "positive_score", "score", "id"],
        )

    schema = "list bigint, anchor_id bigint, positive_id bigint, positive_score bigint, score bigint, id bigint"
    out = _first(candidates.mapInArrow(negatives, schema), ["list"], n_neg)
    return out.select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    ), [block, ranges]


def mine(
    rows: DataFrame,
    anchor: Column,
    vec_id: str = "vec_id",
    label: Column | str = "label",
    vector: str = "embedding",
    scale: float = SCALE,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    block: int = ANCHORS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for the rows where `anchor` holds."""
    spark = rows.sparkSession
    stage = Stage(spark, "negatives")
    label = F.col(label) if isinstance(label, str) else label
    used = rows.select(
        F.col(vec_id).cast("bigint").alias("id"), label.cast("bigint").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"), F.col(vector).alias("vector"),
    ).where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    coded, planes, groups, top = packed_rows(used, scale)
    n = stage.save(coded, "packed").count()
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(n / TASK_ROWS))
    packed = stage.save(spark.read.schema(coded.schema).parquet(stage.path("packed")).repartition(tasks), "spread")
    candidates = packed.select("id", "label", "planes")
    chosen = stage.save(packed.where("anchor").select("id", "label", "planes").distinct(), "anchors")
    blocks = math.ceil(chosen.count() / block)
    for k in range(blocks):
        part = chosen if blocks == 1 else chosen.where(F.pmod(F.xxhash64("id", "label", "planes"), F.lit(blocks)) == k)
        own = part.toArrow().combine_chunks()
        if not own.num_rows:
            continue
        ids, labels = (own[c].to_numpy() for c in ("id", "label"))
        anchors = Anchors(ids, labels, _planes(own["planes"].combine_chunks(), planes, groups), top)
        found, sent = _mine_block(candidates, anchors, planes, groups, (positives, negatives), low, high)
        stage.save(found, f"found/{k}")
        for x in sent:
            x.destroy()
    if not blocks:
        return spark.createDataFrame([], _RESULT)
    return spark.read.schema(_RESULT).parquet(stage.path("found/*"))


def hard_negatives(embeddings: DataFrame) -> DataFrame:
    """Negatives of the rows whose vec_id is divisible by 50; a vec_id divisible by 7 moves its label on by one of ten."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(embeddings, F.col("vec_id") % 50 == 0, label=moved)
