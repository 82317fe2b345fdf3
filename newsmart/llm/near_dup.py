"""Near-duplicate documents by bottom-k sketches of one hash function.

A document's set is its distinct word shingles, hashed. Its sketch are the lowest values of the set.

1. Documents with equal sets are one class, known by a 128-bit digest; the rest works on class
   representatives (the smallest id of each).
2. Inverted lists of the LISTED lowest values give candidates. As two sets above the threshold share most
   of these values, each set goes only into the lists of its PREFIX rarest ones: to miss a link, PREFIX or
   more of the union's LISTED lowest values would have to lie outside the intersection (16 of 24, where
   each does with a chance of 0.15 at a similarity of 0.85: below 1e-7; at 0.8 below 1e-6). Sets of LISTED
   shingles or fewer are listed by exact prefix filtering. Values that are common to many documents are
   so left to documents that have nothing rarer.
3. Lists that lead to the same smallest id are one group, so that a group of near copies is compared once,
   and not for every value they share. Large groups are cut into blocks of bounded size and the pairs of
   blocks dealt out, so that no task holds a whole group.
4. In a pair of blocks, inverted lists of the sketches' SKETCH values give overlaps. Of pairs that overlap
   enough, the sketch of the union, the SKETCH lowest values of both sketches together, estimates the
   similarity: the part of it that both hold. Pairs below LEAST_ESTIMATE drop out, the others are confirmed
   on full sets. A link at a similarity of 0.85 is estimated that low with a chance below 1e-11, one at 0.8
   below 2e-8. Of the links only a spanning forest is returned, so that a group of n near copies gives fewer
   than n rows for a pair of blocks.
5. Connected components of these edges, joined back to the classes' members.

Documents without words or text have an empty set and are linked with nothing. Rows with the same id are
one node: what either of them is linked with belongs together. Rows without id belong to the class of
their set, and to no id where the whole class has none; these stand for themselves.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsmart.llm.arrow import Stage, add_columns, unused
from newsmart.llm.components import components
from newsmart.llm.tokens import FOLDED, Texts, chunks, distinct_sorted, hash_words, mixed, shingles, split_words

#: Words of a shingle, and the least similarity as a whole percentage.
WORDS = 5
PERCENT = 80
#: Lowest values with inverted lists, and how many of them, the rarest, a document is listed under.
LISTED = 24
PREFIX = 16
#: Values of the sketches that estimate similarity; pairs with a lower estimate drop out.
SKETCH = 64
LEAST_ESTIMATE = 0.5
#: Pairs whose unions are estimated at a time.
PAIRS = 8192
#: Representatives and shingles in a block, about.
BLOCK_DOCS = 512
BLOCK_SHINGLES = 1_000_000


def sets_of(texts: Texts, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct shingle hashes in rising order, with the texts' bounds."""
    found = split_words(texts)
    return distinct_sorted(*shingles(found, hash_words(found, FOLDED), words), len(texts))


def _digests(values: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit sums over each set."""
    out = []
    for salt in (0x1234567, 0x7654321):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mixed(values ^ np.uint64(salt)))])
        out.append((sums[bounds[1:]] - sums[bounds[:-1]]).view(np.int64))
    return out


def _lists(values: np.ndarray, bounds: np.ndarray, most: int | None = None) -> pa.Array:
    """Each set's values, or its `most` lowest, as a list column."""
    if most is not None:
        size = np.minimum(np.diff(bounds), most)
        ends = np.concatenate([[0], np.cumsum(size)])
        values = values[np.repeat(bounds[:-1] - ends[:-1], size) + np.arange(ends[-1])]
        bounds = ends
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.view(np.int64)))


def sketches(docs: DataFrame, doc_id: str, text: str, words: int) -> DataFrame:
    """(id, n_shingles, d1, d2, low): size and digest of each document's set, and its LISTED lowest values."""

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        n, d1, d2, low = [], [], [], []
        for texts in chunks(batch.column(batch.schema.get_field_index("text"))):
            values, bounds = sets_of(texts, words)
            one, two = _digests(values, bounds)
            n.append(np.diff(bounds))
            d1.append(one)
            d2.append(two)
            low.append(_lists(values, bounds, LISTED))
        join = lambda parts: pa.array(np.concatenate(parts) if parts else [], pa.int64())
        return [join(n), join(d1), join(d2), pa.concat_arrays(low) if low else pa.array([], pa.list_(pa.int64()))]

    fields = [T.StructField(c, T.LongType()) for c in ("n_shingles", "d1", "d2")] + [T.StructField("low", T.ArrayType(T.LongType()))]
    rows = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).cast("string").alias("text"))
    return add_columns(rows, "text", fields, compute).drop("text")


def _full_sets(docs: DataFrame, words: int) -> DataFrame:
    """(id, shingles) of rows (id, text)."""

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        parts = [_lists(*sets_of(t, words)) for t in chunks(batch.column(batch.schema.get_field_index("text")))]
        return [pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int64()))]

    return add_columns(docs, "text", [T.StructField("shingles", T.ArrayType(T.LongType()))], compute).drop("text")


def candidate_groups(reps: DataFrame, stage: Stage) -> DataFrame:
    """(center, id, n_shingles): groups of two or more representatives (id, n_shingles, low) with shared rare values."""
    rows = reps.select("id", "n_shingles", F.size("low").alias("k"), F.explode("low").alias("v"))
    shared = rows.groupBy("v").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # only shared values come back; the others are the rarest of their document and take their places first
    mine = rows.join(shared, "v").groupBy("id").agg(
        F.first("n_shingles").alias("n_shingles"), F.first("k").alias("k"), F.sort_array(F.collect_list(F.struct("n", "v"))).alias("vs")
    )
    places = F.greatest(F.lit(0), F.lit(PREFIX) - (F.col("k") - F.size("vs")))
    places = F.when(F.col("k") < PREFIX, F.size("vs")).otherwise(F.least(places, F.size("vs")))
    listed = stage.save(mine.select("id", "n_shingles", F.explode(F.slice("vs", F.lit(1), places.cast("int"))).alias("x")).select("id", "n_shingles", "x.v"), "listed")
    centers = listed.groupBy("v").agg(F.min("id").alias("center"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    groups = listed.join(centers, "v").select("center", "id", "n_shingles").distinct()
    return groups


def _blocks(groups: DataFrame) -> DataFrame:
    """(slot, center, i, j, own, id): each group's members in the pairs of blocks (i, j) that they belong to."""
    size = groups.groupBy("center").agg(F.count(F.lit(1)).alias("docs"), F.sum("n_shingles").alias("shingles")).where("docs > 1")
    blocks = F.greatest(F.ceil(F.col("docs") / BLOCK_DOCS), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    total = size.agg(F.sum("shingles")).first()[0] or 0
    slots = max(1, int(total // (BLOCK_SHINGLES // 2)) + 1)
    size = size.select("center", blocks.alias("blocks"))
    rows = groups.join(size, "center").withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    i, j = F.least("own", "other"), F.greatest("own", "other")
    # small groups share a slot; a pair of blocks of a large one has a slot of its own
    slot = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("center"), F.lit(slots))).otherwise(F.xxhash64("center", i, j))
    return rows.select(slot.alias("slot"), "center", i.alias("i"), j.alias("j"), "own", "id")


def _overlaps(owners: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Numbers of shared values of all pairs of n sets; owners and values list the sets' members."""
    order = np.argsort(values, kind="stable")
    owners, values = owners[order], values[order]
    begin = np.ones(len(values), dtype=bool)
    begin[1:] = values[1:] != values[:-1]
    number = np.cumsum(begin) - 1
    often = np.bincount(number) > 1 if len(number) else np.zeros(0, bool)
    keep = often[number]
    owners, number = owners[keep], (np.cumsum(often) - 1)[number[keep]]
    out = np.zeros((n, n), dtype=np.float32)
    width = int(often.sum())
    step = max(256, min(8192, (1 << 22) // max(n, 1)))
    for a in range(0, width, step):
        lo, hi = np.searchsorted(number, [a, a + step])
        member = np.zeros((n, min(step, width - a)), dtype=np.float32)
        member[owners[lo:hi], number[lo:hi] - a] = 1
        out += member @ member.T
    return out


def union_estimates(low: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The estimated similarities of the sets a[i] and b[i]: the part of their union's SKETCH lowest values that both hold.

    low has a row for each set: its SKETCH lowest values in rising order, of which the first size[i] count."""
    out = np.zeros(len(a))
    number = np.arange(2 * SKETCH)
    for at in range(0, len(a), PAIRS):
        one, two = a[at : at + PAIRS], b[at : at + PAIRS]
        # places without a value hold the highest number, and come last
        values = np.sort(np.concatenate([low[one], low[two]], axis=1), axis=1)
        held = number < (np.minimum(size[one], SKETCH) + np.minimum(size[two], SKETCH))[:, None]
        again = np.zeros(values.shape, dtype=bool)
        again[:, 1:] = values[:, 1:] == values[:, :-1]
        again &= held
        held &= np.cumsum(held & ~again, axis=1, dtype=np.uint8) <= SKETCH
        out[at : at + PAIRS] = (again & held).sum(axis=1) / np.maximum((held & ~again).sum(axis=1), 1)
    return out


def _forest(links: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the graph whose adjacency matrix is given."""
    left, edges = np.ones(len(links), dtype=bool), []
    for root in range(len(links)):
        if not left[root]:
            continue
        left[root] = False
        border = [root]
        while border:
            node = border.pop()
            found = np.flatnonzero(links[node] & left)
            left[found] = False
            edges += [(node, int(x)) for x in found]
            border += found.tolist()
    return edges


def links_within(sets: list[np.ndarray], own: np.ndarray, percent: int, crossing: bool) -> list[tuple[int, int]]:
    """A spanning forest of the pairs of sets at the threshold or above; with `crossing` only pairs of different blocks count."""
    n = len(sets)
    size = np.array([len(s) for s in sets])
    owners = np.repeat(np.arange(n), size)
    values = np.concatenate(sets).astype(np.uint64, copy=False) if n else np.zeros(0, np.uint64)
    place = np.arange(len(values)) - np.repeat(np.cumsum(size) - size, size)
    low = place < SKETCH
    shared = _overlaps(owners[low], values[low], n)
    full = np.minimum(np.minimum(size[:, None], size[None, :]), SKETCH)
    # both hold no more of the union's sketch than the sketches share, and it is no shorter than `full`
    maybe = (shared >= LEAST_ESTIMATE * full) & (100 * np.minimum(size[:, None], size[None, :]) >= percent * np.maximum(size[:, None], size[None, :]))
    np.fill_diagonal(maybe, False)
    if crossing:
        maybe &= own[:, None] != own[None, :]
    sketch = np.full((n, SKETCH), np.iinfo(np.uint64).max, dtype=np.uint64)
    sketch[owners[low], place[low]] = values[low]
    a, b = np.nonzero(np.triu(maybe))
    likely = union_estimates(sketch, size, a, b) >= LEAST_ESTIMATE
    maybe = np.zeros((n, n), dtype=bool)
    maybe[a[likely], b[likely]] = maybe[b[likely], a[likely]] = True
    active = np.flatnonzero(maybe.any(axis=1))
    if not len(active):
        return []
    at = np.full(n, -1)
    at[active] = np.arange(len(active))
    mine = at[owners] >= 0
    common = _overlaps(at[owners[mine]], values[mine], len(active)).astype(np.int64)
    union = size[active][:, None] + size[active][None, :] - common
    links = maybe[np.ix_(active, active)] & (100 * common >= percent * union)
    return [(int(active[a]), int(active[b])) for a, b in _forest(links)]


def _edges(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b): links found within each slot of rows (slot, center, i, j, own, id, shingles)."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        key = [table.column(c).to_numpy() for c in ("center", "i", "j")]
        ids, own = table.column("id").to_numpy(), table.column("own").to_numpy()
        column = table.column("shingles")
        column = column.chunk(0) if column.num_chunks else pa.array([], pa.list_(pa.int64()))
        bounds, values = column.offsets.to_numpy(), column.values.to_numpy().view(np.uint64)
        order = np.lexsort((ids, key[2], key[1], key[0]))
        new = np.ones(len(order), dtype=bool)
        for k in key:
            new[1:] &= k[order][1:] == k[order][:-1]
        begin = np.flatnonzero(~new | (np.arange(len(order)) == 0))
        a, b = [], []
        for lo, hi in zip(begin, [*begin[1:], len(order)], strict=True):
            rows = order[lo:hi]
            found = links_within(
                [values[bounds[r] : bounds[r + 1]] for r in rows], own[rows], percent, key[1][rows[0]] != key[2][rows[0]]
            )
            a += [int(ids[rows[x]]) for x, _ in found]
            b += [int(ids[rows[y]]) for _, y in found]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return rows.groupBy("slot").applyInArrow(run, "a bigint, b bigint")


def linked_documents(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """(id, n_shingles, component_id, kept), a row for each row of docs. Ids are integers."""
    stage = Stage(docs.sparkSession, "near")
    all_sets = stage.save(sketches(docs, doc_id, text, words), "sketches")
    digest = ["n_shingles", "d1", "d2"]
    classes = all_sets.where("n_shingles > 0").groupBy(*digest).agg(F.min("id").alias("rep"), F.first("low").alias("low"))
    classes = stage.save(classes, "classes")
    reps = classes.where("rep IS NOT NULL").select(F.col("rep").alias("id"), "n_shingles", "d1", "d2", "low")
    groups = stage.save(candidate_groups(reps, stage), "groups")
    pairs = stage.save(_blocks(groups), "blocks")
    wanted = pairs.select("id").distinct()
    texts = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).cast("string").alias("text"))
    sets = stage.save(_full_sets(texts.join(wanted.hint("merge"), "id", "left_semi"), words).where(F.size("shingles") > 0), "sets")
    edges = stage.save(_edges(pairs.join(sets, "id"), percent), "links")
    members = all_sets.drop("low").join(classes.select(*digest, "rep"), digest, "left")
    # an id that is given to several rows joins the classes of all of them
    twice = members.where("id IS NOT NULL AND rep IS NOT NULL AND id <> rep").groupBy("id").agg(F.min("rep").alias("x"), F.max("rep").alias("y"))
    own = members.where("id IS NOT NULL AND id = rep").select("id").distinct()
    more = twice.where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b"))
    more = more.unionByName(twice.join(own, "id", "left_semi").select(F.col("x").alias("a"), F.col("id").alias("b")))
    roots = components(edges.unionByName(more), stage)
    out = members.join(roots, F.col("rep") == F.col("node"), "left")
    root = F.coalesce("root", "rep", "id")
    return out.select("id", "n_shingles", root.alias("component_id"), root.eqNullSafe(F.col("id")).alias("kept"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3, percent: int = 85) -> DataFrame:
    """One row a document: n_shingles, component_id, kept."""
    out = linked_documents(docs, doc_id, text, words, percent)
    return out.select(F.col("id").cast(docs.schema[doc_id].dataType).alias(doc_id), "n_shingles", "component_id", "kept")


def one_of_each_group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The documents without near copies of documents with smaller ids, with the columns they had. Rows without id stay."""
    (name,) = unused(docs, "gone")
    gone = linked_documents(docs, doc_id, text, words, percent).where("id IS NOT NULL AND NOT kept")
    gone = gone.select(F.col("id").alias(name)).distinct()
    return docs.join(gone, F.col(doc_id).cast("bigint") == F.col(name), "left_anti")
