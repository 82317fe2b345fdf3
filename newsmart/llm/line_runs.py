"""Repeated lines dropped with levelled sorted runs of line hashes.

A line's key is the line without blanks at its ends, ASCII letters lower-cased. Documents come in batches
of falling ids. A batch's keys are summed up to one row each and merge-anti-joined with the runs of the
batches before it: a key that no run holds is new, and the largest id that has it in this batch is the
largest of all, its keeper. The batch then adds its own run: (key hash, documents, keeper or null). Runs
are tables bucketed and sorted by the hash. When a level has FAN_IN runs they are merged into one run of
the next level, counts added up. At the end the runs say how often each key occurs and who keeps it.

Keys are told apart by 128 bits of hash. Only columns of hashes, ids and line numbers are written or joined by key;
the texts meet the numbers of the lines they lose by document id and a hash of the text, as an id may come again with
another text. All steps take time in proportion to a document's lines.

Each row is a document of its own for counting. Rows with the same id share the keeper's right to its
lines. A row without id counts, and comes after all others: it keeps a line only where no row with an id
has it. Null and empty texts are one empty line. Ids must be whole numbers (or texts of such).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmart.llm.arrow import Stage, unused

#: A key is dropped when it has so many code points or more, in so many documents or more.
LEAST_LENGTH = 40
LEAST_DOCUMENTS = 5
BATCHES = 4
FAN_IN = 2

#: What is stripped off a line's ends.
BLANKS = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
KEY = ["h1", "h2"]


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), _UPPER, _UPPER.lower())


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def key_hash(key: Column) -> Column:
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"))


def keyed_lines(text: Column, least: int = LEAST_LENGTH) -> Column:
    """(k, at) for each distinct key that is long enough, at -1, and for each line that has such a key, at its number.

    k is the key's hash as text: sets of structs would be compared one by one.
    """

    keys = F.transform(lines_of(text), lambda line, i: F.struct(line_key(line).alias("k"), i.alias("at")))
    long = F.filter(keys, lambda x: F.char_length(x["k"]) >= least)
    both = lambda k: F.concat_ws(" ", F.xxhash64(k).cast("string"), F.xxhash64(F.lit(1), k).cast("string"))
    hashed = F.transform(long, lambda x: F.struct(both(x["k"]).alias("k"), x["at"].alias("at")))

    def with_keys(own: Column) -> Column:
        once = F.array_distinct(F.transform(own, lambda x: x["k"]))
        return F.concat(F.transform(once, lambda k: F.struct(k.alias("k"), F.lit(-1).alias("at"))), own)

    return F.element_at(F.transform(F.array(hashed), with_keys), 1)  # hashed once


class Runs:
    """Levels of runs. A run holds each of its keys once: h1, h2, n (documents), keeper (null: an earlier run has it)."""

    def __init__(self, spark: SparkSession, stage: Stage, fan_in: int = FAN_IN) -> None:
        self.spark, self.stage, self.fan_in = spark, stage, fan_in
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []

    def _write(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex[:12]}"
        writer = rows.repartition(self.buckets, *KEY).write.bucketBy(self.buckets, *KEY).sortBy(*KEY)
        writer.option("path", self.stage.path(name)).saveAsTable(name)
        return name

    def tables(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def new_keys(self, keys: DataFrame) -> DataFrame:
        """The keys that no run holds."""
        for name in self.tables():
            keys = keys.join(self.spark.table(name).select(*KEY).hint("merge"), KEY, "left_anti")
        return keys

    def add(self, keys: DataFrame) -> None:
        """Takes the rows (h1, h2, n, last) of a new batch, one for each key: adds a run, then merges full levels."""
        held = keys
        if self.tables():
            new = self.new_keys(keys).select(*KEY, F.lit(True).alias("new"))
            held = keys.join(new, KEY, "left").withColumn("last", F.when(F.col("new"), F.col("last")))
        self._put(held.select(*KEY, "n", F.col("last").alias("keeper")), 0)

    def _put(self, rows: DataFrame, level: int) -> None:
        if len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(self._write(rows))
        if len(self.levels[level]) >= self.fan_in:
            full, self.levels[level] = self.levels[level], []
            self._put(self._merged(full), level + 1)
            self._drop(full)

    def _merged(self, names: list[str]) -> DataFrame:
        rows = self.spark.table(names[0])
        for name in names[1:]:
            rows = rows.unionByName(self.spark.table(name))
        return rows.groupBy(*KEY).agg(F.sum("n").alias("n"), F.max("keeper").alias("keeper"))

    def totals(self) -> DataFrame:
        """All keys with their documents and keeper."""
        return self._merged(self.tables())

    def _drop(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def close(self) -> None:
        self._drop(self.tables())


def repeated_keys(
    docs: DataFrame, doc_id: str, text: str, stage: Stage, batches: int = BATCHES, least_length: int = LEAST_LENGTH,
    least_documents: int = LEAST_DOCUMENTS,
) -> DataFrame:
    """(id, t, drop): for each id and text hash the numbers of the lines that go."""
    spark = docs.sparkSession
    ids = docs.select(F.col(doc_id).cast("bigint").alias("id"))
    edges = ids.agg(F.percentile_approx("id", [k / batches for k in range(1, batches)], 10_000)).first()[0] if batches > 1 else None
    batch = F.lit(0)
    for edge in edges or []:
        batch = batch + F.coalesce(F.col("id") <= F.lit(edge), F.lit(True)).cast("int")
    # the text's hash is taken below the explode, which would carry the text along with every line otherwise
    rows = docs.select(F.col(doc_id).cast("bigint").alias("id"), text_hash(F.col(text)).alias("t"), keyed_lines(F.col(text), least_length).alias("x"))
    # outer, as Spark would else ask beforehand whether the array is empty, and make it once more for that
    rows = rows.select("id", "t", F.explode_outer("x").alias("x")).where("x IS NOT NULL")
    h1, h2 = (F.substring_index("x.k", " ", side).cast("bigint") for side in (1, -1))
    rows = rows.select("id", "t", F.col("x.at").alias("at"), h1.alias("h1"), h2.alias("h2"), batch.alias("batch"))
    path = stage.path("lines")
    rows.write.partitionBy("batch").parquet(path)
    lines = spark.read.schema("id bigint, t bigint, at int, h1 bigint, h2 bigint, batch int").parquet(path)
    runs = Runs(spark, stage)
    try:
        for k in range(batches):
            part = lines.where((F.col("batch") == k) & (F.col("at") < 0))
            runs.add(part.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("last")))
        often = runs.totals().where(F.col("n") >= least_documents).select(*KEY, "keeper")
        often = stage.save(often, "often")
    finally:
        runs.close()
    lost = lines.where(F.col("at") >= 0).join(often, KEY)
    lost = lost.where(F.coalesce(F.col("id") < F.col("keeper"), F.col("id").isNull() & F.col("keeper").isNotNull()))
    return lost.groupBy("id", "t").agg(F.collect_set("at").alias("drop"))


def text_hash(text: Column) -> Column:
    """Tells texts with the same id apart."""
    return F.xxhash64(text)


def _without(text: Column, drop: Column) -> Column:
    """The lines but those whose numbers are in drop; null where drop is."""

    def kept(lines: Column) -> Column:
        numbers = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), drop)
        return F.transform(numbers, lambda i: F.get(lines, i))

    return F.when(drop.isNotNull(), F.element_at(F.transform(F.array(lines_of(text)), kept), 1))


def drop_repeated_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", batches: int = BATCHES, least_length: int = LEAST_LENGTH,
    least_documents: int = LEAST_DOCUMENTS,
) -> tuple[DataFrame, str, str, str]:
    """docs with three more columns, and their names: lines before, lines dropped, the text that stays."""
    stage = Stage(docs.sparkSession, "lines")
    drops = repeated_keys(docs, doc_id, text, stage, batches, least_length, least_documents)
    drop_id, drop_text, drop, kept, n, n_dropped, stays = unused(docs, "drop_id", "drop_text", "drop", "kept", "n_lines", "n_dropped", "kept_text")
    drops = drops.select(F.col("id").alias(drop_id), F.col("t").alias(drop_text), F.col("drop").alias(drop))
    same = F.col(doc_id).cast("bigint").eqNullSafe(F.col(drop_id)) & (text_hash(F.col(text)) == F.col(drop_text))
    # hashed are the line numbers of a partition's documents, a small part of its texts; the texts stream by unsorted
    joined = docs.join(drops.hint("shuffle_hash"), same, "left")
    whole = F.coalesce(F.col(text), F.lit(""))
    joined = joined.withColumn(kept, _without(F.col(text), F.col(drop)))
    joined = joined.withColumn(n, F.size(lines_of(F.col(text))).cast("bigint"))
    joined = joined.withColumn(n_dropped, F.when(F.col(kept).isNull(), F.lit(0)).otherwise(F.col(n) - F.size(kept)).cast("bigint"))
    joined = joined.withColumn(stays, F.when(F.col(kept).isNull(), whole).otherwise(F.array_join(kept, "\n")))
    return joined.drop(drop_id, drop_text, drop, kept), n, n_dropped, stays


def line_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: n_lines, n_dropped, kept_sha256."""
    rows = docs.select(F.col(doc_id), F.col(text).cast("string").alias("text"))
    out, n, n_dropped, stays = drop_repeated_lines(rows, doc_id, "text")
    return out.select(doc_id, F.col(n).alias("n_lines"), F.col(n_dropped).alias("n_dropped"), F.sha2(F.col(stays), 256).alias("kept_sha256"))


def documents_without_repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with the lines that stay as their text; a text that loses nothing is as it was."""
    out, _, n_dropped, stays = drop_repeated_lines(docs, doc_id, text)
    value = F.when(F.col(n_dropped) > 0, F.col(stays)).otherwise(F.col(text))
    return out.select(*[value.alias(c) if c == text else F.col(c) for c in docs.columns])
