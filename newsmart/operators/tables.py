"""Partitioned catalog tables: layered lookup, clustered writes, insert-only merge, upsert."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager, nullcontext

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from newsmart.schemas import Fields, struct_type
from newsmart.session import shared_dir

SCRATCH = "newsmart_scratch"

# Database names of the layers.
LAYERS = {"core": "dbt_core", "analytics": "dbt_analytics", "staging": "dbt_staging"}


def layer_name(layer: str, prefix: str = "") -> str:
    """Database of a layer; unknown layers fall back to core. ``prefix`` keeps environments apart."""
    return prefix + LAYERS.get(layer, LAYERS["core"])


def layer_table(spark: SparkSession, layer: str, table: str, prefix: str = "") -> DataFrame:
    return spark.table(f"{layer_name(layer, prefix)}.{table}")


def current(spark: SparkSession, name: str) -> DataFrame:
    """The table as it is now. A stream writes from a session of its own, so the file listing this
    session remembers may be old."""
    spark.catalog.refreshTable(name)
    return spark.table(name)


def create_database(spark: SparkSession, name: str, location: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{location}'")


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """While the block runs, a write's shuffle files are given up when it ends, not when the driver happens to collect garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def scratch(df: DataFrame) -> Iterator[str]:
    """Name of a table that holds ``df`` while the block runs.

    It lies in the shared folder, so what follows does not depend on the executors that wrote it,
    and is dropped with its files at the end.
    """
    spark = df.sparkSession
    create_database(spark, SCRATCH, f"{shared_dir(spark)}/newsmart/scratch")
    name = f"{SCRATCH}.t_{uuid.uuid4().hex}"
    try:
        with released(spark):
            df.write.format("parquet").saveAsTable(name)
        yield name
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def month_of(date: Column | str) -> Column:
    """Month partition value, such as ``2001-08``; null for no date."""
    return F.date_format(date, "yyyy-MM")


def in_months(df: DataFrame, column: str, first: dt.date, last: dt.date) -> DataFrame:
    """Rows dated between two days, with the matching month predicate so that partitions are pruned."""
    months = F.col("part_month").between(f"{first:%Y-%m}", f"{last:%Y-%m}")
    return df.where(months & F.col(column).between(F.lit(first), F.lit(last)))


def by_folder(df: DataFrame, *folders: str) -> DataFrame:
    """Rows brought together by output folder, so that a folder gets few files.

    The rebalance is sized at run time: small folders share a task, a large one is split over many.
    """
    return df.hint("rebalance", *folders)


#: Folders that a task writes side by side; rows of further ones are sorted by folder first.
WRITERS = 16


@contextmanager
def side_by_side(spark: SparkSession) -> Iterator[None]:
    """While the block runs, a task keeps the files of up to WRITERS folders open instead of sorting its rows by folder."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, str(WRITERS))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def pieces(rows: DataFrame, folder: Column | str, *folders: Column | str) -> list[Row]:
    """Each folder's rows (``n``), the tasks that read some of them (``tasks``), the highest of these (``last``).

    Reads the rows' folder columns, so the rows should be stored. One entry a folder comes to the driver.
    """
    named = [(F.col(c) if isinstance(c, str) else c).alias(f"value_{i}") for i, c in enumerate((folder, *folders))]
    values = [f"value_{i}" for i in range(len(named))]
    by_task = rows.select(*named, F.spark_partition_id().alias("task")).groupBy(*values, "task").agg(F.count(F.lit(1)).alias("n"))
    return by_task.groupBy(*values).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("tasks"), F.max("task").alias("last")
    ).collect()


def lie_together(found: Sequence[Row]) -> bool:
    """Whether a folder's rows are in few tasks, told from their pieces, as with files that each hold few folders.

    Such rows can be written as they lie, without a shuffle: the files are at most about twice as many as
    folders and tasks together.
    """
    tasks = max((r["last"] for r in found), default=0) + 1
    return sum(r["tasks"] for r in found) <= 2 * (len(found) + tasks)


#: Ranges of a column in an interleaved order are 2 ** RANGE_BITS, told from about SAMPLE_ROWS rows.
RANGE_BITS, SAMPLE_ROWS = 5, 20_000


def _bounds(df: DataFrame, columns: Sequence[str]) -> dict[str, list]:
    """Values that cut each column into ranges of about as many rows, from a sample of bounded size."""
    n = df.count()
    sample = df.select(*columns) if n <= SAMPLE_ROWS else df.select(*columns).sample(SAMPLE_ROWS / n, 7)
    rows = sample.limit(2 * SAMPLE_ROWS).collect()
    out = {}
    for i, c in enumerate(columns):
        values = sorted(r[i] for r in rows if r[i] is not None)
        cuts = [values[len(values) * k // (1 << RANGE_BITS)] for k in range(1, 1 << RANGE_BITS)] if values else []
        out[c] = sorted(set(cuts))
    return out


def interleaved(df: DataFrame, columns: Sequence[str]) -> Column:
    """A number that orders rows by all columns alike: the bits of the columns' ranges, taken in turn.

    Rows near each other in it are near in every column, so statistics of files and row groups help a filter
    on any of them. Nulls come first.
    """
    order = F.lit(0)
    for at, (c, cuts) in enumerate(_bounds(df, columns).items()):
        place = F.lit(0)
        for cut in cuts:
            place = place + F.when(F.col(c) >= F.lit(cut), 1).otherwise(0)
        for bit in range(RANGE_BITS):
            target = bit * len(columns) + len(columns) - 1 - at
            order = order + F.shiftleft(F.shiftright(place, bit).bitwiseAND(F.lit(1)).cast("bigint"), target)
    return order


def write_table(
    df: DataFrame,
    name: str,
    partition: str | None = None,
    cluster: Sequence[str] = (),
    key: str | None = None,
    mode: str = "overwrite",
    interleave: bool = False,
    together: bool = False,
) -> None:
    """Writes a table, optionally partitioned and clustered.

    ``together`` says that the rows of a partition are in few tasks (``lie_together``), which then write them without a shuffle.

    A clustered table is ranged and sorted by partition, cluster columns and key, so that file
    statistics can skip data; the key at the end keeps one large cluster value from filling a task.
    That helps filters on the first column; ``interleave`` orders by all cluster columns alike, so
    that a filter on any one of them skips data, and reads the columns once more to find their ranges.
    """
    if cluster and interleave:
        order = [c for c in (partition, "_order", *cluster, key) if c]
        df = df.withColumn("_order", interleaved(df, cluster))
        df = df.repartitionByRange(*order).sortWithinPartitions(*order).drop("_order")
    elif cluster:
        order = [c for c in (partition, *cluster, key) if c]
        df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    elif partition and not together:
        df = by_folder(df, partition)
    writer = df.write.format("parquet").mode(mode)
    if partition:
        writer = writer.partitionBy(partition)
    with released(df.sparkSession), side_by_side(df.sparkSession) if partition and together else nullcontext():
        writer.saveAsTable(name)


def materialize(df: DataFrame, name: str, kind: str) -> DataFrame:
    """A model as its layer keeps it: ``table``, ``view`` (of this session) or ``inline``."""
    if kind == "table":
        write_table(df, name)
        return current(df.sparkSession, name)
    if kind == "view":
        df.createOrReplaceTempView(name)
        return df.sparkSession.table(name)
    if kind == "inline":
        return df
    raise ValueError(f"unknown kind {kind}")


def declared(df: DataFrame, fields: Fields) -> DataFrame:
    """The declared columns in declared order and type; a missing or unfit column is an error."""
    return df.to(struct_type(fields))


def without_keys(rows: DataFrame, present: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys are not in ``present``. A null key matches nothing and stays."""
    return rows.join(present.select(*keys), list(keys), "left_anti")


def insert_only(
    source: DataFrame, target: DataFrame, keys: Sequence[str], dedupe_source: bool = False
) -> DataFrame:
    """Source rows an insert-only merge adds: those whose keys the target does not hold.

    Nothing is updated. Rows that repeat a key within the source are all added, unless
    ``dedupe_source`` keeps one of them; rows with a null key are always added.
    """
    if dedupe_source:
        has_key = F.lit(True)
        for key in keys:
            has_key = has_key & F.col(key).isNotNull()
        source = source.where(has_key).dropDuplicates(list(keys)).unionByName(
            source.where(~has_key)
        )
    return without_keys(source, target, keys)


def merge_into(
    spark: SparkSession,
    name: str,
    source: DataFrame,
    keys: Sequence[str],
    partition: str | None = None,
    dedupe_source: bool = False,
) -> None:
    """Insert-only merge into a table by an append. Running it again adds nothing new.

    Where the partition column is one of the keys, only the partitions that the source has rows for
    are read. Their values come to the driver: one for each day or month of the source.
    """
    target = current(spark, name)
    if partition in keys:
        values = [row[0] for row in source.select(partition).distinct().collect()]
        target = target.where(F.col(partition).isin([v for v in values if v is not None]))
    fresh = insert_only(source, target, keys, dedupe_source)
    write_table(fresh, name, partition, mode="append")


def newer_than(df: DataFrame, target: DataFrame, column: str) -> DataFrame:
    """Rows dated after the target's newest date.

    The date is fetched first, so the filter is a literal that prunes partitions and row groups.
    Later arrivals at or before that date and rows without a date are left out; an empty target
    leaves nothing.
    """
    newest = target.agg(F.max(column)).first()[0]
    if newest is None:
        return df.where(F.lit(False))
    return df.where(F.col(column) > F.lit(newest))


def upsert(
    spark: SparkSession, name: str, new: DataFrame, keys: Sequence[str], partition: str
) -> None:
    """Replaces rows with the same keys and adds the others, rewriting only touched partitions.

    The new rows are saved first, so that their source is evaluated once. Touched are their partitions
    and those that hold a row to be replaced, found in one pass over the target's keys; the values come
    to the driver, one for each month or day. New contents are saved beside the table, because a plan
    cannot overwrite what it reads. A partition that loses its last row is dropped before the others are
    overwritten: after a stop in between, the table has no newer rows than before, and the same call, or
    the next incremental run, brings it to the same end.
    """
    target = current(spark, name)
    columns = target.columns
    # The overwrite mode of a catalog table is a session setting, so the write has its own session.
    session = spark.newSession()
    session.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    with scratch(new.select(*columns)) as staged:
        rows = spark.table(staged)
        replaced = target.select(partition, *[k for k in keys if k != partition])
        replaced = replaced.join(rows.select(*keys), list(keys), "left_semi")
        incoming = {row[0] for row in rows.select(partition).distinct().collect()}
        touched = incoming | {row[0] for row in replaced.select(partition).distinct().collect()}
        if not touched:
            return
        here = F.col(partition).isin([v for v in touched if v is not None])
        if None in touched:
            here = here | F.col(partition).isNull()
        kept = without_keys(target.where(here), rows, keys)
        with scratch(kept.select(*columns).unionByName(rows)) as saved:
            filled = {row[0] for row in spark.table(saved).select(partition).distinct().collect()}
            for value in touched - filled:
                _drop_partition(session, name, partition, value)
            _overwrite_partitions(session, saved, name, columns, partition)
    spark.catalog.refreshTable(name)


def _drop_partition(session: SparkSession, name: str, partition: str, value: object) -> None:
    shown = "null" if value is None else f"'{value}'"
    session.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({partition} = {shown})")


def _overwrite_partitions(
    session: SparkSession, saved: str, name: str, columns: list[str], partition: str
) -> None:
    rows = session.table(saved).select(*columns)
    by_folder(rows, partition).write.insertInto(name, overwrite=True)


def touched_by(
    spark: SparkSession, source: DataFrame, ids: DataFrame, keys: Sequence[str], date: str, newest: object, prune: str | None
) -> DataFrame:
    """Source rows dated after ``newest``, and the older rows that share a key with them (``ids``).

    With ``prune``, a column such as the month, the older rows' keys are read first; other columns are then read
    only where that column has a value at which an older row was found. These values come to the driver.
    """
    fresh = source.where(F.col(date) > F.lit(newest))
    older = source.where((F.col(date) <= F.lit(newest)) | F.col(date).isNull())
    if prune:
        hits = older.select(prune, *[k for k in keys if k != prune]).join(ids, list(keys), "left_semi")
        values = [r[0] for r in hits.select(prune).distinct().collect()]
        here = F.col(prune).isin([v for v in values if v is not None])
        older = older.where(here | F.col(prune).isNull() if None in values else here)
        if not values:
            return fresh
    return fresh.unionByName(older.join(ids, list(keys), "left_semi"))


def run_incremental(
    spark: SparkSession,
    name: str,
    source: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    keys: Sequence[str],
    date: str,
    partition: str,
    cluster: Sequence[str] = (),
    full_refresh: bool = False,
    lookback_days: int | None = None,
    prune: str | None = None,
) -> None:
    """One run of an incremental model.

    The first run and a full refresh write everything. Later runs take only rows dated after the
    table's newest date and upsert them by key. ``build`` makes a row from the rows of its key alone;
    it is given the newer rows and the older ones with the same keys, so that counts per key take in
    rows on either side of that date, and only its newer rows are kept. ``prune`` names a source column
    by which older rows can be skipped. ``lookback_days`` is accepted and has no effect. ``build`` must
    give rows with the date and the partition column.
    """
    if full_refresh or not spark.catalog.tableExists(name):
        write_table(build(source), name, partition, cluster, keys[-1])
        return
    newest = current(spark, name).agg(F.max(date)).first()[0]
    if newest is None:
        return
    with scratch(source.where(F.col(date) > F.lit(newest)).select(*keys).distinct()) as saved:
        rows = touched_by(spark, source, spark.table(saved), keys, date, newest, prune)
        upsert(spark, name, build(rows).where(F.col(date) > F.lit(newest)), keys, partition)
