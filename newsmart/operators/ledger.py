"""Batches that went into a table, each exactly once, and the keys the table holds.

Every row of such a table carries the id of the attempt that appended it. The ledger of a table gets a row when an
attempt begins (with the partitions it will touch) and one when it is done (with the files it took in). A batch
that is done is never appended again. An attempt that was stopped is taken back before the next one: the partitions
named when it began are rewritten without its rows. So a replay gives the same table, rows without a key included,
and only touched partitions are read for it. A table has one writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from contextlib import nullcontext
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmart import schemas
from newsmart.operators import tables
from newsmart.operators.keys import KeyIndex, KeyState
from newsmart.operators.tables import current, insert_only, lie_together, pieces, scratch, without_keys, write_table

LOAD_ID = "load_id"
LEDGER: schemas.Fields = {
    "batch": "string", "attempt": "string", "state": "string", "partitions": "array<string>", "files": "array<string>",
    "n_rows": "bigint", "noted_at": "timestamp",
}
BEGUN, DONE, UNDONE, INDEXED = "begun", "done", "undone", "indexed"


def in_partitions(partition: str, values: Iterable[str | None]) -> Column:
    """Rows of the partitions, given as text; null is a partition too."""
    values = list(values)
    here = F.col(partition).cast("string").isin([v for v in values if v is not None])
    return here | F.col(partition).isNull() if None in values else here


def _texts(values: Iterable[str | None]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


@dataclass
class Entry:
    batch: str
    attempt: str
    state: str
    n_rows: int


class Ledger:
    """The ledger of one table, kept in a table beside it; `entries` is what it says now, files and partitions aside."""

    def __init__(self, spark: SparkSession, target: str) -> None:
        self.spark, self.target, self.name = spark, target, f"{target}_batches"
        if not spark.catalog.tableExists(self.name):
            write_table(spark.createDataFrame([], schemas.struct_type(LEDGER)), self.name)
        self.read()

    def rows(self) -> DataFrame:
        return current(self.spark, self.name)

    def read(self) -> None:
        rows = self.rows().select("noted_at", "batch", "attempt", "state", "n_rows").collect()
        self.entries = [Entry(*r[1:]) for r in sorted(rows, key=lambda r: r.noted_at)]

    def note(self, batch: str, attempt: str, state: str, partitions: Iterable = (), files: Iterable = (), n_rows: int = 0) -> None:
        values = {
            "batch": F.lit(batch), "attempt": F.lit(attempt), "state": F.lit(state), "partitions": _texts(partitions),
            "files": _texts(files), "n_rows": F.lit(n_rows).cast("bigint"), "noted_at": F.current_timestamp(),
        }
        row = self.spark.range(1, numPartitions=1).select(*[v.alias(k) for k, v in values.items()])
        row.write.format("parquet").mode("append").saveAsTable(self.name)
        self.entries.append(Entry(batch, attempt, state, n_rows))

    def is_done(self, batch: str) -> bool:
        return any(e.batch == batch and e.state == DONE for e in self.entries)

    def undone(self) -> list[str]:
        """Attempts that were taken back: one for each stop."""
        return sorted({e.attempt for e in self.entries if e.state == UNDONE})

    def done_files(self, batch: str | None = None) -> DataFrame:
        """Files of the batch, or of all batches that are done, as path."""
        done = self.rows().where(F.col("state") == DONE)
        done = done if batch is None else done.where(F.col("batch") == batch)
        return done.select(F.explode("files").alias("path")).distinct()

    def last_done(self) -> str | None:
        return next((e.batch for e in reversed(self.entries) if e.state == DONE), None)

    def recover(self, partition: str) -> None:
        """Takes back every attempt that came to no end."""
        ended = {e.attempt for e in self.entries if e.state in (DONE, UNDONE)}
        stopped = [e for e in self.entries if e.state == BEGUN and e.attempt not in ended]
        for e in stopped:
            named = self.rows().where((F.col("attempt") == e.attempt) & (F.col("state") == BEGUN)).select("partitions").first()
            _take_back(self.spark, self.target, e.attempt, partition, list(named.partitions))
            self.note(e.batch, e.attempt, UNDONE)

    def key_state(self) -> KeyState:
        """Where the keys lie, and the batches and rows added since that was noted."""
        last = max((i for i, e in enumerate(self.entries) if e.state == INDEXED), default=None)
        since = [e.n_rows for e in self.entries[(last or 0) :] if e.state == DONE and e.n_rows]
        found = KeyState() if last is None else KeyState.of(self.entries[last].batch)
        found.recent_batches, found.recent_rows, found.undone = len(since), sum(since), self.undone()
        return found


def _take_back(spark: SparkSession, name: str, attempt: str, partition: str, values: list[str | None]) -> None:
    """Rewrites the partitions that hold rows of the attempt without them; repeating it changes nothing."""
    table = current(spark, name).where(in_partitions(partition, values))
    held = [r[0] for r in table.where(F.col(LOAD_ID) == attempt).select(partition).distinct().collect()]
    if not held:
        return
    session = spark.newSession()
    session.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    here = in_partitions(partition, [None if v is None else str(v) for v in held])
    with scratch(table.where(here).where(F.col(LOAD_ID) != attempt)) as saved:
        filled = {r[0] for r in spark.table(saved).select(partition).distinct().collect()}
        for value in set(held) - filled:
            tables._drop_partition(session, name, partition, value)
        if filled:
            tables._overwrite_partitions(session, saved, name, table.columns, partition)
    spark.catalog.refreshTable(name)


def _to_add(
    spark: SparkSession, name: str, source: DataFrame, keys: list[str], partition: str, index: KeyIndex | None, state: KeyState
) -> DataFrame:
    """The source's rows that the table lacks, by its key index or by its own keys."""
    if index is not None:
        return without_keys(source, index.known(source, state), [index.key])
    target = current(spark, name)
    if partition in keys:
        values = [None if r[0] is None else str(r[0]) for r in source.select(partition).distinct().collect()]
        target = target.where(in_partitions(partition, values))
    return insert_only(source, target, keys)


def merge_batch(
    spark: SparkSession,
    name: str,
    source: DataFrame,
    keys: list[str],
    partition: str,
    batch: str,
    files: Iterable[str] = (),
    index: KeyIndex | None = None,
    stored: bool = False,
) -> bool:
    """Insert-only merge of a batch, exactly once; False where the batch was done before.

    Rows whose keys the table doesn't hold are added, those without a key as well. With an index the table isn't read.
    ``stored`` says that the source reads saved tables and gives the same rows each time; others are saved first.
    """
    ledger = Ledger(spark, name)
    if ledger.is_done(batch):
        return False
    ledger.recover(partition)
    attempt = f"{batch}/{uuid.uuid4().hex[:12]}"
    fresh = _to_add(spark, name, source, keys, partition, index, ledger.key_state())
    fresh = fresh.withColumn(LOAD_ID, F.lit(attempt))
    with nullcontext() if stored else scratch(fresh) as saved:
        rows = spark.table(saved) if saved else fresh
        found = pieces(rows, F.col(partition).cast("string"))
        values, n = [r["value_0"] for r in found], sum(r["n"] for r in found)
        if n:
            ledger.note(batch, attempt, BEGUN, values)
            write_table(rows, name, partition, mode="append", together=lie_together(found))
            if index is not None:  # from the table, as the source may not be read again once its keys are known
                added = current(spark, name).where(in_partitions(partition, values)).where(F.col(LOAD_ID) == attempt)
                index.add(added, ledger.key_state())
        ledger.note(batch, attempt, DONE, files=files, n_rows=n)
    if index is not None and index.is_crowded(ledger.key_state()):
        note_index(ledger, index.flush(ledger.key_state()))
    return True


def note_index(ledger: Ledger, state: KeyState) -> None:
    """Makes the newly written keys the ones that count, and drops those that they replace."""
    before = ledger.key_state()
    ledger.note(state.text(), "", INDEXED)
    KeyIndex(ledger.spark, ledger.target, "").drop_replaced(before, state)
