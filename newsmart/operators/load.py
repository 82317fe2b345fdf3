"""Slim files into the loaded tables, once each: staged, merged by key as one batch, noted in a manifest."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmart import schemas
from newsmart.functions.exprs import label, n_rows
from newsmart.operators import shaping
from newsmart.operators.keys import KeyIndex
from newsmart.operators.ledger import LOAD_ID, Ledger, merge_batch
from newsmart.operators.tables import (
    create_database,
    current,
    month_of,
    scratch,
    write_table,
)
from newsmart.sources import files, records
from newsmart.sources.files import ARCHIVE_SLIM, POPULAR_SLIM
from newsmart.sources.listing import Listing


@dataclass(frozen=True)
class Targets:
    """Tables a load writes to and the landing folder that file paths are relative to."""

    database: str
    landing: str

    @property
    def archive(self) -> str:
        return f"{self.database}.archive_articles"

    @property
    def popular(self) -> str:
        return f"{self.database}.most_popular_articles"

    @property
    def manifest(self) -> str:
        return f"{self.database}.load_manifest"

    @property
    def refused(self) -> str:
        return f"{self.database}.refused_files"


class BackfillError(RuntimeError):
    """A backfill that left files out. ``counts`` has (feed, outcome, files)."""

    def __init__(self, counts: list, causes: list[Exception]) -> None:
        super().__init__(f"files were left out: {counts}; errors: {[str(c)[:300] for c in causes]}")
        self.counts, self.causes = counts, causes


def create_targets(spark: SparkSession, database: str, location: str, landing: str) -> Targets:
    """Database and empty tables: archive by month, popularity by day, manifest.

    The loaded tables have one column more than declared, the id of the load that a row came with.
    """
    create_database(spark, database, location)
    to = Targets(database, landing.rstrip("/"))
    own = {LOAD_ID: "string"}
    for name, fields, partition in (
        (to.archive, {**schemas.ARCHIVE_ARTICLES, **own, "part_month": "string"}, "part_month"),
        (to.popular, {**schemas.POPULAR_ARTICLES, **own}, "snapshot_date"),
        (to.manifest, schemas.LOAD_MANIFEST, None),
        (to.refused, schemas.REFUSED_FILES, None),
    ):
        if not spark.catalog.tableExists(name):
            empty = spark.createDataFrame([], schemas.struct_type(fields))
            write_table(empty, name, partition)
    return to


def _object_path(to: Targets) -> Column:
    return files.below("file_path", to.landing)


def _whole_files(staged: DataFrame, manifest: DataFrame, done: DataFrame) -> DataFrame:
    """Records of files that no batch took in and that hold no rejected record.

    The paths of a batch's other files come to the driver and filter the records; a join by path would
    shuffle whole records, those of a large file into one task.
    """
    path = F.col("file_path").alias("path")
    broken = shaping.rejected(staged).select(path)
    known = broken.unionByName(manifest.select("path")).unionByName(done).distinct()
    others = [r["path"] for r in staged.select(path).distinct().join(known, "path", "left_semi").collect()]
    return staged.where(~F.coalesce(F.col("file_path").isin(others), F.lit(False))) if others else staged


def _note(spark: SparkSession, to: Targets, feed: str, loaded: DataFrame) -> None:
    """Adds one manifest row per loaded file that is not in there yet."""
    done = current(spark, to.manifest).select("path")
    rows = loaded.join(done, "path", "left_anti").select(
        F.lit(feed).alias("source"), "path", F.current_timestamp().alias("loaded_at")
    )
    write_table(rows, to.manifest, mode="append")


def _table(to: Targets, feed: str) -> str:
    return to.archive if feed == ARCHIVE_SLIM else to.popular


def note_loaded(spark: SparkSession, to: Targets, feed: str) -> None:
    """Notes the files of finished batches that the manifest lacks, as after a stop between ledger and manifest."""
    _note(spark, to, feed, Ledger(spark, _table(to, feed)).done_files())


def not_taken(spark: SparkSession, to: Targets, feed: str, found: DataFrame) -> list[str]:
    """Those of the found paths that neither the manifest nor a finished batch names."""
    taken = current(spark, to.manifest).select("path").unionByName(Ledger(spark, _table(to, feed)).done_files())
    taken = taken.select(F.col("path").alias("object_path"))
    here = found.select("path", files.below("path", to.landing).alias("object_path")).distinct()
    return [r["path"] for r in here.join(taken, "object_path", "left_anti").select("path").collect()]


def _refuse(spark: SparkSession, to: Targets, feed: str, reasons: DataFrame) -> None:
    """Notes (path, reason) of files that were not taken, each pair once."""
    there = current(spark, to.refused).select("path", "reason")
    rows = reasons.select("path", "reason").distinct().join(there, ["path", "reason"], "left_anti")
    rows = rows.select(
        F.lit(feed).alias("source"), "path", "reason", F.current_timestamp().alias("refused_at")
    )
    write_table(rows, to.refused, mode="append")


def archive_keys(spark: SparkSession, to: Targets) -> KeyIndex:
    """The article ids of the archive table."""
    return KeyIndex(spark, to.archive, "article_id")


def load_records(
    spark: SparkSession,
    to: Targets,
    feed: str,
    slim: DataFrame,
    listed: DataFrame | None = None,
) -> None:
    """Loads slim records of one feed as one batch.

    A file with a record that does not fit is left out as a whole and not noted as loaded, so it is
    tried again; it stands in the table of refused files with the reason, as does a popularity file
    without a date. The table's ledger says which files its batches took in; a file of these is never
    taken again, and what a stopped batch left is taken back first. So after a stop at any point, the
    next run comes to the same table and manifest, records without a key included. ``listed`` names the
    files read, so that files without records are noted as well. File paths of a batch come to the driver.
    """
    path = _object_path(to).alias("path")
    if feed == ARCHIVE_SLIM:
        checked, keys, partition = shaping.checked_articles(slim), ["article_id"], "part_month"
    else:
        undated = slim.where(F.col("snapshot_date").isNull())
        _refuse(spark, to, feed, undated.select(path, F.lit("no snapshot date").alias("reason")))
        checked = shaping.checked_popular(slim.where(F.col("snapshot_date").isNotNull()))
        keys, partition = ["snapshot_date", "id"], "snapshot_date"
    target = _table(to, feed)
    checked = checked.withColumn("file_path", _object_path(to)).drop(schemas.CORRUPT)
    # Saved as columns, the JSON text is parsed once for the check, the merge and the manifest.
    with scratch(checked) as saved:
        staged = spark.table(saved)
        reasons = shaping.rejected(staged).select(F.col("file_path").alias("path"), F.col(shaping.REASON).alias("reason"))
        _refuse(spark, to, feed, reasons)
        ledger = Ledger(spark, target)
        whole = _whole_files(staged, current(spark, to.manifest), ledger.done_files())
        if feed == ARCHIVE_SLIM:
            rows = shaping.archive_rows(shaping.accepted_articles(whole))
            rows = rows.withColumn("part_month", month_of("pub_date"))
        else:
            rows = shaping.popular_rows(shaping.accepted_popular(whole))
        seen = listed if listed is not None else staged.select(F.col("file_path").alias("path"))
        seen = seen.distinct().join(reasons.select("path").distinct(), "path", "left_anti")
        files_taken = [r.path for r in seen.join(ledger.done_files(), "path", "left_anti").collect()]
        index = archive_keys(spark, to) if feed == ARCHIVE_SLIM else None
        if files_taken:
            merge_batch(spark, target, rows, keys, partition, uuid.uuid4().hex, files_taken, index, stored=True)
        # the manifest follows the ledger; after a stop between the two, the files of an older batch are noted here
        note_loaded(spark, to, feed)


def pending_files(spark: SparkSession, to: Targets) -> DataFrame:
    """Files of both feeds below the landing folder with their status."""
    routed = files.route(files.list_files(spark, to.landing), to.landing)
    return files.file_status(routed, current(spark, to.manifest))


#: Files that are read, and whose paths are on the driver, at once.
FILES_AT_ONCE = 5_000


def _chunks(todo: DataFrame) -> Iterator[list[tuple[str, str]]]:
    chunk: list[tuple[str, str]] = []
    for row in todo.select("path", "object_path").toLocalIterator():
        chunk.append((row["path"], row["object_path"]))
        if len(chunk) >= FILES_AT_ONCE:
            yield chunk
            chunk = []
    if chunk:
        yield chunk


def _closed_files(listing: Listing) -> list:
    """(feed, outcome, files) of the files that weren't listed, as their periods are closed."""
    counted = listing.stored().groupBy("feed").agg(n_rows().alias("files")).collect()
    return [(r["feed"], "skipped", r["files"]) for r in counted]


def backfill(spark: SparkSession, to: Targets, strict: bool = True, as_of: dt.date | None = None) -> DataFrame:
    """Loads all files that are not in the manifest, some thousand at a time. Files of no bytes are not seen.

    With ``as_of``, today as a rule, only open months and days are listed (see ``sources.listing``), and those
    that are loaded whole and lie far enough back are closed at the end.

    Returns files per feed and outcome: loaded, skipped (loaded before), no snapshot date, error. An
    error in some thousand files does not keep the others from being loaded. When a file was left out, it raises
    BackfillError at the end; ``strict=False`` only counts it.
    """
    causes: list[Exception] = []
    listing = None if as_of is None else Listing(spark, to.database, to.landing)
    if listing is None:
        found, counts = pending_files(spark, to), []
    else:
        found, counts = files.file_status(listing.list_open(as_of), current(spark, to.manifest)), _closed_files(listing)
    with scratch(found) as saved:
        before = spark.table(saved)
        undated = before.where(F.col("status") == "no snapshot date")
        reasons = undated.select(F.col("object_path").alias("path"), F.lit("no snapshot date").alias("reason"))
        _refuse(spark, to, POPULAR_SLIM, reasons)
        for feed, read in (
            (ARCHIVE_SLIM, records.slim_archive), (POPULAR_SLIM, records.slim_popular)
        ):
            todo = before.where((F.col("feed") == feed) & (F.col("status") == "pending"))
            for chunk in _chunks(todo):
                listed = spark.createDataFrame([(p,) for _, p in chunk], "path string")
                try:
                    load_records(spark, to, feed, read(spark, [p for p, _ in chunk]), listed)
                except Exception as cause:  # the other files are loaded all the same
                    causes.append(cause)
        manifest = current(spark, to.manifest)
        counts = _added(counts, _outcomes(before, manifest).collect())
        if listing is not None:
            listing.close(files.file_status(before.drop("status"), manifest), as_of)
    if strict and (causes or any(outcome in ("error", "no snapshot date") for _, outcome, _ in counts)):
        raise BackfillError(counts, causes)
    return spark.createDataFrame(counts, "feed string, outcome string, files bigint")


def _added(one: list, other: list) -> list[tuple[str, str, int]]:
    total: dict[tuple[str, str], int] = {}
    for feed, outcome, n in [*one, *other]:
        total[feed, outcome] = total.get((feed, outcome), 0) + n
    return [(*kind, n) for kind, n in total.items()]


def _outcomes(before: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files per feed and outcome: what was pending and is noted now was loaded."""
    done = manifest.select(F.col("path").alias("object_path"), F.lit(True).alias("done")).distinct()
    status = F.col("status")
    outcome = label(
        [
            (status == "loaded", "skipped"),
            (status != "pending", "no snapshot date"),
            (F.col("done"), "loaded"),
        ],
        "error",
    )
    return (
        before.join(done, "object_path", "left")
        .groupBy("feed", outcome.alias("outcome"))
        .agg(n_rows().alias("files"))
    )
