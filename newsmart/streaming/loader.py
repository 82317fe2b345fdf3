"""New slim files as a stream, loaded by the same merge as a backfill."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from newsmart.operators.load import Targets, load_records, note_loaded, not_taken
from newsmart.sources import files, records
from newsmart.sources.files import ARCHIVE_SLIM, POPULAR_SLIM

FOUND = "path string, modificationTime timestamp, length bigint, content binary"


def new_files(spark: SparkSession, to: Targets, feed: str, files_per_batch: int = 1000) -> DataFrame:
    """Paths of new files of one feed, as a stream. File contents are not read."""
    return (
        spark.readStream.format("binaryFile")
        .schema(FOUND)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", str(files_per_batch))
        .load(f"{to.landing}/{feed}")
        .select("path")
    )


def start_loading(
    spark: SparkSession,
    to: Targets,
    feed: str,
    checkpoint: str,
    files_per_batch: int = 1000,
    available_now: bool = False,
) -> StreamingQuery:
    """Loads each batch of new files. The stream's checkpoint skips files seen before; with a new
    checkpoint the manifest does. Files that do not fit stand in the table of refused files, and a
    backfill tries them again. A batch that comes twice is loaded once, as the table's ledger knows its files;
    files that it or the manifest names are not read. Paths of a batch come to the driver."""
    if feed not in (ARCHIVE_SLIM, POPULAR_SLIM):
        raise ValueError(f"unknown feed {feed}")

    def load(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        paths = [files.literal(p) for p in not_taken(session, to, feed, batch)]
        if not paths:
            note_loaded(session, to, feed)
            return
        read = records.slim_archive if feed == ARCHIVE_SLIM else records.slim_popular
        load_records(session, to, feed, read(session, paths))

    writer = (
        new_files(spark, to, feed, files_per_batch)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute"
    )
    return writer.start()
