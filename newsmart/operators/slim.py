"""Raw files to slim files, month by month and day by day, skipping what exists."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import nullcontext

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmart import schemas
from newsmart.operators import shaping
from newsmart.operators.tables import by_folder, lie_together, pieces, released, scratch, side_by_side
from newsmart.sources import files, records


def write_slim(
    slim: DataFrame, folder: str, by: list[str], overwrite: bool, compression: str | None = None
) -> None:
    """JSON lines in one folder per value of ``by``; null fields are written out.

    The rows should be stored: their folders are read first. Where a folder's rows lie in few tasks, as
    they do when every raw file belongs to one folder, they are written as they lie, else brought together.
    ``overwrite`` replaces only the folders that get rows. ``compression`` is a codec of Spark's JSON
    writer (``gzip``: files end in ``.json.gz``); readers take it by the suffix.
    """
    near = lie_together(pieces(slim, *by))
    writer = (
        (slim if near else by_folder(slim, *by))
        .write.partitionBy(*by)
        .mode("overwrite" if overwrite else "append")
        .option("partitionOverwriteMode", "dynamic")
        .option("ignoreNullFields", "false")
    )
    if compression:
        writer = writer.option("compression", compression)
    with released(slim.sparkSession), side_by_side(slim.sparkSession) if near else nullcontext():
        writer.json(folder)


#: Raw files whose paths are on the driver at once.
FILES_AT_ONCE = 5_000


def _values(files_found: DataFrame, root: str, from_path: dict[str, Callable]) -> DataFrame:
    path = files.below("path", root)
    return files_found.select("path", *[make(path).alias(name) for name, make in from_path.items()])


def done_folder(slim: str) -> str:
    """Where the folder values that were worked off are noted, beside the slim files."""
    return f"{slim.rstrip('/')}-done"


def _done(spark: SparkSession, slim: str, from_path: dict[str, Callable]) -> DataFrame:
    """Folder values that have slim files or were noted: a month without any accepted record has no files."""
    names = list(from_path)
    there = _values(files.list_or_none(spark, slim), slim, from_path).select(*names)
    noted = _values(files.list_or_none(spark, done_folder(slim)), done_folder(slim), from_path)
    return there.unionByName(noted.select(*names)).distinct()


def pending_files(
    spark: SparkSession, raw: str, slim: str, from_path: dict[str, Callable], overwrite: bool
) -> DataFrame:
    """Raw files and their folder values, without those worked off; with ``overwrite``, all of them."""
    found = _values(files.list_files(spark, raw), raw, from_path)
    return found if overwrite else found.join(_done(spark, slim, from_path), list(from_path), "left_anti")


def _in_chunks(todo: DataFrame, names: list[str]) -> Iterator[list[str]]:
    """Paths of whole output folders, FILES_AT_ONCE or as many as a folder has. todo is sorted by the names."""
    chunk: list[str] = []
    folder = None
    for row in todo.select("path", *names).toLocalIterator():
        own = tuple(row[1:])
        if len(chunk) >= FILES_AT_ONCE and own != folder:
            yield chunk
            chunk = []
        chunk.append(row["path"])
        folder = own
    if chunk:
        yield chunk


def rejected_folder(slim: str) -> str:
    """Where rejected records are kept, beside the slim files, in one folder for each run."""
    return f"{slim.rstrip('/')}-rejected"


def _transform(
    spark: SparkSession,
    raw: str,
    slim: str,
    from_path: dict[str, Callable],
    checked: Callable[[list[str]], DataFrame],
    accepted: Callable[[DataFrame], DataFrame],
    overwrite: bool,
    compression: str | None = None,
) -> DataFrame | None:
    """Slim files of all pending raw files, some thousand at a time; returns the rejected records.

    Rejected records are stored, then the slim files are written and their folders noted as done, so that
    after a stop only the files of one step are worked off again.
    """
    kept = f"{rejected_folder(slim)}/{uuid.uuid4().hex[:12]}"
    schema = None
    with scratch(pending_files(spark, raw, slim, from_path, overwrite)) as saved:
        # sorted, so that files of one output folder are worked off together
        todo = spark.table(saved).orderBy(*from_path, "path")
        for paths in _in_chunks(todo, list(from_path)):
            # saved as columns, the raw JSON is parsed once for the rejected records and the slim files
            with scratch(checked(paths)) as parsed:
                rows = spark.table(parsed)
                bad = shaping.rejected(rows)
                schema = bad.schema
                bad.write.mode("append").parquet(kept)
                write_slim(accepted(rows), slim, list(from_path), overwrite, compression)
            chunk = spark.createDataFrame([(p,) for p in paths], "path string")
            noted = _values(chunk, raw, from_path).withColumnRenamed("path", "value").groupBy(*from_path).agg(F.min("value").alias("value"))
            by_folder(noted, *from_path).write.partitionBy(*from_path).mode("append").text(done_folder(slim))
    return None if schema is None else spark.read.schema(schema).parquet(kept)


def transform_archive(
    spark: SparkSession,
    raw: str,
    slim: str,
    overwrite: bool = False,
    multiline: bool = True,
    compression: str | None = None,
) -> DataFrame | None:
    """Writes the slim months that are missing and returns the rejected records of that run, which are kept.

    Returns None when there is nothing to do. A month without accepted records is done as well.
    """

    def checked(paths: list[str]) -> DataFrame:
        docs = records.raw_archive(spark, paths, multiline, raw)
        return shaping.checked_articles(shaping.slim_articles(docs))

    def accepted(rows: DataFrame) -> DataFrame:
        return shaping.accepted_articles(rows).select(*schemas.SLIM_ARCHIVE, "year", "month")

    from_path = {"year": files.path_year, "month": files.path_month}
    return _transform(spark, raw, slim, from_path, checked, accepted, overwrite, compression)


def transform_popular(
    spark: SparkSession,
    raw: str,
    slim: str,
    overwrite: bool = False,
    multiline: bool = True,
    compression: str | None = None,
) -> DataFrame | None:
    """Writes the slim days that are missing and returns the rejected records of that run."""

    def checked(paths: list[str]) -> DataFrame:
        docs = records.raw_popular(spark, paths, multiline, raw)
        return shaping.checked_popular(shaping.slim_popular(docs))

    def accepted(rows: DataFrame) -> DataFrame:
        return shaping.accepted_popular(rows).select(*schemas.SLIM_POPULAR, "snapshot_date")

    from_path = {"snapshot_date": lambda p: files.path_snapshot_date(p, files.DAY_PATTERN)}
    return _transform(spark, raw, slim, from_path, checked, accepted, overwrite, compression)
