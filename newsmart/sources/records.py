"""Readers for raw and slim JSON. Schemas are explicit, so nothing is scanned to infer them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmart import schemas
from newsmart.schemas import CORRUPT, Fields, ddl
from newsmart.sources.files import (
    DAY_PATTERN,
    below,
    path_month,
    path_snapshot_date,
    path_year,
    read_path,
)

Paths = str | list[str]


def _json(spark: SparkSession, paths: Paths, fields: Fields, multiline: bool) -> DataFrame:
    return (
        spark.read.schema(ddl(fields))
        .option("multiLine", str(multiline).lower())
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("recursiveFileLookup", "true")
        .json(paths)
        .select("*", read_path().alias("file_path"))
    )


def _unpack(objects: DataFrame, docs: str) -> DataFrame:
    """One row per doc. A missing list gives no row; an unreadable object gives one, without a doc."""
    return (
        objects.select("file_path", CORRUPT, F.explode_outer(docs).alias("doc"))
        .where(F.col("doc").isNotNull() | F.col(CORRUPT).isNotNull())
        .select("doc.*", CORRUPT, "file_path")
    )


def _below_root(paths: Paths, root: str | None) -> Column:
    """Path of a record's file below the root: the folder read from, where none is named."""
    root = root or (paths if isinstance(paths, str) else None)
    return below("file_path", root) if root else F.col("file_path")


def raw_archive(
    spark: SparkSession, paths: Paths, multiline: bool = True, root: str | None = None
) -> DataFrame:
    """Docs of raw archive months with the year and month of their path below the root.

    ``multiline=False`` reads objects that stand on one line each; such files can be split.
    """
    objects = _json(spark, paths, schemas.RAW_ARCHIVE_FILE, multiline)
    path = _below_root(paths, root)
    return _unpack(objects, "response.docs").withColumns(
        {"year": path_year(path), "month": path_month(path)}
    )


def raw_popular(
    spark: SparkSession, paths: Paths, multiline: bool = True, root: str | None = None
) -> DataFrame:
    """Results of raw popularity snapshots with the date of their path below the root."""
    objects = _json(spark, paths, schemas.RAW_POPULAR_FILE, multiline)
    return _unpack(objects, "results").withColumn(
        "snapshot_date", path_snapshot_date(_below_root(paths, root), DAY_PATTERN)
    )


def slim_archive(spark: SparkSession, paths: Paths) -> DataFrame:
    """Slim archive records, dates and integers as text."""
    return _json(spark, paths, schemas.SLIM_ARCHIVE_FILE, False)


def slim_popular(spark: SparkSession, paths: Paths) -> DataFrame:
    """Slim popularity records, integers as text, with the snapshot date of their path."""
    return _json(spark, paths, schemas.SLIM_POPULAR_FILE, False).withColumn(
        "snapshot_date", path_snapshot_date(F.col("file_path"))
    )
