"""File listings as DataFrames: discovery, routing to a feed, and what is left to load."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from newsmart.functions.exprs import label, n_rows

# Folder names of the feeds.
ARCHIVE_SLIM = "archive_slim"
POPULAR_SLIM = "most_popular_slim"

# Folders may be plain values or carry the column name, as a partitioned write leaves them. Values are
# taken from the folders right above a file, or from its name, so a path's beginning never counts.
MONTH_PATTERN = r"(?:^|/)(?:year=)?(\d{4})/(?:month=)?(\d{1,2})(?:/[^/]+|\.[^/]+)$"
DAY_PATTERN = r"(?:^|/)(?:snapshot_date=)?(\d{4}-\d{2}-\d{2})/[^/]+$"
SNAPSHOT_PATTERN = r"(?:^|/)" + POPULAR_SLIM + r"/(?:snapshot_date=)?(\d{4}-\d{2}-\d{2})/[^/]+$"


LISTED = "path string, length bigint, modified timestamp"

#: Endings of compressed files, which count as files of the suffix in front of them (``05.json.gz`` is JSON).
COMPRESSED = (".gz",)


def list_files(spark: SparkSession, root: str, modified_after: str | None = None) -> DataFrame:
    """Path, size and time of every file below ``root``, which may be a glob. File contents are not read.

    ``modified_after`` is a time of the session's zone, as yyyy-MM-ddTHH:mm:ss; older files are left out.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    return reader.load(root).select("path", "length", F.col("modificationTime").alias("modified"))


def list_or_none(spark: SparkSession, root: str, modified_after: str | None = None) -> DataFrame:
    """The same, with no rows where nothing lies at ``root``."""
    try:
        return list_files(spark, root, modified_after)
    except AnalysisException:
        return spark.createDataFrame([], LISTED)


def literal(path: str) -> str:
    """The path with the characters escaped that a glob gives a meaning."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def read_path() -> Column:
    """Path of the file a record was read from, spelled the way a listing spells it."""
    encoded = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    return F.url_decode(encoded)


def _without_scheme(path: str) -> str:
    return re.sub(r"^[A-Za-z][A-Za-z0-9+.\-]*:(?://)?", "", path)


def below(path: Column | str, root: str) -> Column:
    """Path relative to ``root``, or the whole path if it lies elsewhere; schemes do not matter."""
    path = F.col(path) if isinstance(path, str) else path
    folder = _without_scheme(root).rstrip("/") + "/"
    plain = F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.\-]*:(?://)?", "")
    inside = F.substring(plain, len(folder) + 1, 1 << 20)
    return F.when(F.startswith(plain, F.lit(folder)), inside).otherwise(path)


def _month_part(path: Column, group: int) -> Column:
    """Only the last two folders and the name are searched; the pattern can't match further up."""
    return F.regexp_extract(F.substring_index(path, "/", -3), MONTH_PATTERN, group).try_cast("int")


def path_year(path: Column) -> Column:
    return _month_part(path, 1)


def path_month(path: Column) -> Column:
    return _month_part(path, 2)


def path_snapshot_date(path: Column, pattern: str = SNAPSHOT_PATTERN) -> Column:
    """Date folder of a popularity file, null when there is none or it is no date."""
    return F.try_to_date(F.nullif(F.regexp_extract(path, pattern, 1), F.lit("")), "yyyy-MM-dd")


def route(files: DataFrame, root: str, prefix: str = "") -> DataFrame:
    """Adds the path below ``root``, the feed (null for other files) and the snapshot date.

    ``prefix`` is a folder in front of the feeds; it is taken off when present.
    """
    rel = below("path", root)
    if prefix:
        front = prefix.rstrip("/") + "/"
        rest = F.substring(rel, len(front) + 1, 1 << 20)
        rel = F.when(F.startswith(rel, F.lit(front)), rest).otherwise(rel)
    routed = files.withColumn("object_path", rel)
    feed = label(
        [
            (F.startswith("object_path", F.lit(f"{name}/")), name)
            for name in (ARCHIVE_SLIM, POPULAR_SLIM)
        ]
    )
    return routed.withColumn("feed", feed).withColumn(
        "snapshot_date",
        F.when(F.col("feed") == POPULAR_SLIM, path_snapshot_date(F.col("object_path"))),
    )


def file_status(
    routed: DataFrame, manifest: DataFrame, suffixes: tuple[str, ...] = (".ndjson", ".json")
) -> DataFrame:
    """Feed files with a status: ``loaded`` (in the manifest), ``no snapshot date`` or ``pending``."""
    kept = F.lit(False)
    for suffix in suffixes:
        for ending in ("", *COMPRESSED):
            kept = kept | F.endswith("object_path", F.lit(suffix + ending))
    done = manifest.select(F.col("path").alias("object_path"), F.lit(True).alias("_done")).distinct()
    status = label(
        [
            (F.col("_done"), "loaded"),
            (
                (F.col("feed") == POPULAR_SLIM) & F.col("snapshot_date").isNull(),
                "no snapshot date",
            ),
        ],
        "pending",
    )
    return (
        routed.where(F.col("feed").isNotNull() & kept)
        .join(done, "object_path", "left")
        .withColumn("status", status)
        .drop("_done")
    )


def status_counts(status: DataFrame) -> DataFrame:
    return status.groupBy("feed", "status").agg(n_rows().alias("files"))
