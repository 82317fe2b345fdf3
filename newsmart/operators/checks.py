"""Data checks. A check is a query whose rows are the violations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique_violations(df: DataFrame, column: str) -> DataFrame:
    """Present values that occur more than once."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def null_violations(df: DataFrame, column: str) -> DataFrame:
    """Rows without a value."""
    return df.where(F.col(column).isNull())


def empty_violations(source: DataFrame) -> DataFrame:
    """One row when the source holds nothing."""
    return source.agg(F.count(F.lit(1)).alias("total_rows")).where(F.col("total_rows") == 0)


def grain_violations(source: DataFrame, staged: DataFrame) -> DataFrame:
    """One row when staging does not have as many rows as its source.

    Staging drops rows without an id, so a source that holds such rows is reported.
    """
    staged_rows = staged.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    return (
        source.agg(F.count(F.lit(1)).alias("source_rows"))
        .withColumn("staging_rows", staged_rows)
        .withColumn("difference", F.col("source_rows") - F.col("staging_rows"))
        .where(F.col("difference") != 0)
    )


# (table, column) pairs that must be unique, and those that must not be null.
UNIQUE = (
    ("stg_archive_articles", "article_id"),
    ("fct_articles", "article_id"),
    ("dim_authors", "author_key"),
    ("dim_keywords", "keyword_key"),
    ("dim_sections", "section_key"),
    ("agg_articles_by_month", "pub_month"),
    ("agg_author_performance", "author_full_name"),
)
NOT_NULL = (
    ("stg_archive_articles", "article_id"),
    ("stg_archive_articles", "pub_date"),
    ("stg_most_popular_articles", "snapshot_date"),
    ("stg_most_popular_articles", "article_id"),
    ("fct_articles", "article_id"),
    ("fct_articles", "pub_date"),
    ("fct_article_popularity", "snapshot_date"),
    ("fct_article_popularity", "article_id"),
    ("dim_authors", "author_key"),
    ("dim_keywords", "keyword_key"),
    ("dim_sections", "section_key"),
    ("agg_articles_by_month", "pub_month"),
    ("agg_author_performance", "author_full_name"),
)


def check_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Number of violations of every declared check on the given tables.

    All columns of a table that must not be null are counted in one pass.
    """
    parts = []
    for table, df in tables.items():
        required = [column for name, column in NOT_NULL if name == table]
        if required:
            counts = F.array(
                *[
                    F.struct(
                        F.lit("not_null").alias("check_kind"),
                        F.lit(table).alias("table_name"),
                        F.lit(column).alias("column_name"),
                        F.count_if(F.col(column).isNull()).alias("violations"),
                    )
                    for column in required
                ]
            )
            parts.append(df.agg(counts.alias("c")).select(F.inline("c")))
        for name, column in UNIQUE:
            if name == table:
                parts.append(
                    unique_violations(df, column).agg(
                        F.lit("unique").alias("check_kind"),
                        F.lit(table).alias("table_name"),
                        F.lit(column).alias("column_name"),
                        F.count(F.lit(1)).alias("violations"),
                    )
                )
    if not parts:
        raise ValueError("none of the declared tables was given")
    return reduce(DataFrame.unionByName, parts)
