"""Cleaned staging projections. Row-local: no shuffle, filters and columns reach the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsmart.functions.exprs import clean_dim, len0, trim_ws


def stg_archive_articles(source: DataFrame) -> DataFrame:
    """Archive articles with an id: cleaned dimensions, zero for a missing word count, has_ flags."""
    return source.where(F.col("article_id").isNotNull()).select(
        "article_id",
        "uri",
        "pub_date",
        F.year("pub_date").alias("pub_year"),
        F.month("pub_date").alias("pub_month"),
        *[
            clean_dim(c).alias(c)
            for c in ("section_name", "news_desk", "type_of_material", "document_type")
        ],
        F.coalesce("word_count", F.lit(0).cast("bigint")).alias("word_count"),
        "web_url",
        *[trim_ws(c).alias(c) for c in ("headline_main", "byline_original", "abstract", "snippet")],
        "keywords",
        "byline_person",
        "multimedia_count_by_type",
        # One field of the struct tells the length; a scan then need not read the others.
        (len0("keywords.major") > 0).alias("has_keywords"),
        (len0("byline_person.lastname") > 0).alias("has_authors"),
        F.col("multimedia_count_by_type").isNotNull().alias("has_multimedia"),
    )


def stg_most_popular_articles(source: DataFrame) -> DataFrame:
    """Popularity snapshots with an id: dates parsed (bad text becomes null), dimensions cleaned."""
    return source.where(F.col("id").isNotNull()).select(
        "snapshot_date",
        F.col("id").alias("article_id"),
        "uri",
        "asset_id",
        F.try_to_date("published_date", "yyyy-M-d").alias("published_date"),
        F.try_to_timestamp("updated", F.lit("yyyy-M-d H:m:s")).alias("updated_at"),
        clean_dim("source").alias("source"),
        clean_dim("section").alias("section"),
        clean_dim("subsection").alias("subsection"),
        clean_dim("type").alias("article_type"),
        *[trim_ws(c).alias(c) for c in ("title", "abstract", "byline")],
        "url",
        "des_facet",
        "org_facet",
        "per_facet",
        "geo_facet",
        "media_count_by_type",
        "adx_keywords",
    )
