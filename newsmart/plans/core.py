"""Facts and dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsmart.functions.exprs import len0, surrogate_key, trim_ws
from newsmart.operators.flatten import authors_flattened, keywords_flattened, known_values

FACT_COLUMNS = (
    "article_id uri pub_date pub_year pub_month section_name news_desk type_of_material "
    "document_type word_count author_count keyword_count major_keyword_count headline_main "
    "byline_original abstract web_url has_keywords has_authors has_multimedia"
).split()

COUNTS = ("author_count", "keyword_count", "major_keyword_count")


def _own_counts(stg: DataFrame) -> DataFrame:
    """Counts of each row's own arrays, from the struct fields that decide them."""
    names = F.arrays_zip("byline_person.firstname", "byline_person.lastname")
    named = F.filter(names, lambda p: p["firstname"].isNotNull() | p["lastname"].isNotNull())
    major = F.filter("keywords.major", lambda m: m == "Y")
    return stg.withColumns(
        {
            "author_count": len0(named).cast("bigint"),
            "keyword_count": len0("keywords.major").cast("bigint"),
            "major_keyword_count": len0(major).cast("bigint"),
        }
    )


def fct_articles(stg: DataFrame, unique_ids: bool = False) -> DataFrame:
    """Article fact: staging columns with author, keyword and major-keyword counts.

    Counts belong to the article id, so rows that repeat an id all carry the sum over that id. With
    ``unique_ids`` the caller states that no id repeats (see ``checks.unique_violations``); the
    counts are then read from each row and the plan has no shuffle. Otherwise narrow per-row counts
    are summed per id, with partial aggregation, and joined back.
    """
    counted = _own_counts(stg)
    if not unique_ids:
        per_id = counted.groupBy("article_id").agg(*[F.sum(c).alias(c) for c in COUNTS])
        counted = stg.join(per_id, "article_id", "left")
    return counted.select(*FACT_COLUMNS)


def fct_article_popularity(stg: DataFrame) -> DataFrame:
    """Popularity fact: age in days at the snapshot and facet counts."""
    return stg.select(
        "snapshot_date",
        "article_id",
        "uri",
        "asset_id",
        "published_date",
        "updated_at",
        F.datediff("snapshot_date", "published_date").alias("days_since_published"),
        "source",
        "section",
        "subsection",
        "article_type",
        "title",
        "abstract",
        "byline",
        "url",
        len0("des_facet").alias("description_facet_count"),
        len0("org_facet").alias("organization_facet_count"),
        len0("per_facet").alias("person_facet_count"),
        len0("geo_facet").alias("geo_facet_count"),
        "des_facet",
        "org_facet",
        "per_facet",
        "geo_facet",
        "adx_keywords",
    )


def _dimension(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    return rows.select(*columns).distinct().select(surrogate_key(*columns).alias(key), *columns)


def dim_authors(stg: DataFrame) -> DataFrame:
    """Distinct named authors with a surrogate key."""
    named = authors_flattened(stg).where(trim_ws("author_full_name") != "")
    columns = ["firstname", "middlename", "lastname", "qualifier", "author_full_name"]
    return _dimension(named, "author_key", columns)


def dim_keywords(stg: DataFrame) -> DataFrame:
    """Distinct keyword (name, value) pairs with a surrogate key."""
    keywords = known_values(keywords_flattened(stg, fields=("name", "value")))
    return _dimension(keywords, "keyword_key", ["keyword_name", "keyword_value"])


def dim_sections(stg: DataFrame) -> DataFrame:
    """Distinct (section, desk) pairs with a surrogate key."""
    return _dimension(stg, "section_key", ["section_name", "news_desk"])
