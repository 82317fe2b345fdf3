"""Unnesting of repeated columns: one row per keyword, author or facet.

The explodes are inner, so articles without entries drop out by themselves. Struct fields are picked
before the explode and no filter touches the whole array, so a scan reads only the fields in use.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsmart.functions.exprs import full_name, trim_ws

ARTICLE_COLUMNS = ("article_id", "pub_date", "pub_year", "section_name")
FACETS = ("des_facet", "geo_facet", "per_facet", "org_facet")


def _entries(array: str, fields: Sequence[str]) -> Column:
    return F.explode(F.arrays_zip(*[F.col(f"{array}.{f}").alias(f) for f in fields]))


KEYWORD_FIELDS = ("name", "value", "rank", "major")
NAME_FIELDS = ("firstname", "middlename", "lastname")


def keywords_flattened(
    stg: DataFrame, carry: Sequence[str] = (), fields: Sequence[str] = KEYWORD_FIELDS
) -> DataFrame:
    """One row per article and keyword, null values kept.

    ``carry`` adds article columns; ``fields`` says which keyword fields are needed.
    """
    return stg.select(*ARTICLE_COLUMNS, *carry, _entries("keywords", fields).alias("k")).select(
        *ARTICLE_COLUMNS, *carry, *[F.col("k")[f].alias(f"keyword_{f}") for f in fields]
    )


def authors_flattened(
    stg: DataFrame, carry: Sequence[str] = (), qualifier: bool = True
) -> DataFrame:
    """One row per article and person with a first or last name. ``carry`` adds article columns."""
    fields = (*NAME_FIELDS, "qualifier") if qualifier else NAME_FIELDS
    p = F.col("p")
    return (
        stg.select(*ARTICLE_COLUMNS, *carry, _entries("byline_person", fields).alias("p"))
        .where(p["firstname"].isNotNull() | p["lastname"].isNotNull())
        .select(
            *ARTICLE_COLUMNS,
            *carry,
            *[p[f].alias(f) for f in fields],
            full_name(p["firstname"], p["middlename"], p["lastname"]).alias("author_full_name"),
        )
    )


def facets_flattened(popularity: DataFrame, facets: Sequence[str] = FACETS) -> DataFrame:
    """One row per snapshot, article, facet kind and facet value, in one pass over the rows."""
    tagged = F.array(
        *[F.struct(F.lit(f).alias("kind"), F.col(f).alias("items")) for f in facets]
    )
    return (
        popularity.select("snapshot_date", "article_id", F.explode(tagged).alias("f"))
        .select(
            "snapshot_date",
            "article_id",
            F.col("f.kind").alias("facet_type"),
            F.explode("f.items").alias("facet_value"),
        )
    )


def known_values(keywords: DataFrame) -> DataFrame:
    """Keyword rows whose value is neither null nor blank."""
    return keywords.where(trim_ws("keyword_value") != "")
