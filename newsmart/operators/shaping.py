"""Raw docs to slim records to typed rows, with the records that do not fit set apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsmart import schemas
from newsmart.functions.exprs import coerce_long, label, n_rows, not_integer, parse_day
from newsmart.schemas import CORRUPT

REASON = "reject_reason"


def counts_by_type(items: Column) -> Column:
    """Number of items per non-empty type; null when there is none."""
    types = F.filter(
        F.transform(items, lambda m: m["type"]), lambda t: F.coalesce(t != "", F.lit(False))
    )
    kinds = F.array_distinct(types)
    numbers = F.transform(
        kinds, lambda k: F.size(F.filter(types, lambda t: t == k)).cast("bigint")
    )
    return F.when(F.size(kinds) > 0, F.map_from_arrays(kinds, numbers))


def _or_empty(c: Column, kind: str) -> Column:
    return F.coalesce(c, F.array().cast(kind))


def _passed(df: DataFrame) -> list[str]:
    """Columns that come from the file rather than the record."""
    return [c for c in (CORRUPT, "file_path", "year", "month", "snapshot_date") if c in df.columns]


def slim_articles(docs: DataFrame) -> DataFrame:
    """The sixteen slim fields of raw archive docs; integers are still text."""
    fields = {
        "article_id": F.col("_id"),
        "headline_main": F.col("headline.main"),
        "byline_original": F.col("byline.original"),
        "keywords": _or_empty(F.col("keywords"), schemas.KEYWORDS_TEXT),
        "byline_person": _or_empty(F.col("byline.person"), schemas.PERSONS),
        "multimedia_count_by_type": counts_by_type(F.col("multimedia")),
    }
    return docs.select(
        *[fields.get(name, F.col(name)).alias(name) for name in schemas.SLIM_ARCHIVE],
        *_passed(docs),
    )


def slim_popular(docs: DataFrame) -> DataFrame:
    """The nineteen slim fields of raw popularity results; integers are still text."""
    fields = {
        name: _or_empty(F.col(name), schemas.TEXTS)
        for name in ("des_facet", "org_facet", "per_facet", "geo_facet")
    }
    fields["media_count_by_type"] = counts_by_type(F.col("media"))
    return docs.select(
        *[fields.get(name, F.col(name)).alias(name) for name in schemas.SLIM_POPULAR],
        *_passed(docs),
    )


def _with_reason(slim: DataFrame, rules: list[tuple[Column, str]]) -> DataFrame:
    if CORRUPT in slim.columns:
        rules = [(F.col(CORRUPT).isNotNull(), "malformed json"), *rules]
    return slim.withColumn(REASON, label(rules))


def checked_articles(slim: DataFrame) -> DataFrame:
    """Slim articles with the reason they are rejected for, null when they are fine."""
    bad_rank = F.exists("keywords", lambda k: not_integer(k["rank"]))
    return _with_reason(
        slim,
        [
            (not_integer(F.col("word_count")), "word_count is not an integer"),
            (bad_rank, "keyword rank is not an integer"),
        ],
    )


def checked_popular(slim: DataFrame) -> DataFrame:
    """Slim popularity records with the reason they are rejected for."""
    return _with_reason(
        slim,
        [(not_integer(F.col(c)), f"{c} is not an integer") for c in ("id", "asset_id")],
    )


def rejected(checked: DataFrame) -> DataFrame:
    return checked.where(F.col(REASON).isNotNull())


def reject_counts(checked: DataFrame) -> DataFrame:
    """Records per file: all and rejected."""
    return checked.groupBy("file_path").agg(
        n_rows().alias("records"), F.count(REASON).alias("rejected")
    )


def accepted_articles(checked: DataFrame) -> DataFrame:
    """Articles that passed, integers typed; the publication date stays text."""
    ranked = F.transform(
        "keywords",
        lambda k: F.struct(
            k["name"].alias("name"),
            k["value"].alias("value"),
            coerce_long(k["rank"]).alias("rank"),
            k["major"].alias("major"),
        ),
    )
    return checked.where(F.col(REASON).isNull()).withColumns(
        {"word_count": coerce_long(F.col("word_count")), "keywords": ranked}
    )


def accepted_popular(checked: DataFrame) -> DataFrame:
    """Popularity records that passed, integers typed."""
    return checked.where(F.col(REASON).isNull()).withColumns(
        {c: coerce_long(F.col(c)) for c in ("id", "asset_id")}
    )


def archive_rows(accepted: DataFrame) -> DataFrame:
    """Rows of the archive table: the first ten characters of the publication date as a date."""
    return accepted.withColumn("pub_date", parse_day(F.col("pub_date"))).select(
        *schemas.ARCHIVE_ARTICLES
    )


def popular_rows(accepted: DataFrame) -> DataFrame:
    """Rows of the popularity table; the snapshot date comes from the file's path."""
    return accepted.select(*schemas.POPULAR_ARTICLES)
