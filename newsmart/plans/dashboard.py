"""Dashboard views: one shared filter, applied to facts and to flattened rows alike."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsmart.functions.exprs import month_start, n_rows
from newsmart.operators.flatten import authors_flattened, keywords_flattened, known_values
from newsmart.operators.indexes import AUTHOR, KEYWORD, Postings
from newsmart.operators.results import ResultStore
from newsmart.operators.tables import current
from newsmart.plans.explore import mean
from newsmart.session import shared_dir


@dataclass(frozen=True)
class ArticleFilter:
    """What a reader picked; an empty field filters nothing."""

    start: dt.date | None = None
    end: dt.date | None = None
    sections: tuple[str, ...] = ()
    desks: tuple[str, ...] = ()
    materials: tuple[str, ...] = ()
    authors: tuple[str, ...] = ()
    keywords: tuple[str, ...] = ()


def default_articles(articles: DataFrame, as_of: dt.date, years: int = 100) -> DataFrame:
    """Articles with words, published in the ``years`` up to ``as_of``."""
    oldest = F.add_months(F.lit(as_of), -12 * years)
    return articles.where(
        F.col("pub_date").between(oldest, F.lit(as_of)) & (F.col("word_count") != 0)
    )


def by_dimensions(articles: DataFrame, chosen: ArticleFilter) -> DataFrame:
    """Date range, sections, desks and materials; all of them reach the scan."""
    if chosen.start:
        articles = articles.where(F.col("pub_date") >= F.lit(chosen.start))
    if chosen.end:
        articles = articles.where(F.col("pub_date") <= F.lit(chosen.end))
    for column, values in (
        ("section_name", chosen.sections),
        ("news_desk", chosen.desks),
        ("type_of_material", chosen.materials),
    ):
        if values:
            articles = articles.where(F.col(column).isin(list(values)))
    return articles


def by_people_and_topics(
    articles: DataFrame, stg: DataFrame, chosen: ArticleFilter, index: Postings | None = None
) -> DataFrame:
    """Articles that have one of the chosen authors and one of the chosen keywords.

    With ``index`` these are looked up, and the staging rows are not unnested."""
    if index:
        for kind, terms in ((AUTHOR, chosen.authors), (KEYWORD, chosen.keywords)):
            if terms:
                articles = articles.join(index.articles(kind, list(terms)), "article_id", "left_semi")
        return articles
    if chosen.authors:
        named = authors_flattened(stg, qualifier=False).where(
            F.col("author_full_name").isin(list(chosen.authors))
        )
        articles = articles.join(named.select("article_id").distinct(), "article_id", "left_semi")
    if chosen.keywords:
        tagged = keywords_flattened(stg, fields=["value"]).where(
            F.col("keyword_value").isin(list(chosen.keywords))
        )
        articles = articles.join(tagged.select("article_id").distinct(), "article_id", "left_semi")
    return articles


def filtered(
    articles: DataFrame, stg: DataFrame, chosen: ArticleFilter, as_of: dt.date, index: Postings | None = None
) -> DataFrame:
    """Default exclusion and all chosen filters. ``articles`` is the fact or the staging rows."""
    articles = by_dimensions(default_articles(articles, as_of), chosen)
    return by_people_and_topics(articles, stg, chosen, index)


def articles_by_month(articles: DataFrame) -> DataFrame:
    return (
        articles.groupBy(month_start("pub_date").alias("pub_month"))
        .agg(n_rows().alias("total_articles"), mean("word_count", 0).alias("avg_word_count"))
        .orderBy("pub_month")
    )


def breakdown(articles: DataFrame) -> DataFrame:
    """Articles by section, by desk and by material in long form, from one pass."""
    kinds = F.array(
        *[
            F.struct(F.lit(c).alias("dimension"), F.col(c).alias("member"))
            for c in ("section_name", "news_desk", "type_of_material")
        ]
    )
    return (
        articles.select(F.explode(kinds).alias("d"))
        .groupBy("d.dimension", "d.member")
        .agg(n_rows().alias("article_count"))
        .orderBy("dimension", F.desc("article_count"), "member")
    )


def top_keywords(staged: DataFrame, n: int = 10) -> DataFrame:
    """Keywords of the filtered staging rows by distinct articles."""
    return (
        known_values(keywords_flattened(staged, fields=["value"]))
        .groupBy("keyword_value")
        .agg(F.countDistinct("article_id").alias("article_count"))
        .orderBy(F.desc("article_count"), "keyword_value")
        .limit(n)
    )


def top_authors(staged: DataFrame, n: int = 10) -> DataFrame:
    """Authors of the filtered staging rows by distinct articles."""
    return (
        authors_flattened(staged, qualifier=False)
        .groupBy("author_full_name")
        .agg(F.countDistinct("article_id").alias("article_count"))
        .orderBy(F.desc("article_count"), "author_full_name")
        .limit(n)
    )


def cached_breakdown(
    store: ResultStore, fct: str, stg: Callable[[], DataFrame], chosen: ArticleFilter, as_of: dt.date, sources: Sequence[str], now: float | None = None
) -> tuple[DataFrame, bool]:
    """The breakdown of the filtered fact table, made once an hour as long as its sources stay as they are."""
    spark = store.spark

    def make() -> DataFrame:
        return breakdown(filtered(current(spark, fct), stg(), chosen, as_of))

    return store.get("breakdown", {**asdict(chosen), "as_of": as_of}, [fct, *sources], make, now)


def kept(result: DataFrame) -> DataFrame:
    """A result that several views read again, as a table in the shared folder.

    It does not hang on the executors that made it. The caller removes its folder when its time is over.
    """
    path = f"{shared_dir(result.sparkSession)}/newsmart/kept/{uuid.uuid4().hex[:12]}"
    result.write.parquet(path)
    return result.sparkSession.read.schema(result.schema).parquet(path)
