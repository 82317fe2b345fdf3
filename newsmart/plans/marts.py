"""Trend marts by month, author, section and keyword."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsmart.functions.exprs import (
    growth_pct,
    month_start,
    n_rows,
    pct,
    ratio,
    surrogate_key,
)
from newsmart.functions.ranking import spread_row_number
from newsmart.operators.flatten import authors_flattened, known_values



def _mean(total: str, rows: str) -> Column:
    return ratio(F.col(total), F.col(rows))


def agg_articles_by_month(fct: DataFrame) -> DataFrame:
    """Volume, length, richness and diversity per publication month.

    Rows are first summed per (month, section, desk, material), so the distinct counts of the second
    step see only those combinations and a crowded month is spread over many tasks.
    """
    return months_from_combinations(month_combinations(fct))


def month_combinations(fct: DataFrame) -> DataFrame:
    """Sums per month, section, desk and material. Those of several sets of rows can be put together."""
    return fct.groupBy(
        month_start("pub_date").alias("pub_month"), "section_name", "news_desk", "type_of_material"
    ).agg(
        n_rows().alias("n"),
        F.sum("word_count").alias("words"),
        F.max("word_count").alias("longest"),
        F.count_if("has_authors").alias("with_authors"),
        F.count_if("has_keywords").alias("with_keywords"),
        F.count_if("has_multimedia").alias("with_multimedia"),
        F.sum("author_count").alias("authors"),
        F.sum("keyword_count").alias("keywords"),
    )


def months_from_combinations(combos: DataFrame) -> DataFrame:
    """The months' rows; a combination may come several times, each for other articles."""
    months = combos.groupBy("pub_month").agg(
        F.sum("n").alias("total_articles"),
        F.sum("words").alias("total_word_count"),
        F.max("longest").alias("max_word_count"),
        F.sum("with_authors").alias("articles_with_authors"),
        F.sum("with_keywords").alias("articles_with_keywords"),
        F.sum("with_multimedia").alias("articles_with_multimedia"),
        F.sum("authors").alias("authors"),
        F.sum("keywords").alias("keywords"),
        F.countDistinct("section_name").alias("unique_sections"),
        F.countDistinct("news_desk").alias("unique_news_desks"),
        F.countDistinct("type_of_material").alias("unique_material_types"),
    )
    total = F.col("total_articles")
    return months.select(
        "pub_month",
        "total_articles",
        F.round(_mean("total_word_count", "total_articles"), 0).alias("avg_word_count"),
        "total_word_count",
        "max_word_count",
        "articles_with_authors",
        "articles_with_keywords",
        "articles_with_multimedia",
        F.round(_mean("authors", "total_articles"), 2).alias("avg_authors_per_article"),
        F.round(_mean("keywords", "total_articles"), 2).alias("avg_keywords_per_article"),
        "unique_sections",
        "unique_news_desks",
        "unique_material_types",
        pct(F.col("articles_with_authors"), total, 1).alias("pct_with_authors"),
        pct(F.col("articles_with_keywords"), total, 1).alias("pct_with_keywords"),
        pct(F.col("articles_with_multimedia"), total, 1).alias("pct_with_multimedia"),
    )


def _author_rows(stg: DataFrame, fct: DataFrame, unique_ids: bool) -> DataFrame:
    """Author rows with the article's fact rows folded in: how many, their words and keywords."""
    if unique_ids:
        return authors_flattened(
            stg.withColumn("keyword_count", F.array_size("keywords.rank").cast("bigint")),
            carry=("word_count", "keyword_count"),
            qualifier=False,
        ).select(
            "*",
            F.lit(1).cast("bigint").alias("n"),
            F.col("word_count").alias("words"),
            F.col("word_count").alias("longest"),
            F.coalesce("keyword_count", F.lit(0).cast("bigint")).alias("keywords"),
        )
    per_id = fct.groupBy("article_id").agg(
        n_rows().alias("n"),
        F.sum("word_count").alias("words"),
        F.max("word_count").alias("longest"),
        F.sum("keyword_count").alias("keywords"),
    )
    return authors_flattened(stg, qualifier=False).join(per_id, "article_id")


def agg_author_performance(
    stg: DataFrame, fct: DataFrame, unique_ids: bool = False
) -> DataFrame:
    """Career metrics per author (full, first and last name).

    A person listed twice on an article doubles its words but not its article count. An id repeated
    in the fact counts once per fact row in sums and averages, as a join on the id would give; the
    fact is summed per id before the join, so no pairs are formed. With ``unique_ids`` there is no
    join at all.
    """
    author = ["author_full_name", "firstname", "lastname"]
    # Per author and article first: a distinct count of articles becomes a count, and an author with
    # very many rows is spread over the tasks. Years and sections of an author are small sets.
    articles = (
        _author_rows(stg, fct, unique_ids)
        .groupBy(*author, "article_id")
        .agg(
            F.min("pub_date").alias("first_date"),
            F.max("pub_date").alias("last_date"),
            F.collect_set("pub_year").alias("years"),
            F.collect_set("section_name").alias("sections"),
            F.sum("n").alias("n"),
            F.sum("words").alias("words"),
            F.max("longest").alias("longest"),
            F.sum("keywords").alias("keywords"),
        )
    )
    years = F.array_distinct(F.flatten(F.collect_set("years")))
    careers = articles.groupBy(*author).agg(
        F.count("article_id").alias("total_articles"),
        F.min("first_date").alias("first_article_date"),
        F.max("last_date").alias("last_article_date"),
        F.size(years).cast("bigint").alias("years_active"),
        F.array_min(years).alias("first_year"),
        F.array_max(years).alias("last_year"),
        F.sum("n").alias("n"),
        F.sum("words").alias("total_words_written"),
        F.max("longest").alias("longest_article_words"),
        F.size(F.array_distinct(F.flatten(F.collect_set("sections")))).cast("bigint").alias(
            "sections_written_for"
        ),
        F.sum("keywords").alias("keywords"),
    )
    return careers.select(
        "author_full_name",
        "firstname",
        "lastname",
        "total_articles",
        "first_article_date",
        "last_article_date",
        F.datediff("last_article_date", "first_article_date").alias("career_span_days"),
        "years_active",
        "first_year",
        "last_year",
        F.round(_mean("total_words_written", "n"), 0).alias("avg_word_count"),
        "total_words_written",
        "longest_article_words",
        "sections_written_for",
        F.round(_mean("keywords", "n"), 1).alias("avg_keywords_per_article"),
        F.round(_mean("total_articles", "years_active"), 1).alias("articles_per_year"),
    )


def agg_section_trends(fct: DataFrame) -> DataFrame:
    """Yearly volume per section and desk, share of the year, change on the previous present year.

    Both windows run on the aggregated rows: one per (section, desk) in a year, or one per year.
    """
    yearly = fct.groupBy("section_name", "news_desk", "pub_year").agg(
        n_rows().alias("article_count"),
        F.avg("word_count").alias("words"),
        F.sum("word_count").alias("total_word_count"),
        F.count_if("has_authors").alias("articles_with_authors"),
        F.count_if("has_keywords").alias("articles_with_keywords"),
        F.avg("author_count").alias("authors"),
        F.avg("keyword_count").alias("keywords"),
    )
    count, before = F.col("article_count"), F.col("prior_year_count")
    history = Window.partitionBy("section_name", "news_desk").orderBy("pub_year")
    # Rows without a date share one null year; like an equi-join on the year, it has no total.
    in_year = F.sum("article_count").over(Window.partitionBy("pub_year"))
    return (
        yearly.withColumn("year_total", F.when(F.col("pub_year").isNotNull(), in_year))
        .withColumn("prior_year_count", F.lag("article_count").over(history))
        .select(
            "section_name",
            "news_desk",
            "pub_year",
            "article_count",
            "year_total",
            pct(count, F.col("year_total"), 2).alias("pct_of_year_total"),
            F.round("words", 0).alias("avg_word_count"),
            "total_word_count",
            "articles_with_authors",
            "articles_with_keywords",
            F.round("authors", 2).alias("avg_authors"),
            F.round("keywords", 2).alias("avg_keywords"),
            "prior_year_count",
            (count - F.coalesce(before, F.lit(0))).alias("yoy_change"),
            growth_pct(count, before).alias("yoy_change_pct"),
        )
    )


def keyword_year_stats(keywords: DataFrame) -> DataFrame:
    """Distinct articles and occurrences per keyword and year, blank values left out.

    Occurrences are summed per (keyword, year, article) first, which spreads a hot keyword over the
    tasks; the second step then counts articles without a distinct.
    """
    return stats_from_articles(keyword_articles(keywords))


def keyword_articles(keywords: DataFrame) -> DataFrame:
    """Occurrences (n) per keyword, year and article."""
    return known_values(keywords).groupBy(
        "keyword_name", "keyword_value", "pub_year", "article_id"
    ).agg(n_rows().alias("n"))


def stats_from_articles(per_article: DataFrame) -> DataFrame:
    """Articles and occurrences per keyword and year; an article stands there once in a year."""
    return per_article.groupBy("keyword_name", "keyword_value", "pub_year").agg(
        F.count("article_id").alias("article_count"), F.sum("n").alias("keyword_occurrences")
    )


def keyword_trends_from_stats(stats: DataFrame) -> DataFrame:
    """Rank within the year and change on the keyword's previous present year.

    Equal counts are ranked by the keyword's surrogate key. ``stats`` is read twice: pass a saved
    table when it is large.
    """
    return keyword_changes(ranked_keywords(stats))


def ranked_keywords(stats: DataFrame) -> DataFrame:
    """Rank within the year; a year's ranks depend on that year's rows alone."""
    keyed = stats.withColumn("_key", surrogate_key("keyword_name", "keyword_value"))
    return spread_row_number(keyed, "pub_year", "article_count", "_key", "rank_in_year").drop("_key")


def keyword_changes(ranked: DataFrame) -> DataFrame:
    """Each row beside the keyword's previous present year."""
    history = Window.partitionBy("keyword_name", "keyword_value").orderBy("pub_year")
    count, before = F.col("article_count"), F.col("prior_year_count")
    rank, rank_before = F.col("rank_in_year"), F.col("prior_year_rank")
    return (
        ranked.withColumn("prior_year_count", F.lag("article_count").over(history))
        .withColumn("prior_year_rank", F.lag("rank_in_year").over(history))
        .select(
            "keyword_name",
            "keyword_value",
            "pub_year",
            "article_count",
            "keyword_occurrences",
            "rank_in_year",
            "prior_year_count",
            (count - F.coalesce(before, F.lit(0))).alias("yoy_change"),
            growth_pct(count, before).alias("yoy_change_pct"),
            "prior_year_rank",
            (F.coalesce(rank_before, F.lit(0)) - rank).alias("rank_change"),
        )
    )


def agg_keyword_trends(keywords: DataFrame) -> DataFrame:
    """Both steps in one plan, for small inputs."""
    return keyword_trends_from_stats(keyword_year_stats(keywords))
