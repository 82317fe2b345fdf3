"""Exploratory queries over the facts and marts.

Every function takes DataFrames and returns one. Queries about "today" take ``as_of``. Ties in a
top list are broken by the listed key columns, so results repeat.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsmart.functions.exprs import decade, label, n_rows, pct, ratio



def mean(c: str, digits: int) -> Column:
    return F.round(F.avg(c), digits)


def years_before(as_of: dt.date, years: int) -> Column:
    """The day ``years`` earlier; month ends clamp."""
    return F.add_months(F.lit(as_of), -12 * years)


# --- profile -------------------------------------------------------------------------------------


def archive_profile(fct: DataFrame) -> DataFrame:
    """One row: size, date range, diversity and averages of the article fact."""
    return fct.agg(
        F.lit("fct_articles").alias("table_name"),
        n_rows().alias("total_records"),
        F.min("pub_date").alias("earliest_date"),
        F.max("pub_date").alias("latest_date"),
        F.countDistinct("section_name").alias("unique_sections"),
        F.countDistinct("news_desk").alias("unique_desks"),
        mean("word_count", 0).alias("avg_word_count"),
        mean("author_count", 2).alias("avg_author_count"),
        mean("keyword_count", 2).alias("avg_keyword_count"),
    )


def popularity_profile(pop: DataFrame) -> DataFrame:
    """One row: size, snapshot range, distinct articles and mean age of the popularity fact."""
    return pop.agg(
        F.lit("fct_article_popularity").alias("table_name"),
        n_rows().alias("total_records"),
        F.min("snapshot_date").alias("earliest_snapshot"),
        F.max("snapshot_date").alias("latest_snapshot"),
        F.countDistinct("article_id").alias("unique_articles"),
        mean("days_since_published", 1).alias("avg_days_since_published"),
    )


# --- content over time ---------------------------------------------------------------------------


def articles_per_year(fct: DataFrame, n: int = 50) -> DataFrame:
    return (
        fct.groupBy("pub_year")
        .agg(
            n_rows().alias("article_count"),
            mean("word_count", 0).alias("avg_word_count"),
            F.countDistinct("section_name").alias("sections_active"),
        )
        .orderBy(F.desc("pub_year"))
        .limit(n)
    )


def monthly_trend(months: DataFrame, as_of: dt.date, years: int = 5) -> DataFrame:
    return (
        months.where(F.col("pub_month") >= years_before(as_of, years))
        .select(
            "pub_month",
            "total_articles",
            "avg_word_count",
            "pct_with_authors",
            "pct_with_keywords",
            "pct_with_multimedia",
            "unique_sections",
        )
        .orderBy(F.desc("pub_month"))
    )


def busiest_months(months: DataFrame, n: int = 20) -> DataFrame:
    return (
        months.select(
            "pub_month",
            "total_articles",
            "avg_word_count",
            "unique_sections",
            F.year("pub_month").alias("year"),
            F.month("pub_month").alias("month"),
        )
        .orderBy(F.desc("total_articles"), "pub_month")
        .limit(n)
    )


def word_count_by_decade(fct: DataFrame) -> DataFrame:
    return (
        fct.groupBy(decade("pub_year").alias("decade"))
        .agg(
            n_rows().alias("article_count"),
            mean("word_count", 0).alias("avg_word_count"),
            F.round(F.stddev_samp("word_count"), 0).alias("stddev_word_count"),
            F.min("word_count").alias("min_word_count"),
            F.max("word_count").alias("max_word_count"),
        )
        .orderBy("decade")
    )


# --- sections and desks --------------------------------------------------------------------------


def top_sections(fct: DataFrame, n: int = 30) -> DataFrame:
    return (
        fct.groupBy("section_name")
        .agg(
            n_rows().alias("article_count"),
            mean("word_count", 0).alias("avg_word_count"),
            F.countDistinct("pub_year").alias("years_active"),
            F.min("pub_date").alias("first_article"),
            F.max("pub_date").alias("last_article"),
        )
        .orderBy(F.desc("article_count"), "section_name")
        .limit(n)
    )


def section_growth(sections: DataFrame, as_of: dt.date, n: int = 30) -> DataFrame:
    """Sections of the last full year by growth; rows without a prior year come last."""
    return (
        sections.where(F.col("pub_year") == as_of.year - 1)
        .select(
            "section_name",
            "news_desk",
            "pub_year",
            "article_count",
            "prior_year_count",
            "yoy_change",
            "yoy_change_pct",
            "pct_of_year_total",
        )
        .orderBy(F.desc_nulls_last("yoy_change_pct"), "section_name", "news_desk")
        .limit(n)
        .drop("news_desk")
    )


def sections_by_decade(sections: DataFrame, more_than: int = 1000) -> DataFrame:
    """Section volume per decade; the average is taken over the rounded yearly averages."""
    return (
        sections.groupBy(decade("pub_year").alias("decade"), "section_name")
        .agg(
            F.sum("article_count").alias("total_articles"),
            mean("avg_word_count", 0).alias("avg_word_count"),
        )
        .where(F.col("total_articles") > more_than)
        .orderBy(F.desc("decade"), F.desc("total_articles"), "section_name")
    )


def news_desks(fct: DataFrame, n: int = 30) -> DataFrame:
    return (
        fct.groupBy("news_desk")
        .agg(
            n_rows().alias("article_count"),
            F.countDistinct("section_name").alias("sections_covered"),
            mean("word_count", 0).alias("avg_word_count"),
            F.min("pub_date").alias("first_article"),
            F.max("pub_date").alias("last_article"),
        )
        .orderBy(F.desc("article_count"), "news_desk")
        .limit(n)
    )


# --- keywords ------------------------------------------------------------------------------------


def top_keywords(trends: DataFrame, n: int = 50) -> DataFrame:
    return (
        trends.groupBy("keyword_value", "keyword_name")
        .agg(
            F.sum("article_count").alias("total_articles"),
            F.min("pub_year").alias("first_appeared"),
            F.max("pub_year").alias("last_appeared"),
            F.countDistinct("pub_year").alias("years_active"),
        )
        .orderBy(F.desc("total_articles"), "keyword_value", "keyword_name")
        .limit(n)
    )


def recent_keywords(
    trends: DataFrame, as_of: dt.date, years: int = 5, n: int = 50
) -> DataFrame:
    return (
        trends.where(F.col("pub_year") >= as_of.year - years)
        .groupBy("keyword_value", "keyword_name")
        .agg(
            F.sum("article_count").alias("total_articles"),
            F.avg("article_count").alias("avg_articles_per_year"),
        )
        .orderBy(F.desc("total_articles"), "keyword_value", "keyword_name")
        .limit(n)
    )


def fastest_keywords(
    trends: DataFrame,
    as_of: dt.date,
    more_than: int = 50,
    growth: float = 100.0,
    n: int = 30,
) -> DataFrame:
    """Keywords of the two last full years with enough volume that more than doubled."""
    return (
        trends.where(F.col("pub_year").isin(as_of.year - 1, as_of.year - 2))
        .where((F.col("article_count") > more_than) & (F.col("yoy_change_pct") > growth))
        .select(
            "keyword_value",
            "keyword_name",
            "pub_year",
            "article_count",
            "prior_year_count",
            "yoy_change",
            "yoy_change_pct",
            "rank_in_year",
        )
        .orderBy(F.desc("yoy_change_pct"), "keyword_value", "keyword_name", "pub_year")
        .limit(n)
    )


def top_keywords_per_decade(trends: DataFrame, n: int = 5) -> DataFrame:
    """Top values of each decade. Tasks keep their own first ``n`` per decade before the shuffle."""
    best = Window.partitionBy("decade").orderBy(F.desc("total_articles"), "keyword_value")
    return (
        trends.groupBy(decade("pub_year").alias("decade"), "keyword_value")
        .agg(F.sum("article_count").alias("total_articles"))
        .withColumn("rank_in_decade", F.row_number().over(best).cast("bigint"))
        .where(F.col("rank_in_decade") <= n)
        .orderBy(F.desc("decade"), "rank_in_decade")
    )


# Keywords followed over time, lower case.
TRACKED = (
    "covid-19", "coronavirus", "pandemic",
    "trump", "trump, donald j",
    "climate change", "global warming",
    "artificial intelligence", "ai",
)


def tracked_keywords(trends: DataFrame, values: Sequence[str] = TRACKED) -> DataFrame:
    return (
        trends.where(F.lower("keyword_value").isin(list(values)))
        .select("keyword_value", "pub_year", "article_count", "rank_in_year")
        .orderBy("keyword_value", "pub_year", "rank_in_year")
    )


# --- authors -------------------------------------------------------------------------------------

AUTHOR_TIES = ("author_full_name", "firstname", "lastname")


def _authors(authors: DataFrame, order: Sequence[Column], n: int, columns: str) -> DataFrame:
    return authors.orderBy(*order, *AUTHOR_TIES).limit(n).select(*columns.split())


def prolific_authors(authors: DataFrame, n: int = 50) -> DataFrame:
    return _authors(
        authors,
        [F.desc("total_articles")],
        n,
        "author_full_name total_articles first_article_date last_article_date years_active "
        "articles_per_year avg_word_count total_words_written sections_written_for first_year "
        "last_year",
    )


def productive_authors(authors: DataFrame, min_years: int = 5, n: int = 30) -> DataFrame:
    return _authors(
        authors.where(F.col("years_active") >= min_years),
        [F.desc("articles_per_year")],
        n,
        "author_full_name total_articles years_active articles_per_year first_year last_year",
    )


def versatile_authors(authors: DataFrame, n: int = 30) -> DataFrame:
    return _authors(
        authors,
        [F.desc("sections_written_for"), F.desc("total_articles")],
        n,
        "author_full_name sections_written_for total_articles years_active avg_word_count",
    )


def longest_careers(authors: DataFrame, n: int = 30) -> DataFrame:
    return _authors(
        authors,
        [F.desc("career_span_days")],
        n,
        "author_full_name first_year last_year years_active career_span_days total_articles "
        "articles_per_year",
    )


def longest_articles(authors: DataFrame, n: int = 30) -> DataFrame:
    return _authors(
        authors,
        [F.desc("longest_article_words")],
        n,
        "author_full_name longest_article_words avg_word_count total_articles",
    )


def author_debuts(authors: DataFrame) -> DataFrame:
    return (
        authors.groupBy(decade("first_year").alias("debut_decade"))
        .agg(n_rows().alias("new_authors"))
        .orderBy("debut_decade")
    )


# --- popularity ----------------------------------------------------------------------------------


def recent_popular(pop: DataFrame, as_of: dt.date, days: int = 7, n: int = 100) -> DataFrame:
    """Newest snapshots first, young articles first within a day."""
    return (
        pop.where(F.col("snapshot_date") >= as_of - dt.timedelta(days=days))
        .orderBy(
            F.desc("snapshot_date"), F.asc_nulls_first("days_since_published"), "article_id"
        )
        .limit(n)
        .select(
            "snapshot_date",
            "title",
            "section",
            "published_date",
            "days_since_published",
            "url",
            "byline",
            "description_facet_count",
            "person_facet_count",
            "geo_facet_count",
        )
    )


AGE_BUCKETS = (
    (0, 0, "0 days (same day)"),
    (1, 7, "1-7 days"),
    (8, 30, "8-30 days"),
    (31, 365, "31-365 days"),
)


def popularity_age_buckets(
    pop: DataFrame,
    buckets: Sequence[tuple[int, int, str]] = AGE_BUCKETS,
    rest: str = "365+ days (evergreen)",
) -> DataFrame:
    """Snapshot rows per age bucket, youngest first. Negative and unknown ages fall into ``rest``."""
    age = F.col("days_since_published")
    bucket = label([(age.between(low, high), text) for low, high, text in buckets], rest)
    return (
        pop.groupBy(bucket.alias("age_bucket"))
        .agg(
            n_rows().alias("article_count"),
            mean("days_since_published", 1).alias("avg_days_old"),
            F.min("days_since_published").alias("_youngest"),
        )
        .orderBy("_youngest")
        .drop("_youngest")
    )


def evergreen(pop: DataFrame, older_than: int = 365, n: int = 50) -> DataFrame:
    return (
        pop.where(F.col("days_since_published") > older_than)
        .orderBy(F.desc("days_since_published"), "snapshot_date", "article_id")
        .limit(n)
        .select(
            "title", "section", "published_date", "snapshot_date", "days_since_published", "url"
        )
    )


def popular_sections(pop: DataFrame) -> DataFrame:
    return (
        pop.groupBy("section")
        .agg(
            F.countDistinct("article_id").alias("unique_popular_articles"),
            n_rows().alias("total_appearances"),
            mean("days_since_published", 1).alias("avg_age_when_popular"),
        )
        .orderBy(F.desc("unique_popular_articles"), "section")
    )


def facet_richness(pop: DataFrame) -> DataFrame:
    """Snapshot rows by number of description, place and person facets (organizations left out)."""
    facets = (
        F.col("description_facet_count") + F.col("geo_facet_count") + F.col("person_facet_count")
    )
    rules = [
        (facets == 0, "No facets"),
        (facets.between(1, 5), "1-5 facets"),
        (facets.between(6, 10), "6-10 facets"),
    ]
    return (
        pop.groupBy(label(rules, "11+ facets").alias("facet_bucket"))
        .agg(
            n_rows().alias("article_count"),
            mean("description_facet_count", 1).alias("avg_description_facets"),
            mean("geo_facet_count", 1).alias("avg_geo_facets"),
            mean("person_facet_count", 1).alias("avg_person_facets"),
            F.min(facets).alias("_fewest"),
        )
        .orderBy("_fewest")
        .drop("_fewest")
    )


# --- events --------------------------------------------------------------------------------------

# Years of interest and the first matching label (from year, to year, text).
EVENT_YEARS = (1914, 1918, 1929, 1939, 1945, 1963, 2001, 2008, 2016, 2020, 2024)
EVENT_LABELS = (
    (1914, 1918, "WWI"),
    (1939, 1945, "WWII"),
    (1929, 1929, "Great Depression Begins"),
    (1963, 1963, "JFK Assassination"),
    (2001, 2001, "9/11"),
    (2008, 2008, "Financial Crisis"),
    (2020, 2020, "COVID-19 Pandemic"),
    (2016, 2016, "Presidential Election"),
    (2024, 2024, "Presidential Election"),
)


def event_years(
    fct: DataFrame,
    years: Sequence[int] = EVENT_YEARS,
    labels: Sequence[tuple[int, int, str]] = EVENT_LABELS,
) -> DataFrame:
    year = F.col("pub_year")
    context = label([(year.between(low, high), text) for low, high, text in labels])
    return (
        fct.where(year.isin(list(years)))
        .groupBy("pub_year")
        .agg(
            n_rows().alias("article_count"),
            mean("word_count", 0).alias("avg_word_count"),
            F.countDistinct("section_name").alias("sections_active"),
        )
        .withColumn("historical_context", context)
        .orderBy("pub_year")
    )


# Parts of keyword values that mark pandemic coverage.
PANDEMIC = ("covid", "coronavirus", "pandemic")


def keyword_evolution(trends: DataFrame, parts: Sequence[str] = PANDEMIC) -> DataFrame:
    """Yearly rows of all keywords whose value contains one of ``parts``, case ignored."""
    matches = F.lit(False)
    for part in parts:
        matches = matches | F.contains(F.lower("keyword_value"), F.lit(part))
    return (
        trends.where(matches)
        .select("pub_year", "keyword_value", "article_count", "rank_in_year", "yoy_change_pct")
        .orderBy("pub_year", F.desc("article_count"), "rank_in_year")
    )


# --- richness ------------------------------------------------------------------------------------


def author_count_buckets(fct: DataFrame) -> DataFrame:
    """Articles by number of authors with the share of all articles."""
    authors = F.col("author_count")
    rules = [
        (authors == 0, "No attribution"),
        (authors == 1, "Single author"),
        (authors == 2, "2 authors"),
        (authors == 3, "3 authors"),
    ]
    # At most five rows are left when the window over all of them runs.
    everything = Window.partitionBy()
    return (
        fct.groupBy(label(rules, "4+ authors").alias("author_bucket"))
        .agg(n_rows().alias("article_count"), F.min("author_count").alias("_fewest"))
        .withColumn(
            "pct_of_total",
            pct(F.col("article_count"), F.sum("article_count").over(everything), 2),
        )
        .orderBy("_fewest")
        .drop("_fewest")
    )


def collaboration_by_year(fct: DataFrame, n: int = 50) -> DataFrame:
    authors = F.col("author_count")
    return (
        fct.groupBy("pub_year")
        .agg(
            n_rows().alias("total_articles"),
            F.count_if(authors == 0).alias("no_author"),
            F.count_if(authors == 1).alias("single_author"),
            F.count_if(authors == 2).alias("two_authors"),
            F.count_if(authors >= 3).alias("three_plus_authors"),
            pct(F.count_if(authors >= 2), n_rows(), 2).alias("pct_collaborative"),
        )
        .orderBy(F.desc("pub_year"))
        .limit(n)
    )


def keyword_density(fct: DataFrame, more_than: int = 1000) -> DataFrame:
    return (
        fct.groupBy("section_name")
        .agg(
            n_rows().alias("article_count"),
            mean("keyword_count", 2).alias("avg_keywords"),
            mean("major_keyword_count", 2).alias("avg_major_keywords"),
            pct(F.count_if("has_keywords"), n_rows(), 2).alias("pct_with_keywords"),
        )
        .where(F.col("article_count") > more_than)
        .orderBy(F.desc("avg_keywords"), "section_name")
    )


def word_count_quartiles(fct: DataFrame, more_than: int = 1000) -> DataFrame:
    """Exact discrete quartiles per section. Their state is one counter per distinct length."""
    quartiles = F.expr("percentile_disc(array(0.25, 0.5, 0.75)) within group (order by word_count)")
    return (
        fct.groupBy("section_name")
        .agg(
            n_rows().alias("article_count"),
            F.min("word_count").alias("min_words"),
            quartiles.alias("q"),
            F.max("word_count").alias("max_words"),
            mean("word_count", 0).alias("avg_words"),
        )
        .where(F.col("article_count") > more_than)
        .select(
            "section_name",
            "article_count",
            "min_words",
            *[
                F.col("q")[i].cast("bigint").alias(name)
                for i, name in enumerate(("p25_words", "median_words", "p75_words"))
            ],
            "max_words",
            "avg_words",
        )
        .orderBy(F.desc("median_words"), "section_name")
    )


# --- anomalies -----------------------------------------------------------------------------------


def monthly_outliers(months: DataFrame, deviations: float = 3.0) -> DataFrame:
    """Months further than ``deviations`` standard deviations from the mean; none if all are equal."""
    stats = months.agg(
        F.avg("total_articles").alias("m"), F.stddev_samp("total_articles").alias("s")
    )
    score = ratio(F.col("total_articles") - F.col("mean_articles"), F.col("stddev_articles"))
    return (
        months.select(
            "pub_month",
            "total_articles",
            stats.select("m").scalar().alias("mean_articles"),
            stats.select("s").scalar().alias("stddev_articles"),
        )
        .withColumn("_score", score)
        .where(F.abs("_score") > deviations)
        .orderBy(F.desc(F.abs("_score")), "pub_month")
        .withColumn("z_score", F.round("_score", 2))
        .drop("_score")
    )


def sudden_keywords(trends: DataFrame, more_than: int = 100, n: int = 50) -> DataFrame:
    """Keyword rows without an earlier row of the same value (whatever its name) and much volume."""
    history = Window.partitionBy("keyword_value").orderBy("pub_year", "keyword_name")
    return (
        trends.select(
            "keyword_value",
            "keyword_name",
            "pub_year",
            "article_count",
            F.lag("article_count", 1).over(history).alias("_before"),
            F.lag("article_count", 2).over(history).alias("_before2"),
        )
        .where(F.col("_before").isNull() & F.col("_before2").isNull())
        .where(F.col("article_count") > more_than)
        .select(
            "keyword_value",
            "keyword_name",
            F.col("pub_year").alias("first_year"),
            F.col("article_count").alias("first_year_count"),
        )
        .orderBy(F.desc("first_year_count"), "keyword_value", "keyword_name")
        .limit(n)
    )


# --- dashboard rows ------------------------------------------------------------------------------


def latest_snapshot(pop: DataFrame) -> DataFrame:
    """Rows of the newest snapshot; the date is found first and reaches the scan as a filter."""
    newest = pop.agg(F.max("snapshot_date").alias("d")).select("d").scalar()
    return pop.where(F.col("snapshot_date") == newest)


def trending_summary(pop: DataFrame, as_of: dt.date, sections: int = 10) -> DataFrame:
    """One row on the newest snapshot, with its first few sections in order."""
    today = latest_snapshot(pop)
    names = today.select("section").distinct().orderBy("section").limit(sections)
    first = names.agg(F.sort_array(F.collect_list("section")).alias("s"))
    return today.agg(
        F.lit(as_of).alias("as_of_date"),
        F.countDistinct("article_id").alias("trending_articles_count"),
        mean("days_since_published", 1).alias("avg_article_age"),
        F.countDistinct("section").alias("sections_represented"),
    ).withColumn("top_sections", first.select("s").scalar())


def header_metrics(fct: DataFrame, authors: DataFrame, pop: DataFrame) -> DataFrame:
    """One row of totals. Years of coverage count year boundaries between first and last article."""
    return fct.agg(
        n_rows().alias("total_articles"),
        F.countDistinct("section_name").alias("total_sections"),
        (F.year(F.max("pub_date")) - F.year(F.min("pub_date"))).alias("years_of_coverage"),
        F.max("pub_date").alias("latest_article_date"),
    ).select(
        "total_articles",
        authors.agg(n_rows().alias("n")).select("n").scalar().alias("total_authors"),
        "total_sections",
        "years_of_coverage",
        "latest_article_date",
        pop.agg(F.max("snapshot_date").alias("d")).select("d").scalar().alias(
            "latest_snapshot_date"
        ),
    )


def sparkline(months: DataFrame, as_of: dt.date, back: int = 12) -> DataFrame:
    return (
        months.where(F.col("pub_month") >= F.add_months(F.lit(as_of), -back))
        .select(
            "pub_month", "total_articles", "avg_word_count", "pct_with_keywords", "unique_sections"
        )
        .orderBy("pub_month")
    )
