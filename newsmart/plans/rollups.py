"""Further rollups behind dashboard views. Definitions that are this library's own say so."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsmart.functions.exprs import decade, label, n_rows, pct, ratio
from newsmart.operators.flatten import facets_flattened, known_values
from newsmart.operators.indexes import Trigrams
from newsmart.plans.explore import latest_snapshot, mean

KEYWORD_TIES = ("keyword_value", "keyword_name")
SECTION_TIES = ("section_name", "news_desk")

Period = tuple[dt.date, dt.date]


def newest_year(df: DataFrame) -> Column:
    return df.agg(F.max("pub_year").alias("y")).select("y").scalar()


# --- popularity ----------------------------------------------------------------------------------


def snapshot_daily_summary(pop: DataFrame) -> DataFrame:
    """Per snapshot day: distinct articles, mean age and the sorted list of sections.

    Rows are reduced per (day, article) and per (day, section) first, so a crowded day is spread
    over the tasks and only its distinct sections are gathered.
    """
    day = "snapshot_date"
    articles = (
        pop.groupBy(day, "article_id")
        .agg(
            F.sum("days_since_published").alias("age"),
            F.count("days_since_published").alias("aged"),
        )
        .groupBy(day)
        .agg(
            F.count("article_id").alias("unique_articles"),
            ratio(F.sum("age"), F.sum("aged")).alias("avg_age_of_popular"),
        )
    )
    sections = (
        pop.select(day, "section")
        .distinct()
        .groupBy(day)
        .agg(F.sort_array(F.collect_list("section")).alias("sections_represented"))
    )
    return articles.join(sections, day).orderBy(day)


def popularity_decay(pop: DataFrame) -> DataFrame:
    """Snapshot rows per age in days."""
    return (
        pop.where(F.col("days_since_published").isNotNull())
        .groupBy("days_since_published")
        .agg(n_rows().alias("article_count"))
        .orderBy("days_since_published")
    )


FACET_COUNTS = (
    "description_facet_count",
    "geo_facet_count",
    "person_facet_count",
    "organization_facet_count",
)


def article_stickiness(pop: DataFrame) -> DataFrame:
    """Days each article stays listed, its first and last day and its mean facet counts."""
    return (
        pop.groupBy("article_id", "snapshot_date")
        .agg(*[F.max(c).alias(c) for c in FACET_COUNTS])
        .groupBy("article_id")
        .agg(
            n_rows().alias("days_listed"),
            F.min("snapshot_date").alias("first_listed"),
            F.max("snapshot_date").alias("last_listed"),
            *[F.avg(c).alias(f"avg_{c}") for c in FACET_COUNTS],
        )
    )


def facet_correlation(pop: DataFrame) -> DataFrame:
    """Correlation of facet counts with the days listed; null where one of them never varies."""

    def corr(c: str) -> Column:
        spread = F.stddev_pop(c) * F.stddev_pop("days_listed")
        return F.round(ratio(F.covar_pop(c, "days_listed"), spread), 6)

    return article_stickiness(pop).agg(
        n_rows().alias("articles"),
        *[corr(f"avg_{c}").alias(c.replace("facet_count", "corr")) for c in FACET_COUNTS],
    )


def popular_today(pop: DataFrame, n: int = 20) -> DataFrame:
    """Articles of the newest snapshot, youngest first."""
    return (
        latest_snapshot(pop)
        .orderBy(F.asc_nulls_last("days_since_published"), "article_id")
        .limit(n)
        .select("snapshot_date", "article_id", "title", "section", "days_since_published", "url")
    )


def facets_today(pop: DataFrame) -> DataFrame:
    """How often each topic, place, person and organization occurs in the newest snapshot."""
    return (
        facets_flattened(latest_snapshot(pop))
        .groupBy("facet_type", "facet_value")
        .agg(n_rows().alias("frequency"))
        .orderBy("facet_type", F.desc("frequency"), "facet_value")
    )


def facets_against_history(pop: DataFrame, trends: DataFrame) -> DataFrame:
    """Today's facet values next to the archive's history of the same keyword value."""
    history = trends.groupBy("keyword_value").agg(
        F.sum("article_count").alias("archive_articles"),
        F.min("pub_year").alias("first_year"),
        F.max("pub_year").alias("last_year"),
    )
    today = (
        facets_flattened(latest_snapshot(pop))
        .groupBy("facet_value")
        .agg(n_rows().alias("frequency_today"))
    )
    return (
        today.join(history, today["facet_value"] == history["keyword_value"], "left")
        .drop("keyword_value")
        .orderBy(F.desc("frequency_today"), "facet_value")
    )


def section_popularity_bias(fct: DataFrame, pop: DataFrame) -> DataFrame:
    """Share of each section in the popular list against its share in the archive."""

    def shares(df: DataFrame, section: str, name: str) -> DataFrame:
        total = df.agg(n_rows().alias("n")).select("n").scalar()
        return (
            df.groupBy(F.col(section).alias("section"))
            .agg(n_rows().alias("n"))
            .select("section", pct(F.col("n"), total, 2).alias(name))
        )

    archive = shares(fct, "section_name", "archive_pct")
    popular = shares(pop, "section", "popular_pct")
    return (
        archive.join(popular, "section", "full")
        .na.fill(0.0, ["archive_pct", "popular_pct"])
        .withColumn("bias", F.round(F.col("popular_pct") - F.col("archive_pct"), 2))
        .orderBy(F.desc("bias"), "section")
    )


# --- keywords ------------------------------------------------------------------------------------


def keyword_cooccurrence(
    keywords: DataFrame, min_articles: int = 2, block: int = 1000
) -> DataFrame:
    """Pairs of keyword values on the same article (first value smaller) with their article count.

    At least two articles are asked for, as every pair of a single article would be listed otherwise.
    Blank values take part like any other; only nulls drop out. Values are made distinct per article
    first, so pairs are counted without a distinct. A value on fewer than ``min_articles`` articles
    cannot be in a result pair and is left out before pairing, which changes nothing in the result.
    An article with more than ``block`` values is cut: its left rows go to one of several salts and
    its right rows are repeated for each, so one article's pairs are formed by many tasks.
    """
    if min_articles < 2:
        raise ValueError("min_articles must be 2 or more")
    values = (
        keywords.where(F.col("keyword_value").isNotNull())
        .select("article_id", F.col("keyword_value").alias("value"))
        .distinct()
    )
    frequent = values.groupBy("value").agg(n_rows().alias("n")).where(F.col("n") >= min_articles)
    values = values.join(frequent, "value", "left_semi")
    sizes = values.groupBy("article_id").agg(
        F.ceil(n_rows() / F.lit(block)).cast("int").alias("salts")
    )
    sized = values.join(sizes, "article_id")
    left = sized.select(
        "article_id",
        F.pmod(F.xxhash64("value"), F.col("salts")).cast("int").alias("salt"),
        F.col("value").alias("keyword_1"),
    )
    right = sized.select(
        "article_id",
        F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
        F.col("value").alias("keyword_2"),
    )
    return (
        left.join(right, ["article_id", "salt"])
        .where(F.col("keyword_1") < F.col("keyword_2"))
        .groupBy("keyword_1", "keyword_2")
        .agg(n_rows().alias("cooccurrence_count"))
        .where(F.col("cooccurrence_count") >= min_articles)
    )


def keyword_spikes(
    trends: DataFrame, growth: float = 500.0, more_than: int = 100
) -> DataFrame:
    return (
        trends.where((F.col("yoy_change_pct") > growth) & (F.col("article_count") > more_than))
        .select(*KEYWORD_TIES, "pub_year", "article_count", "prior_year_count", "yoy_change_pct")
        .orderBy(F.desc("yoy_change_pct"), *KEYWORD_TIES, "pub_year")
        .drop("keyword_name")
    )


def top_keyword_values(trends: DataFrame, n: int = 50) -> DataFrame:
    return (
        trends.groupBy("keyword_value")
        .agg(F.sum("article_count").alias("total_articles"))
        .orderBy(F.desc("total_articles"), "keyword_value")
        .limit(n)
    )


def trending_keywords(trends: DataFrame, as_of: dt.date, n: int = 30) -> DataFrame:
    """Last full year by growth; new keywords come last."""
    return (
        trends.where(F.col("pub_year") == as_of.year - 1)
        .orderBy(F.desc_nulls_last("yoy_change_pct"), *KEYWORD_TIES)
        .limit(n)
        .select("keyword_value", "article_count", "yoy_change_pct")
    )


def rank_history(trends: DataFrame, n: int = 10) -> DataFrame:
    """Rank in every year of the newest year's first ``n`` keywords."""
    leaders = trends.where(
        (F.col("pub_year") == newest_year(trends)) & (F.col("rank_in_year") <= n)
    ).select("keyword_name", "keyword_value")
    same = ["keyword_name", "keyword_value"]
    left, right = trends.alias("t"), leaders.alias("l")
    match = [F.col(f"t.{c}").eqNullSafe(F.col(f"l.{c}")) for c in same]
    return (
        left.join(right, match[0] & match[1], "left_semi")
        .select("keyword_name", "keyword_value", "pub_year", "rank_in_year", "article_count")
        .orderBy("keyword_value", "keyword_name", "pub_year")
    )


def top_keywords_per_year(trends: DataFrame, n: int = 20) -> DataFrame:
    return (
        trends.where(F.col("rank_in_year") <= n)
        .select("pub_year", "rank_in_year", "keyword_name", "keyword_value", "article_count")
        .orderBy("pub_year", "rank_in_year")
    )


def keyword_momentum(trends: DataFrame) -> DataFrame:
    """Newest year's keywords in four quadrants, cut at the median volume and median growth.

    The quadrants' edges are this library's choice: at or above both medians is a rising star,
    volume alone is declining when growth is negative and established otherwise, the rest is niche
    unless it grows.
    """
    latest = trends.where(F.col("pub_year") == newest_year(trends)).where(
        F.col("yoy_change_pct").isNotNull()
    )
    medians = latest.agg(
        F.expr("percentile_disc(0.5) within group (order by article_count)").alias("volume"),
        F.expr("percentile_disc(0.5) within group (order by yoy_change_pct)").alias("growth"),
    )
    big = F.col("article_count") >= medians.select("volume").scalar()
    fast = F.col("yoy_change_pct") >= medians.select("growth").scalar()
    rules = [
        (big & fast, "Rising Stars"),
        (big & (F.col("yoy_change_pct") < 0), "Declining"),
        (big, "Established"),
        (fast, "Rising Stars"),
    ]
    return latest.select(
        *KEYWORD_TIES,
        "article_count",
        "yoy_change_pct",
        "keyword_occurrences",
        label(rules, "Niche").alias("quadrant"),
    )


def keyword_weights(trends: DataFrame) -> DataFrame:
    """Newest year's keyword values with volume relative to the largest one."""
    latest = (
        trends.where(F.col("pub_year") == newest_year(trends))
        .groupBy("keyword_value")
        .agg(F.sum("article_count").alias("article_count"))
    )
    largest = latest.agg(F.max("article_count").alias("m")).select("m").scalar()
    return latest.select(
        "keyword_value",
        "article_count",
        F.round(ratio(F.col("article_count"), largest), 4).alias("weight"),
    ).orderBy(F.desc("article_count"), "keyword_value")


def _first(ordered: DataFrame, n: int | None) -> DataFrame:
    return ordered if n is None else ordered.limit(n)


def declining_keywords(trends: DataFrame, as_of: dt.date, n: int | None = None) -> DataFrame:
    """Last full year's keywords that lost articles, with their rank change; with ``n`` the first ones."""
    return (
        _first(
            trends.where((F.col("pub_year") == as_of.year - 1) & (F.col("yoy_change") < 0)).orderBy(
                "yoy_change", *KEYWORD_TIES
            ),
            n,
        )
        .select(
            "keyword_value",
            "keyword_name",
            "article_count",
            "prior_year_count",
            "yoy_change",
            "yoy_change_pct",
            "rank_in_year",
            "prior_year_rank",
            "rank_change",
        )
    )


def _with_names_like(rows: DataFrame, column: str, part: str, index: Trigrams | None) -> DataFrame:
    """The rows whose name can contain ``part``, as far as the index knows; all rows without one."""
    found = index.candidates(part) if index else None
    if found is None:
        return rows
    return rows.join(found.withColumnRenamed("term", column), column, "left_semi")


def election_cycle(trends: DataFrame, part: str, index: Trigrams | None = None) -> DataFrame:
    """Volume of keywords containing ``part`` by position in a four-year cycle (0 = election)."""
    return (
        _with_names_like(trends, "keyword_value", part, index)
        .where(F.contains(F.lower("keyword_value"), F.lit(part.lower())))
        .groupBy(F.pmod("pub_year", F.lit(4)).alias("cycle_year"))
        .agg(
            F.countDistinct("pub_year").alias("years"),
            F.sum("article_count").alias("article_count"),
            mean("article_count", 2).alias("avg_per_keyword"),
        )
        .orderBy("cycle_year")
    )


# --- sections, desks, materials ------------------------------------------------------------------


def section_composition(sections: DataFrame) -> DataFrame:
    """Articles per section and year, desks added up."""
    return (
        sections.groupBy("pub_year", "section_name")
        .agg(
            F.sum("article_count").alias("article_count"),
            F.max("year_total").alias("year_total"),
        )
        .select(
            "pub_year",
            "section_name",
            "article_count",
            pct(F.col("article_count"), F.col("year_total"), 2).alias("pct_of_year"),
        )
        .orderBy("pub_year", "section_name")
    )


def latest_section_distribution(sections: DataFrame) -> DataFrame:
    return (
        sections.where(F.col("pub_year") == newest_year(sections))
        .select(*SECTION_TIES, "pub_year", "article_count", "yoy_change_pct", "pct_of_year_total")
        .orderBy(F.desc("article_count"), *SECTION_TIES)
    )


def growing_and_declining_sections(
    sections: DataFrame, as_of: dt.date, n: int = 10
) -> DataFrame:
    """The ``n`` largest gains and the ``n`` largest losses in percent of the last full year."""
    year = sections.where(F.col("pub_year") == as_of.year - 1).select(
        *SECTION_TIES, "article_count", "prior_year_count", "yoy_change_pct"
    )
    change = F.col("yoy_change_pct")
    up = year.where(change > 0).orderBy(F.desc("yoy_change_pct"), *SECTION_TIES).limit(n)
    down = year.where(change < 0).orderBy("yoy_change_pct", *SECTION_TIES).limit(n)
    return up.withColumn("direction", F.lit("growing")).unionByName(
        down.withColumn("direction", F.lit("declining"))
    )


def section_year_matrix(sections: DataFrame) -> DataFrame:
    """Articles of every section in every year that it has any, desks added up."""
    return (
        sections.groupBy("section_name", "pub_year")
        .agg(F.sum("article_count").alias("article_count"))
        .orderBy("section_name", "pub_year")
    )


def section_change_by_decade(sections: DataFrame) -> DataFrame:
    """Decade totals per section and the change on the section's previous present decade."""
    history = Window.partitionBy("section_name").orderBy("decade")
    return (
        sections.groupBy("section_name", decade("pub_year").alias("decade"))
        .agg(F.sum("article_count").alias("article_count"))
        .withColumn("prior_decade_count", F.lag("article_count").over(history))
        .withColumn("change", F.col("article_count") - F.col("prior_decade_count"))
        .orderBy("section_name", "decade")
    )


def news_desk_volume(fct: DataFrame) -> DataFrame:
    """Articles and sections per desk and year."""
    return (
        fct.groupBy("news_desk", "pub_year")
        .agg(
            n_rows().alias("article_count"),
            F.countDistinct("section_name").alias("sections_covered"),
        )
        .orderBy("news_desk", "pub_year")
    )


def news_desk_structure(fct: DataFrame) -> DataFrame:
    """First and last year, active years and volume of each desk."""
    return (
        fct.groupBy("news_desk")
        .agg(
            F.min("pub_year").alias("first_year"),
            F.max("pub_year").alias("last_year"),
            F.countDistinct("pub_year").alias("years_active"),
            n_rows().alias("article_count"),
        )
        .orderBy("news_desk")
    )


def materials_by_year(fct: DataFrame) -> DataFrame:
    return (
        fct.groupBy("pub_year", "type_of_material")
        .agg(n_rows().alias("article_count"))
        .orderBy("pub_year", "type_of_material")
    )


# Materials that count as opinion and as news.
OPINION = ("Op-Ed", "Opinion", "Editorial", "Letter")
NEWS = ("News",)


def opinion_share(
    fct: DataFrame, opinion: tuple[str, ...] = OPINION, news: tuple[str, ...] = NEWS
) -> DataFrame:
    """Opinion and news articles per year and their shares. The two groups are parameters."""
    material = F.col("type_of_material")
    is_opinion, is_news = material.isin(*opinion), material.isin(*news)
    return (
        fct.groupBy("pub_year")
        .agg(
            n_rows().alias("total_articles"),
            F.count_if(is_opinion).alias("opinion_articles"),
            F.count_if(is_news).alias("news_articles"),
            pct(F.count_if(is_opinion), n_rows(), 2).alias("pct_opinion"),
            pct(F.count_if(is_news), n_rows(), 2).alias("pct_news"),
        )
        .orderBy("pub_year")
    )


# --- authors -------------------------------------------------------------------------------------


def career_histogram(authors: DataFrame, width: int = 1) -> DataFrame:
    """Authors per bin of active years."""
    start = (F.floor(F.col("years_active") / width) * width).cast("int")
    return (
        authors.groupBy(start.alias("years_from"))
        .agg(n_rows().alias("authors"))
        .orderBy("years_from")
    )


def power_authors(
    authors: DataFrame, min_per_year: float = 20.0, min_years: int = 10
) -> DataFrame:
    """Authors with a high yearly output over a long career. The thresholds are parameters."""
    return (
        authors.where(
            (F.col("articles_per_year") >= min_per_year) & (F.col("years_active") >= min_years)
        )
        .select(
            "author_full_name", "total_articles", "years_active", "articles_per_year",
            "sections_written_for",
        )
        .orderBy(F.desc("articles_per_year"), "author_full_name")
    )


def specialists_and_generalists(authors: DataFrame) -> DataFrame:
    """Authors of one section against authors of several."""
    kind = F.when(F.col("sections_written_for") == 1, "specialist").otherwise("generalist")
    return (
        authors.groupBy(kind.alias("author_kind"))
        .agg(
            n_rows().alias("authors"),
            mean("articles_per_year", 2).alias("avg_articles_per_year"),
            mean("total_articles", 2).alias("avg_total_articles"),
        )
        .orderBy("author_kind")
    )


def author_leaderboard(
    authors: DataFrame, search: str = "", n: int = 50, index: Trigrams | None = None
) -> DataFrame:
    """Most prolific authors whose name contains ``search``, case ignored."""
    return (
        _with_names_like(authors, "author_full_name", search, index)
        .where(F.contains(F.lower("author_full_name"), F.lit(search.lower())))
        .orderBy(F.desc("total_articles"), "author_full_name", "firstname", "lastname")
        .limit(n)
        .select(
            "author_full_name", "total_articles", "total_words_written", "first_year", "last_year",
            "years_active", "articles_per_year",
        )
    )


# --- years ---------------------------------------------------------------------------------------


def busiest_years(sections: DataFrame, n: int = 20) -> DataFrame:
    return (
        sections.groupBy("pub_year")
        .agg(F.sum("article_count").alias("article_count"))
        .orderBy(F.desc("article_count"), "pub_year")
        .limit(n)
    )


def month_year_heatmap(fct: DataFrame) -> DataFrame:
    return (
        fct.groupBy("pub_year", "pub_month")
        .agg(n_rows().alias("article_count"))
        .orderBy("pub_year", "pub_month")
    )


def author_share_by_year(fct: DataFrame) -> DataFrame:
    """Articles with one, two, three and more authors per year, and the multi-author share."""
    authors = F.col("author_count")
    return (
        fct.groupBy("pub_year")
        .agg(
            F.count_if(authors == 1).alias("one_author"),
            F.count_if(authors == 2).alias("two_authors"),
            F.count_if(authors == 3).alias("three_authors"),
            F.count_if(authors >= 4).alias("four_plus_authors"),
            pct(F.count_if(authors >= 2), F.count_if(authors >= 1), 2).alias("pct_multi_author"),
        )
        .orderBy("pub_year")
    )


def metadata_completeness(fct: DataFrame) -> DataFrame:
    """Share of articles with authors, keywords and media per year."""
    return (
        fct.groupBy("pub_year")
        .agg(
            n_rows().alias("total_articles"),
            pct(F.count_if("has_authors"), n_rows(), 1).alias("pct_with_authors"),
            pct(F.count_if("has_keywords"), n_rows(), 1).alias("pct_with_keywords"),
            pct(F.count_if("has_multimedia"), n_rows(), 1).alias("pct_with_multimedia"),
        )
        .orderBy("pub_year")
    )


def yearly_spikes(sections: DataFrame, factor: float = 1.5) -> DataFrame:
    """Years with more than ``factor`` times the mean of the years next to them (our definition)."""
    # One row per year is left when the window over all years runs.
    by_year = Window.partitionBy(F.lit(0)).orderBy("pub_year")
    around = F.array_compact(
        F.array(
            F.lag("article_count").over(by_year).cast("double"),
            F.lead("article_count").over(by_year).cast("double"),
        )
    )
    total = F.aggregate("around", F.lit(0.0), lambda a, x: a + x)
    return (
        sections.where(F.col("pub_year").isNotNull())
        .groupBy("pub_year")
        .agg(F.sum("article_count").alias("article_count"))
        .withColumn("around", around)
        .withColumn("neighbour_avg", ratio(total, F.size("around")))
        .withColumn("_factor", ratio(F.col("article_count"), F.col("neighbour_avg")))
        .where(F.col("_factor") > factor)
        .select(
            "pub_year", "article_count", "neighbour_avg", F.round("_factor", 2).alias("factor")
        )
        .orderBy(F.desc("factor"), "pub_year")
    )


# --- two periods ---------------------------------------------------------------------------------


def _inside(period: Period) -> Column:
    return F.col("pub_date").between(F.lit(period[0]), F.lit(period[1]))


def compare_sections(fct: DataFrame, first: Period, second: Period) -> DataFrame:
    """Articles per section in two periods, from one pass over the rows of either period."""
    in_first, in_second = _inside(first), _inside(second)
    return (
        fct.where(in_first | in_second)
        .groupBy("section_name")
        .agg(
            F.count_if(in_first).alias("first_count"), F.count_if(in_second).alias("second_count")
        )
        .withColumn("change", F.col("second_count") - F.col("first_count"))
        .orderBy("section_name")
    )


def compare_keywords(
    keywords: DataFrame, first: Period, second: Period, n: int | None = None
) -> DataFrame:
    """Keyword values by their change in distinct articles between two periods; with ``n`` the first ones."""
    in_first, in_second = _inside(first), _inside(second)
    per_article = (
        known_values(keywords)
        .where(in_first | in_second)
        .groupBy("keyword_value", "article_id")
        .agg(F.bool_or(in_first).alias("a"), F.bool_or(in_second).alias("b"))
    )
    changes = (
        per_article.groupBy("keyword_value")
        .agg(F.count_if("a").alias("first_count"), F.count_if("b").alias("second_count"))
        .withColumn("change", F.col("second_count") - F.col("first_count"))
    )
    return _first(changes.orderBy(F.desc(F.abs("change")), "keyword_value"), n)


def compare_lengths(fct: DataFrame, first: Period, second: Period) -> DataFrame:
    """Volume and length of the articles of two periods, one row per period."""
    in_first, in_second = _inside(first), _inside(second)
    # A row inside both periods counts in both.
    periods = F.array_compact(
        F.array(F.when(in_first, F.lit("first")), F.when(in_second, F.lit("second")))
    )
    return (
        fct.where(in_first | in_second)
        .select(F.explode(periods).alias("period"), "word_count", "author_count", "keyword_count")
        .groupBy("period")
        .agg(
            n_rows().alias("article_count"),
            mean("word_count", 0).alias("avg_word_count"),
            F.max("word_count").alias("max_word_count"),
            mean("author_count", 2).alias("avg_authors"),
            mean("keyword_count", 2).alias("avg_keywords"),
        )
        .orderBy("period")
    )


# --- landing page --------------------------------------------------------------------------------


def landing_totals(fct: DataFrame, authors: DataFrame, pop: DataFrame) -> DataFrame:
    """One row: articles, authors, years of coverage and the title heading today's list."""
    heading = popular_today(pop, 1).agg(F.max("title").alias("t"))
    return fct.agg(
        n_rows().alias("total_articles"),
        (F.year(F.max("pub_date")) - F.year(F.min("pub_date"))).alias("years_of_coverage"),
    ).select(
        "total_articles",
        authors.agg(n_rows().alias("n")).select("n").scalar().alias("total_authors"),
        "years_of_coverage",
        heading.select("t").scalar().alias("current_most_popular"),
    )
