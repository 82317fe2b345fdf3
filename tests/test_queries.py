"""Queries on the facts and marts: rules that the comparison tables do not reach, and brute force."""

import datetime as dt
import hashlib
import itertools
import random
from collections import Counter, defaultdict

import pytest
from conftest import keyword, person, rows
from pyspark.sql import functions as F

from newsmart.functions.exprs import number_text, percent_text, surrogate_key
from newsmart.functions.ranking import spread_row_number
from newsmart.operators.flatten import keywords_flattened
from newsmart.operators.staging import stg_archive_articles, stg_most_popular_articles
from newsmart.plans import core, dashboard, explore, rollups

D = dt.date


# --- row numbers in large groups -----------------------------------------------------------------


@pytest.mark.parametrize("digits", [1, 3])
def test_spread_row_number_equals_a_plain_window(spark, digits):
    rng = random.Random(7)
    data = [
        (rng.choice([None, 1, 1, 1, 2]), rng.choice([1, 1, 1, 2, 5]), f"k{i}") for i in range(2000)
    ]
    df = spark.createDataFrame(data, "g int, m bigint, name string").withColumn(
        "key", surrogate_key("name")
    )
    found = spread_row_number(df, "g", "m", "key", "rank", digits)
    expected = {}
    for group in (None, 1, 2):
        members = sorted(
            ((-m, hashlib.md5(n.encode()).hexdigest(), n) for g, m, n in data if g == group)
        )
        expected.update({(group, n): i + 1 for i, (_, _, n) in enumerate(members)})
    assert {(r["g"], r["name"]): r["rank"] for r in found.collect()} == expected


# --- co-occurrence -------------------------------------------------------------------------------


@pytest.mark.parametrize(("least", "block"), [(2, 1000), (2, 3), (3, 3), (3, 1)])
def test_cooccurrence_equals_brute_force(articles, least, block):
    rng = random.Random(3)
    topics = [f"t{i}" for i in range(12)] + [" ", None]
    made = [[rng.choice(topics) for _ in range(rng.randrange(8))] for _ in range(40)]
    made.append([f"t{i}" for i in range(12)] * 2)  # one article with many and repeated values
    stg = stg_archive_articles(
        articles(
            *[
                {"article_id": str(i), "keywords": [keyword(v) for v in vs]}
                for i, vs in enumerate(made)
            ]
        )
    )
    pairs = Counter()
    for values in made:
        distinct = sorted({v for v in values if v is not None})
        pairs.update(itertools.combinations(distinct, 2))
    expected = sorted((a, b, n) for (a, b), n in pairs.items() if n >= least)
    found = rollups.keyword_cooccurrence(keywords_flattened(stg, fields=["value"]), least, block)
    assert sorted(tuple(r) for r in found.collect()) == expected


def test_cooccurrence_of_one_crowded_article(articles):
    values = [f"v{i:03d}" for i in range(60)]
    stg = stg_archive_articles(
        articles(*[{"article_id": i, "keywords": [keyword(v) for v in values]} for i in "12"])
    )
    found = rollups.keyword_cooccurrence(keywords_flattened(stg), block=7)
    assert found.count() == 60 * 59 // 2
    assert found.where("keyword_1 >= keyword_2").count() == 0


# --- keyword queries -----------------------------------------------------------------------------

TRENDS = (
    "keyword_name string, keyword_value string, pub_year int, article_count bigint, "
    "keyword_occurrences bigint, rank_in_year bigint, prior_year_count bigint, yoy_change bigint, "
    "yoy_change_pct double, prior_year_rank bigint, rank_change bigint"
)


@pytest.fixture
def trends(spark):
    def make(*data):
        """Rows of name, value, year, count, growth in percent."""
        filled = [
            (n, v, y, c, c, i + 1, None, c, g, None, -(i + 1))
            for i, (n, v, y, c, g) in enumerate(data)
        ]
        return spark.createDataFrame(filled, TRENDS)

    return make


def test_sudden_keywords_look_at_the_value_only(trends):
    found = explore.sudden_keywords(
        trends(
            ("person", "x", 2000, 200, None),
            ("subject", "x", 2001, 300, None),  # same value under another name: not sudden
            ("subject", "y", 2001, 150, None),
            ("subject", "z", 2001, 100, None),  # not above the limit
        )
    )
    assert [tuple(r) for r in found.collect()] == [
        ("x", "person", 2000, 200), ("y", "subject", 2001, 150)
    ]


def test_default_keyword_lists(trends):
    data = trends(
        ("s", "COVID-19", 2020, 9, None),
        ("s", "Covid Vaccines", 2021, 5, 10.0),
        ("s", "Climate Change", 2020, 4, None),
        ("s", "Baseball", 2020, 3, None),
    )
    assert rows(explore.tracked_keywords(data), "keyword_value") == [
        ("COVID-19",), ("Climate Change",)
    ]
    assert rows(explore.keyword_evolution(data), "keyword_value") == [
        ("COVID-19",), ("Covid Vaccines",)
    ]


def test_fastest_keywords_limits_are_strict(trends):
    data = trends(
        ("s", "a", 2020, 51, 100.5),
        ("s", "b", 2020, 50, 300.0),
        ("s", "c", 2019, 99, 100.0),
        ("s", "d", 2019, 99, 101.0),
        ("s", "e", 2021, 99, 500.0),
        ("s", "f", 2018, 99, 500.0),
    )
    found = explore.fastest_keywords(data, D(2021, 7, 1))
    assert [r["keyword_value"] for r in found.collect()] == ["d", "a"]


def test_top_of_each_decade(trends):
    data = trends(*[("s", f"k{i}", 1990 + i % 20, 100 - i, None) for i in range(40)])
    found = explore.top_keywords_per_decade(data, 2)
    best = defaultdict(Counter)
    for i in range(40):
        best[(1990 + i % 20) // 10 * 10][f"k{i}"] += 100 - i
    expected = [
        (decade, value, total, rank)
        for decade in (2000, 1990)
        for rank, (value, total) in enumerate(
            sorted(best[decade].items(), key=lambda e: (-e[1], e[0]))[:2], 1
        )
    ]
    assert [tuple(r) for r in found.collect()] == expected


def test_momentum_quadrants(trends):
    data = trends(
        ("s", "star", 2020, 10, 50.0),
        ("s", "established", 2020, 9, 5.0),
        ("s", "declining", 2020, 8, -5.0),
        ("s", "small", 2020, 1, -60.0),
        ("s", "riser", 2020, 2, 90.0),
        ("s", "new", 2020, 30, None),
        ("s", "old", 2019, 30, 70.0),
    )
    found = rollups.keyword_momentum(data)
    assert dict(rows(found, "keyword_value", "quadrant")) == {
        "star": "Rising Stars",
        "established": "Rising Stars",
        "declining": "Declining",
        "small": "Niche",
        "riser": "Rising Stars",
    }


# --- facts ---------------------------------------------------------------------------------------


@pytest.fixture
def fct(articles):
    def make(*made):
        return core.fct_articles(stg_archive_articles(articles(*made)))

    return make


def test_event_labels_first_match_wins(fct):
    years = (1914, 1945, 2016, 2020, 2024, 2023)
    found = explore.event_years(
        fct(*[{"article_id": str(y), "pub_date": D(y, 1, 1)} for y in years])
    )
    assert [(r["pub_year"], r["historical_context"]) for r in found.collect()] == [
        (1914, "WWI"),
        (1945, "WWII"),
        (2016, "Presidential Election"),
        (2020, "COVID-19 Pandemic"),
        (2024, "Presidential Election"),
    ]


def test_author_count_buckets(fct):
    made = [
        {"article_id": str(i), "byline_person": [person("A", str(j)) for j in range(i)]}
        for i in (0, 1, 2, 3, 4, 9)
    ]
    found = [tuple(r) for r in explore.author_count_buckets(fct(*made)).collect()]
    assert found == [
        ("No attribution", 1, 16.67),
        ("Single author", 1, 16.67),
        ("2 authors", 1, 16.67),
        ("3 authors", 1, 16.67),
        ("4+ authors", 2, 33.33),
    ]


def test_quartiles(fct):
    made = [{"article_id": str(i), "word_count": i, "section_name": "S"} for i in range(1, 101)]
    row = explore.word_count_quartiles(fct(*made), 99).first()
    assert (row["min_words"], row["p25_words"], row["median_words"], row["p75_words"]) == (
        1, 25, 50, 75
    )
    assert explore.word_count_quartiles(fct(*made), 100).count() == 0


MONTHS = "pub_month date, total_articles bigint"


def test_outliers(spark):
    days = [D(2000 + i // 12, 1 + i % 12, 1) for i in range(24)]
    months = spark.createDataFrame([(d, 500 if i == 5 else 10) for i, d in enumerate(days)], MONTHS)
    row = explore.monthly_outliers(months).collect()
    assert [r["pub_month"] for r in row] == [days[5]] and row[0]["z_score"] == 4.69


@pytest.mark.parametrize("n", [0, 1, 5])
def test_no_outliers_without_deviation(spark, n):
    months = spark.createDataFrame([(D(2000, 1 + i, 1), 10) for i in range(n)], MONTHS)
    assert explore.monthly_outliers(months).count() == 0


def test_yearly_spikes(spark):
    data = [(2000, 10), (2001, 40), (2002, 10), (2003, 15), (None, 99)]
    sections = spark.createDataFrame(data, "pub_year int, article_count bigint")
    found = rollups.yearly_spikes(sections)
    assert [tuple(r) for r in found.collect()] == [(2001, 40, 10.0, 4.0)]
    all_years = rollups.yearly_spikes(sections, 0.0)
    assert dict(rows(all_years, "pub_year", "neighbour_avg"))[2003] == 10.0


def test_periods_may_overlap(fct):
    made = [
        {"article_id": str(y), "pub_date": D(y, 6, 1), "word_count": y, "section_name": "S"}
        for y in (2000, 2001, 2002)
    ]
    first, second = (D(2000, 1, 1), D(2001, 12, 31)), (D(2001, 1, 1), D(2002, 12, 31))
    found = rollups.compare_lengths(fct(*made), first, second)
    assert rows(found, "period", "article_count", "avg_word_count") == [
        ("first", 2, 2001.0), ("second", 2, 2002.0)
    ]
    assert rows(
        rollups.compare_sections(fct(*made), first, second),
        "section_name", "first_count", "second_count", "change",
    ) == [("S", 2, 2, 0)]


# --- popularity ----------------------------------------------------------------------------------


@pytest.fixture
def pop(popular):
    def make(*made):
        return core.fct_article_popularity(stg_most_popular_articles(popular(*made)))

    return make


def test_age_buckets(pop):
    day = D(2024, 6, 1)
    ages = [0, 1, 7, 8, 30, 31, 365, 366, -3]
    made = [
        {"id": i, "snapshot_date": day, "published_date": str(day - dt.timedelta(days=a))}
        for i, a in enumerate(ages)
    ]
    made.append({"id": 99, "snapshot_date": day, "published_date": "unknown"})
    found = [(r[0], r[1]) for r in explore.popularity_age_buckets(pop(*made)).collect()]
    # Negative and unknown ages count as evergreen, whose smallest age then sorts first.
    assert found == [
        ("365+ days (evergreen)", 3),
        ("0 days (same day)", 1),
        ("1-7 days", 2),
        ("8-30 days", 2),
        ("31-365 days", 2),
    ]
    other = explore.popularity_age_buckets(
        pop(*made), [(0, 1, "0-1"), (2, 7, "1-7"), (8, 30, "7-30")], "30+"
    )
    assert dict(rows(other, "age_bucket", "article_count")) == {
        "0-1": 2, "1-7": 1, "7-30": 2, "30+": 5
    }


def test_facet_richness_leaves_organizations_out(pop):
    made = [
        {"id": 1, "org_facet": ["o"] * 20},
        {"id": 2, "des_facet": ["d"] * 3, "geo_facet": ["g"] * 2},
        {"id": 3, "per_facet": ["p"] * 10},
        {"id": 4, "per_facet": ["p"] * 11},
    ]
    found = [(r[0], r[1]) for r in explore.facet_richness(pop(*made)).collect()]
    assert found == [("No facets", 1), ("1-5 facets", 1), ("6-10 facets", 1), ("11+ facets", 1)]


def test_trending_summary_takes_the_newest_day_and_ten_sections(pop):
    made = [
        {"id": i, "snapshot_date": D(2024, 1, 2), "section": f"s{i:02d}"} for i in range(12)
    ] + [{"id": 50, "snapshot_date": D(2024, 1, 1), "section": "a"}]
    row = explore.trending_summary(pop(*made), D(2024, 1, 5)).first()
    assert (row["as_of_date"], row["trending_articles_count"]) == (D(2024, 1, 5), 12)
    assert row["sections_represented"] == 12
    assert row["top_sections"] == [f"s{i:02d}" for i in range(10)]


def test_daily_summary(pop):
    made = [
        {"id": 1, "snapshot_date": D(2024, 1, 2), "section": "b", "published_date": "2024-01-01"},
        {"id": 1, "snapshot_date": D(2024, 1, 2), "section": "a", "published_date": "2023-12-31"},
        {"id": 2, "snapshot_date": D(2024, 1, 2), "section": "b"},
    ]
    row = rollups.snapshot_daily_summary(pop(*made)).first()
    assert (row["unique_articles"], row["avg_age_of_popular"]) == (2, 1.5)
    assert row["sections_represented"] == ["a", "b"]


def test_correlation_needs_variation(pop):
    made = [
        {"id": i, "snapshot_date": D(2024, 1, d), "des_facet": ["x"] * i, "geo_facet": ["g"]}
        for i in range(1, 4)
        for d in range(1, i + 1)
    ]
    row = rollups.facet_correlation(pop(*made)).first()
    assert (row["articles"], row["description_corr"], row["geo_corr"]) == (3, 1.0, None)


# --- dashboard -----------------------------------------------------------------------------------


def test_filters(articles):
    stg = stg_archive_articles(
        articles(
            {"article_id": "1", "pub_date": D(2019, 5, 1), "word_count": 5, "section_name": "A",
             "keywords": [keyword("k")], "byline_person": [person("Ann", "Lee")]},
            {"article_id": "2", "pub_date": D(2019, 5, 2), "word_count": 0, "section_name": "A"},
            {"article_id": "3", "pub_date": D(1919, 5, 1), "word_count": 5, "section_name": "A"},
            {"article_id": "4", "pub_date": D(2019, 6, 1), "word_count": 9, "section_name": "B",
             "keywords": [keyword("k"), keyword("k"), keyword("m")]},
            {"article_id": "5", "word_count": 9},
        )
    )
    fct, today = core.fct_articles(stg), D(2020, 1, 1)

    def ids(chosen):
        return [r[0] for r in rows(dashboard.filtered(fct, stg, chosen, today), "article_id")]

    every = dashboard.ArticleFilter()
    assert ids(every) == ["1", "4"]
    assert ids(dashboard.ArticleFilter(sections=("B",))) == ["4"]
    assert ids(dashboard.ArticleFilter(end=D(2019, 5, 31))) == ["1"]
    assert ids(dashboard.ArticleFilter(keywords=("k",))) == ["1", "4"]
    assert ids(dashboard.ArticleFilter(keywords=("k",), authors=("Ann  Lee",))) == ["1"]
    assert ids(dashboard.ArticleFilter(authors=("Nobody",))) == []
    staged = dashboard.filtered(stg, stg, every, today)
    assert rows(dashboard.top_keywords(staged), "keyword_value", "article_count") == [
        ("k", 2), ("m", 1)
    ]
    assert rows(dashboard.top_authors(staged), "author_full_name") == [("Ann  Lee",)]
    assert dashboard.breakdown(dashboard.filtered(fct, stg, every, today)).count() == 4
    kept = dashboard.kept(fct)
    assert kept.dtypes == fct.dtypes and rows(kept, "article_id") == rows(fct, "article_id")
    assert "Scan parquet" in kept._jdf.queryExecution().executedPlan().toString().replace("FileScan", "Scan")


def test_display_texts(spark):
    df = spark.createDataFrame([(1234567.8,), (None,), (-1234.9,)], "x double")
    found = df.select(number_text("x"), number_text("x", 2), percent_text("x")).collect()
    assert [tuple(r) for r in found] == [
        ("1,234,567", "1,234,567.80", "1234567.8%"),
        ("N/A", "N/A", "N/A"),
        ("-1,234", "-1,234.90", "-1234.9%"),
    ]


def test_month_limits_clamp(spark):
    months = spark.createDataFrame([(D(2019, 2, 1),), (D(2019, 3, 1),)], "pub_month date")
    months = months.select(
        "pub_month",
        *[F.lit(0).alias(c) for c in ("total_articles", "avg_word_count", "pct_with_authors",
          "pct_with_keywords", "pct_with_multimedia", "unique_sections")],
    )
    # Five years before 29 February 2024 is 28 February 2019.
    found = explore.monthly_trend(months, D(2024, 2, 29))
    assert rows(found, "pub_month") == [(D(2019, 3, 1),)]
