"""Staging, unnesting, facts, dimensions and marts on small hand-made frames."""

import datetime as dt
import hashlib

import pytest
from conftest import keyword, person, rows

from newsmart.operators import checks
from newsmart.operators.flatten import authors_flattened, facets_flattened, keywords_flattened
from newsmart.operators.staging import stg_archive_articles, stg_most_popular_articles
from newsmart.plans import core, marts

D = dt.date


def test_staging_cleans(articles):
    stg = stg_archive_articles(
        articles(
            {"article_id": None, "section_name": "dropped"},
            {
                "article_id": "1",
                "pub_date": D(2020, 5, 6),
                "section_name": " \t Arts ",
                "news_desk": "  \n",
                "headline_main": "\tHead ",
                "snippet": "  ",
                "keywords": [keyword("k")],
                "multimedia_count_by_type": {"image": 1},
            },
            {"article_id": "2", "word_count": 7, "byline_person": [person()]},
        )
    )
    assert rows(stg, "article_id", "pub_year", "pub_month", "section_name", "news_desk",
                "type_of_material", "word_count") == [
        ("1", 2020, 5, "Arts", "Unknown", "Unknown", 0),
        ("2", None, None, "Unknown", "Unknown", "Unknown", 7),
    ]
    assert rows(stg, "headline_main", "snippet") == [("Head", ""), (None, None)]
    assert rows(stg, "article_id", "has_keywords", "has_authors", "has_multimedia") == [
        ("1", True, False, True),
        ("2", False, True, False),
    ]


def test_null_arrays_have_no_flags(articles):
    stg = stg_archive_articles(
        articles({"article_id": "1", "keywords": None, "byline_person": None})
    )
    assert rows(stg, "has_keywords", "has_authors") == [(False, False)]
    assert rows(core.fct_articles(stg), "author_count", "keyword_count") == [(0, 0)]
    assert rows(core.fct_articles(stg, True), "author_count", "keyword_count") == [(0, 0)]


def test_popular_staging_parses_dates(popular):
    stg = stg_most_popular_articles(
        popular(
            {"id": None},
            {"id": 1, "published_date": "2020-1-5", "updated": "2020-01-06 07:08:09"},
            {"id": 2, "published_date": "2023-13-45", "updated": "yesterday", "type": " "},
        )
    )
    assert rows(stg, "article_id", "published_date", "updated_at", "article_type") == [
        (1, D(2020, 1, 5), dt.datetime(2020, 1, 6, 7, 8, 9), "Unknown"),
        (2, None, None, "Unknown"),
    ]


def test_author_names(articles):
    stg = stg_archive_articles(
        articles(
            {
                "article_id": "1",
                "byline_person": [
                    person("Ann", "Lee"),
                    person("Ann", "Lee", "B."),
                    person(None, "Lee"),
                    person(None, None, "Only"),
                ],
            }
        )
    )
    # A missing middle name leaves two blanks; a person without first and last name is no author.
    assert rows(authors_flattened(stg), "author_full_name") == [
        ("Ann  Lee",), ("Ann B. Lee",), ("Lee",)
    ]
    assert rows(stg, "has_authors") == [(True,)]
    assert rows(core.fct_articles(stg), "author_count") == [(3,)]
    assert "qualifier" not in authors_flattened(stg, qualifier=False).columns


def test_keywords_keep_null_values(articles):
    stg = stg_archive_articles(
        articles(
            {"article_id": "1", "keywords": [keyword("a", major="Y"), keyword(None), keyword(" ")]},
            {"article_id": "2"},
        )
    )
    assert rows(keywords_flattened(stg), "article_id", "keyword_value", "keyword_major") == [
        ("1", " ", "N"), ("1", "a", "Y"), ("1", None, "N")
    ]
    assert rows(core.fct_articles(stg), "article_id", "keyword_count", "major_keyword_count") == [
        ("1", 3, 1), ("2", 0, 0)
    ]
    assert rows(core.dim_keywords(stg), "keyword_value") == [("a",)]


def test_facets(popular):
    stg = stg_most_popular_articles(
        popular({"id": 1, "des_facet": ["x", "x"], "org_facet": ["o"], "geo_facet": None})
    )
    assert rows(facets_flattened(stg), "facet_type", "facet_value") == [
        ("des_facet", "x"), ("des_facet", "x"), ("org_facet", "o")
    ]
    fact = core.fct_article_popularity(stg)
    assert rows(fact, "description_facet_count", "geo_facet_count") == [(2, 0)]


def test_popularity_age(popular):
    stg = stg_most_popular_articles(
        popular(
            {"id": 1, "snapshot_date": D(2024, 3, 1), "published_date": "2024-02-28"},
            {"id": 2, "snapshot_date": D(2024, 3, 1), "published_date": "2024-03-05"},
            {"id": 3, "snapshot_date": D(2024, 3, 1), "published_date": "?"},
        )
    )
    fact = core.fct_article_popularity(stg)
    assert rows(fact, "article_id", "days_since_published") == [(1, 2), (2, -4), (3, None)]
    assert "media_count_by_type" not in fact.columns


def _repeated(articles):
    """Article 1 stands there twice, with different keywords and dates."""
    ann = [person("Ann", "Lee")]
    return stg_archive_articles(
        articles(
            {"article_id": "1", "pub_date": D(2020, 1, 1), "word_count": 10, "section_name": "A",
             "keywords": [keyword("a")], "byline_person": ann},
            {"article_id": "1", "pub_date": D(2021, 1, 1), "word_count": 30, "section_name": "B",
             "keywords": [keyword("b"), keyword("c", major="Y")], "byline_person": ann},
            {"article_id": "2", "pub_date": D(2021, 6, 1), "word_count": 5, "section_name": "A",
             "byline_person": ann * 2},
        )
    )


def test_repeated_ids_share_their_counts(articles):
    stg = _repeated(articles)
    fct = core.fct_articles(stg)
    assert rows(fct, "article_id", "author_count", "keyword_count", "major_keyword_count") == [
        ("1", 2, 3, 1), ("1", 2, 3, 1), ("2", 2, 0, 0)
    ]
    assert rows(checks.unique_violations(stg, "article_id"), "value", "n_records") == [("1", 2)]


def test_author_mart_joins_every_fact_row(articles):
    stg = _repeated(articles)
    mart = marts.agg_author_performance(stg, core.fct_articles(stg))
    # Two author rows of article 1 meet its two fact rows: (10 + 30) * 2; article 2 counts twice.
    assert rows(
        mart, "author_full_name", "total_articles", "total_words_written", "avg_word_count",
        "longest_article_words", "years_active", "sections_written_for", "career_span_days",
        "avg_keywords_per_article", "articles_per_year",
    ) == [("Ann  Lee", 2, 90, 15.0, 30, 2, 2, 517, 2.0, 1.0)]


def test_unique_ids_give_the_same_fact_and_mart(articles):
    people = [person("Ann", "Lee"), person("Bob", "Ray", "X"), person(None, None, "no")]
    stg = stg_archive_articles(
        articles(
            *[
                {
                    "article_id": str(i),
                    "pub_date": D(2000 + i % 5, 1 + i % 12, 1),
                    "word_count": i * 7 % 50 if i % 4 else None,
                    "section_name": "AB"[i % 2],
                    "keywords": [keyword(f"k{j}", major="YN"[j % 2]) for j in range(i % 4)],
                    "byline_person": [people[j % 3] for j in range(i % 5)],
                }
                for i in range(40)
            ]
        )
    )
    slow, fast = core.fct_articles(stg), core.fct_articles(stg, unique_ids=True)
    assert rows(slow, *slow.columns) == rows(fast, *slow.columns)
    a = marts.agg_author_performance(stg, slow)
    b = marts.agg_author_performance(stg, slow, unique_ids=True)
    assert rows(a, *a.columns) == rows(b, *a.columns)


def test_equal_full_names_of_different_authors(articles):
    # Grouped by all three names, so the uniqueness check on the full name reports them.
    people = [person("A B C"), person("A", "C", "B")]
    stg = stg_archive_articles(articles({"article_id": "1", "byline_person": people}))
    mart = marts.agg_author_performance(stg, core.fct_articles(stg))
    assert rows(mart, "author_full_name", "firstname") == [("A B C", "A B C"), ("A B C", "A")]
    found = checks.unique_violations(mart, "author_full_name")
    assert rows(found, "value", "n_records") == [("A B C", 2)]


def test_surrogate_keys(articles):
    stg = stg_archive_articles(
        articles({"article_id": "1", "section_name": "Arts", "byline_person": [person("A", None)]})
    )
    key = hashlib.md5(b"Arts-Unknown").hexdigest()
    assert rows(core.dim_sections(stg), "section_key") == [(key,)]
    null = "_dbt_utils_surrogate_key_null_"
    text = f"A-{null}-{null}-{null}-A"
    assert rows(core.dim_authors(stg), "author_key") == [(hashlib.md5(text.encode()).hexdigest(),)]


def test_blank_author_names_are_no_dimension_rows(articles):
    stg = stg_archive_articles(articles({"article_id": "1", "byline_person": [person(" ", "")]}))
    assert rows(authors_flattened(stg), "author_full_name") == [("",)]
    assert core.dim_authors(stg).count() == 0


def test_monthly_mart(articles):
    stg = stg_archive_articles(
        articles(
            {"article_id": "1", "pub_date": D(2020, 5, 1), "word_count": 100, "news_desk": "x",
             "keywords": [keyword("a"), keyword("b")]},
            {"article_id": "2", "pub_date": D(2020, 5, 31), "section_name": "S"},
            {"article_id": "3", "pub_date": D(2020, 6, 1), "word_count": 7},
            {"article_id": "4"},
        )
    )
    months = marts.agg_articles_by_month(core.fct_articles(stg))
    by_month = {r["pub_month"]: r for r in months.collect()}
    may = by_month[D(2020, 5, 1)]
    # The zero put in for a missing word count takes part in the average.
    assert (may["total_articles"], may["avg_word_count"], may["max_word_count"]) == (2, 50.0, 100)
    assert (may["unique_sections"], may["unique_news_desks"]) == (2, 2)
    assert (may["pct_with_keywords"], may["avg_keywords_per_article"]) == (50.0, 1.0)
    assert by_month[None]["total_articles"] == 1 and len(by_month) == 3


def test_section_mart_compares_with_the_last_present_year(articles):
    days = [D(2015, 1, 1)] * 2 + [D(2018, 1, 1)] * 5 + [D(2019, 1, 1)]
    stg = stg_archive_articles(
        articles(
            *[
                {"article_id": str(i), "pub_date": d, "section_name": "S", "news_desk": "d"}
                for i, d in enumerate(days)
            ],
            {"article_id": "x", "pub_date": D(2018, 2, 2), "section_name": "T", "news_desk": "d"},
            {"article_id": "y", "section_name": "S", "news_desk": "d"},
        )
    )
    mart = marts.agg_section_trends(core.fct_articles(stg))
    dated = mart.where("pub_year is not null and section_name = 'S'")
    assert rows(dated, "pub_year", "article_count", "year_total", "pct_of_year_total",
                "prior_year_count", "yoy_change", "yoy_change_pct")[1:] == [
        (2018, 5, 6, 83.33, 2, 3, 150.0),
        (2019, 1, 1, 100.0, 5, -4, -80.0),
    ]
    # The undated year has no total, as an equi-join on the year would leave it.
    assert rows(mart.where("pub_year is null"), "article_count", "year_total") == [(1, None)]


def test_keyword_mart(articles):
    def art(i, year, *values):
        return {
            "article_id": f"{year}-{i}",
            "pub_date": D(year, 1, 1),
            "keywords": [keyword(v, name=n) for n, v in values],
        }

    stg = stg_archive_articles(
        articles(
            art(1, 2015, ("s", "a"), ("s", "a"), ("s", " "), ("s", None)),
            art(2, 2015, ("s", "a"), ("p", "b")),
            art(1, 2018, ("s", "a"), ("p", "b")),
            art(2, 2018, ("p", "b"), ("s", "new")),
            art(3, 2018, ("p", "b")),
        )
    )
    mart = marts.agg_keyword_trends(keywords_flattened(stg))
    found = {(r["keyword_value"], r["pub_year"]): r for r in mart.collect()}
    assert set(found) == {("a", 2015), ("b", 2015), ("a", 2018), ("b", 2018), ("new", 2018)}
    a, b, new = found["a", 2018], found["b", 2018], found["new", 2018]
    assert (found["a", 2015]["article_count"], found["a", 2015]["keyword_occurrences"]) == (2, 3)
    assert (b["article_count"], b["prior_year_count"], b["yoy_change_pct"]) == (3, 1, 200.0)
    assert (b["rank_in_year"], b["prior_year_rank"], b["rank_change"]) == (1, 2, 1)
    assert (a["yoy_change"], a["yoy_change_pct"]) == (-1, -50.0)
    # A new keyword has no prior rank and gets its negative rank as the change.
    assert (new["prior_year_count"], new["yoy_change"], new["yoy_change_pct"]) == (None, 1, None)
    assert new["rank_change"] == -new["rank_in_year"]
    assert {a["rank_in_year"], new["rank_in_year"]} == {2, 3}


def test_grain_check(articles):
    source = articles({"article_id": "1"}, {"article_id": None})
    assert rows(
        checks.grain_violations(source, stg_archive_articles(source)),
        "source_rows", "staging_rows", "difference",
    ) == [(2, 1, 1)]
    clean = articles({"article_id": "1"})
    assert checks.grain_violations(clean, stg_archive_articles(clean)).count() == 0


def test_other_checks(articles):
    source = articles({"article_id": "1"}, {"article_id": "1"}, {"article_id": None})
    assert rows(checks.unique_violations(source, "article_id"), "value") == [("1",)]
    assert checks.null_violations(source, "article_id").count() == 1
    assert checks.empty_violations(source).count() == 0
    assert rows(checks.empty_violations(source.where("false")), "total_rows") == [(0,)]
    report = checks.check_report({"fct_articles": core.fct_articles(stg_archive_articles(source))})
    assert rows(report, "check_kind", "column_name", "violations") == [
        ("not_null", "article_id", 0), ("not_null", "pub_date", 2), ("unique", "article_id", 1)
    ]
    with pytest.raises(ValueError):
        checks.check_report({})


def test_author_mart_needs_no_expand(articles):
    stg = stg_archive_articles(articles({"article_id": "1", "byline_person": [person("A", "B")]}))
    plan = marts.agg_author_performance(stg, core.fct_articles(stg))._jdf.queryExecution().executedPlan()
    assert "Expand" not in plan.toString()
