"""Postings and trigrams against filters on the rows themselves."""

import datetime as dt
import random
import uuid

import pytest
from conftest import keyword, person, rows

from newsmart.operators import indexes
from newsmart.operators.staging import stg_archive_articles
from newsmart.operators.tables import create_database, write_table
from newsmart.plans import dashboard, rollups

TODAY = dt.date(2021, 1, 1)


@pytest.fixture
def database(spark, tmp_path):
    name = f"index_{uuid.uuid4().hex[:8]}"
    create_database(spark, name, str(tmp_path))
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def some_articles(articles, first, last):
    r = random.Random(first)
    many = []
    for i in range(first, last):
        words = [None, " ", "hot", *[f"k{r.randrange(30)}" for _ in range(r.randrange(4))]]
        people = [person(f"A{r.randrange(9)}", r.choice(["Lee", None])), person(None, None), person("Ann", "Lee")]
        many.append(
            {
                "article_id": str(i % 57) if i % 11 else None, "pub_date": dt.date(2019, 1, 1 + i % 28), "word_count": 5,
                "keywords": [keyword(w) for w in r.sample(words, min(len(words), 3))] * (1 + i % 2),
                "byline_person": people[: r.randrange(4)],
            }
        )
    return stg_archive_articles(articles(*many))


def test_filters_by_postings_give_the_same_rows(spark, articles, database):
    one, two = some_articles(articles, 0, 60), some_articles(articles, 60, 100)
    index = indexes.Postings(spark, f"{database}.postings")
    index.build(one)
    index.add(two)
    index.add(two)  # a repeated load
    stg = one.unionByName(two)
    picks = [
        {"keywords": ("k1", "k2")}, {"keywords": (" ",)}, {"keywords": ("hot",), "authors": ("Ann  Lee",)},
        {"authors": ("A1  Lee", "A2")}, {"keywords": ("nothing",)}, {"keywords": ("", "k3' OR 1")}, {},
    ]
    found = 0
    for pick in picks:
        chosen = dashboard.ArticleFilter(**pick)
        plain = rows(dashboard.filtered(stg, stg, chosen, TODAY), "article_id", "pub_date")
        assert rows(dashboard.filtered(stg, stg, chosen, TODAY, index), "article_id", "pub_date") == plain
        found += len(plain)
    assert found > 100


def test_a_filter_by_postings_unnests_nothing_and_prunes(spark, articles, database):
    stg = some_articles(articles, 0, 40)
    index = indexes.Postings(spark, f"{database}.postings")
    index.build(stg)
    write_table(stg, f"{database}.stg")
    stored = spark.table(f"{database}.stg")
    chosen = dashboard.ArticleFilter(keywords=("k1",), authors=("Ann  Lee",))
    plan = lambda df: df._jdf.queryExecution().toString()
    assert "Generate" in plan(dashboard.filtered(stored, stored, chosen, TODAY).select("article_id"))
    quick = plan(dashboard.filtered(stored, stored, chosen, TODAY, index).select("article_id"))
    assert "Generate" not in quick and "byline_person" not in quick.split("== Physical Plan ==")[1]
    assert "EqualTo(term,k1)" in quick and "kind" in quick.split("PartitionFilters", 1)[1]


def test_postings_of_nothing(spark, articles, database):
    index = indexes.Postings(spark, f"{database}.postings")
    index.build(stg_archive_articles(articles()))
    assert index.articles(indexes.KEYWORD, ["a"]).collect() == []


NAMES = ["Ann Lee", "ann lee", "ANN", "An", "", "é日本語 x", "Joanna Leeds", "annle", "a%n_n", "nnn", "nn", None, "İstanbul", "Lee Ann", "aaaa"]


def test_candidates_hold_every_name_with_the_part(spark, database):
    index = indexes.Trigrams(spark, f"{database}.names")
    frame = lambda names: spark.createDataFrame([(n,) for n in names], "name string")
    index.build(frame(NAMES[:8] * 2))
    index.add(frame(NAMES[4:]))
    index.add(frame(NAMES[4:]))
    held = spark.table(f"{database}.names")
    assert held.count() == held.distinct().count()
    low = {n: r for n, r in spark.sql("SELECT n, lower(n) FROM VALUES ('İstanbul') t(n)").collect()}
    for part in ("ann", "ANN", "n l", "日本語", "nn l", "aaa", "aaaa", "aaaaa", "lee ann", "%n_", "zzz", "stan", "joanna leeds"):
        got = [r.term for r in index.candidates(part).collect()]
        assert len(got) == len(set(got))
        want = {n for n in NAMES if n is not None and part.lower() in low.get(n, n.lower())}
        assert want <= set(got) <= {n for n in NAMES if n}
    assert index.candidates("zzz").collect() == [] and index.candidates("an") is None and index.candidates("") is None


def test_leaderboard_by_trigrams(spark, database):
    columns = "author_full_name string, firstname string, lastname string, total_articles long, total_words_written long, first_year int, last_year int, years_active int, articles_per_year double"
    authors = spark.createDataFrame([(n, None, None, i, 1, 2000, 2001, 2, 1.0) for i, n in enumerate(NAMES)], columns)
    index = indexes.Trigrams(spark, f"{database}.names")
    index.build(authors.select("author_full_name"))
    for part in ("", "a", "an", "ann", "LEE", "zzz", "日本語"):
        plain = rollups.author_leaderboard(authors, part).collect()
        assert rollups.author_leaderboard(authors, part, index=index).collect() == plain
    assert len(rollups.author_leaderboard(authors, "lee", index=index).collect()) == 4
