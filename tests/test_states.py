"""Marts from the states of several loads against marts of all rows at once."""

import datetime as dt
import random

import pytest
from conftest import keyword, person, rows

from newsmart.operators.flatten import keywords_flattened
from newsmart.operators.staging import stg_archive_articles
from newsmart.operators.states import ARTICLES, RANKED, MartStates
from newsmart.plans import core, explore, marts


def some(articles, first, last):
    r = random.Random(first)
    many = []
    for i in range(first, last):
        words = [keyword(w) for w in r.choices(["hot", "a", "b", None, " ", f"k{r.randrange(20)}"], k=r.randrange(4))]
        day = dt.date(r.choice([2017, 2018, 2020]), r.randrange(1, 4), 3)
        many.append(
            {
                "article_id": str(i % 50) if i % 13 else None, "pub_date": day if i % 17 else None, "word_count": r.choice([None, 1, 5, 5, 9, 400]),
                "section_name": r.choice(["U.S.", "Arts", None]), "news_desk": r.choice(["x", None]), "keywords": words,
                "byline_person": [person("Ann", "Lee")][: i % 2],
            }
        )
    return stg_archive_articles(articles(*many))


def parts(stg):
    return core.fct_articles(stg), keywords_flattened(stg, fields=("name", "value"))


@pytest.fixture
def kept(spark, tmp_path):
    return MartStates(spark, str(tmp_path / "states"))


def equal(got, want):
    assert sorted(got.columns) == sorted(want.columns)
    assert dict(got.dtypes) == dict(want.dtypes)
    assert rows(got, *sorted(got.columns)) == rows(want, *sorted(want.columns))


def test_three_loads_give_the_marts_of_all_rows(articles, kept):
    loads = [some(articles, 0, 40), some(articles, 40, 70), some(articles, 70, 90)]
    whole = None
    for k, stg in enumerate(loads):
        kept.add(f"load {k}", *parts(stg))
        if k != 1:
            kept.add(f"load {k}", *parts(stg))  # repeated after a stop
        whole = stg if whole is None else whole.unionByName(stg)
    # an id that comes in two loads has rows of its own in the fact here, as loads are merged before
    fct = parts(loads[0])[0].unionByName(parts(loads[1])[0]).unionByName(parts(loads[2])[0])
    keywords = parts(whole)[1]
    equal(kept.months(), marts.agg_articles_by_month(fct))
    equal(kept.keyword_trends(), marts.agg_keyword_trends(keywords))
    for more_than in (0, 25):
        equal(kept.word_count_quartiles(more_than), explore.word_count_quartiles(fct, more_than))
    assert kept.keyword_trends().where("pub_year IS NULL").count() > 0


def test_only_touched_years_are_ranked_again(articles, kept, tmp_path):
    stg = some(articles, 0, 60)
    kept.add("one", *parts(stg))
    files = lambda year: {f.name for f in (tmp_path / "states" / RANKED / f"pub_year={year}").glob("*.parquet")}
    before = {y: files(y) for y in (2017, 2018, 2020)}
    assert all(before.values())
    kept.add("two", *parts(some(articles, 60, 90).where("pub_year = 2018")))
    assert files(2018) != before[2018] and all(files(y) == before[y] for y in (2017, 2020))
    assert {r.load for r in kept.read(ARTICLES).where("pub_year = 2020").select("load").collect()} == {"one"}


def test_loads_of_nothing(articles, kept):
    stg = some(articles, 0, 20)
    kept.add("one", *parts(stg))
    want = rows(kept.keyword_trends(), "keyword_value", "pub_year", "rank_in_year")
    kept.add("two", *parts(stg.where("false")))
    assert rows(kept.keyword_trends(), "keyword_value", "pub_year", "rank_in_year") == want
