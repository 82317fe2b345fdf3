"""Registered queries: every one has SQL, and a selection agrees with it on the smallest tables."""

import re

import duckdb
import pytest

import __spark_entry__ as entry_points
from newsmart.registry.oracle import MANY_ROWS, full_sql
from verify import TABLES, TYPES, ordered

SF = "/root/testdata/sf0.001"
CHOSEN = (
    "p1_stg_archive_articles p2_stg_most_popular_articles c1_fct_articles c1_fct_articles_any_ids "
    "a1_agg_articles_by_month a2_agg_author_performance a3_agg_section_trends "
    "a4_agg_keyword_trends q14_top_keywords_per_decade q32_word_count_quartiles "
    "q33_monthly_outliers r01_snapshot_daily_summary r02_keyword_cooccurrence d6_top_lists "
    "t1_slim_articles k6_insert_only_merge k14_upsert u1_keywords_by_article d7_cached_breakdowns "
    "k6_merge_by_key_index k11_interleaved_desks k15_incremental_fct s9_replayed_batch s10_listed_in_steps"
).split()


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


def test_every_query_has_sql():
    own = lambda names: {n for n in names if not re.match(r"op\d+_|pipeline$", n)}
    assert own(entry_points.queries()) == own(entry_points.oracle_sql()) | set(MANY_ROWS) == own(full_sql())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("name", CHOSEN)
def test_agrees_with_sql(spark, con, name):
    df = entry_points.queries()[name](spark, SF)
    result = con.execute(entry_points.oracle_sql()[name])
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    kinds = {r[0]: r[1] for r in con.execute(f"DESCRIBE {entry_points.oracle_sql()[name]}").fetchall()}
    assert {c: TYPES[t] for c, t in df.dtypes} == kinds
    assert ordered([tuple(r) for r in df.collect()], df.columns) == ordered(expected, names)
