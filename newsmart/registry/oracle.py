"""SQL texts for DuckDB, one per registered query that SQL can express.

Each text is a body in front of which the shared relations it names are put as CTEs. The relations
are written from the test tables directly: cleaned values are stated as they must come out, keywords
and authors are flat from the start, and nothing repeats the steps of the Spark plans.
"""

from __future__ import annotations

import re

from newsmart.registry import load_oracle


def rnd(expr: str, digits: int) -> str:
    """Round half up on the decimal text of a double."""
    return f"CAST(round(CAST({expr} AS DECIMAL(38,12)), {digits}) AS DOUBLE)"


def share(a: str, b: str, digits: int) -> str:
    return rnd(f"100.0::DOUBLE * ({a}) / nullif({b}, 0)", digits)


def growth(now: str, before: str) -> str:
    return f"CASE WHEN {before} > 0 THEN {rnd(f'100.0::DOUBLE * ({now} - {before}) / {before}', 1)} END"


def number(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def mean(expr: str, digits: int) -> str:
    return rnd(f"avg({expr})", digits)


DECADE = "CAST(floor({} / 10) * 10 AS INTEGER)"
AS_OF = "DATE '2001-08-01'"
POPULAR_AS_OF = "DATE '2024-01-30'"

BASE: dict[str, str] = {
    # article keywords as they stand in the source, one row per array entry
    "kw": """
      SELECT okey, rank, name, value, major
      FROM (SELECT DISTINCT l_orderkey AS okey, CAST(l_linenumber AS BIGINT) AS rank,
                   lower(p_type) AS name,
                   CASE p_brand WHEN 'Brand#7' THEN NULL WHEN 'Brand#13' THEN ' '
                                ELSE p_brand || ' ' || p_name END AS value,
                   CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS major
            FROM lineitem JOIN part ON l_partkey = p_partkey),
           range(2) twice(t)
      WHERE t = 0 OR rank % 4 = 0""",
    # article persons, one row per array entry
    "persons": """
      SELECT okey,
             CASE WHEN no % 5 <> 0 THEN 'F' || (no % 10) END AS firstname,
             CASE WHEN no % 25 <> 0 THEN 'Author#' || lpad(CAST(no AS VARCHAR), 9, '0') END AS lastname,
             CASE WHEN no % 3 = 0 THEN 'M' || no END AS middlename,
             CAST(NULL AS VARCHAR) AS qualifier
      FROM (SELECT DISTINCT l_orderkey AS okey, l_suppkey AS no FROM lineitem), range(2) twice(t)
      WHERE t = 0 OR no % 6 = 1""",
    "media": """
      SELECT l_orderkey AS okey, l_linestatus AS kind, count(*) AS n
      FROM lineitem GROUP BY ALL""",
    # cleaned articles without their arrays
    "art": """
      SELECT o_orderkey AS okey,
             'a' || o_orderkey AS article_id,
             'press://article/' || o_orderkey AS uri,
             CAST(o_orderdate AS DATE) AS pub_date,
             CAST(year(o_orderdate) AS INTEGER) AS pub_year,
             CAST(month(o_orderdate) AS INTEGER) AS pub_month,
             CASE WHEN o_orderkey % 17 = 0 OR o_orderkey % 19 = 0 THEN 'Unknown'
                  ELSE coalesce(c_mktsegment, 'Unknown') END AS section_name,
             CASE WHEN o_orderkey % 29 = 0 THEN 'Unknown' ELSE o_orderpriority END AS news_desk,
             CASE o_orderstatus WHEN 'O' THEN 'News' WHEN 'F' THEN 'Op-Ed' WHEN 'P' THEN 'Review'
                  ELSE 'Unknown' END AS type_of_material,
             'article' AS document_type,
             CASE WHEN o_orderkey % 13 = 0 THEN 0
                  ELSE CAST(floor(o_totalprice) AS BIGINT) % 5000 END AS word_count,
             'https://press.example/a/' || o_orderkey AS web_url,
             'Report ' || o_orderkey AS headline_main,
             'By ' || o_orderpriority AS byline_original,
             CASE WHEN o_orderkey % 7 <> 0 THEN 'Abstract of ' || o_orderkey END AS abstract,
             (o_orderkey % 100) || ' lines' AS snippet,
             o_orderkey IN (SELECT okey FROM kw) AS has_keywords,
             o_orderkey IN (SELECT okey FROM persons) AS has_authors,
             o_orderkey IN (SELECT okey FROM media) AS has_multimedia
      FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
    "ukw": """
      SELECT article_id, pub_date, pub_year, section_name, name AS keyword_name,
             value AS keyword_value, rank AS keyword_rank, major AS keyword_major
      FROM kw JOIN art USING (okey)""",
    "uau": """
      SELECT article_id, pub_date, pub_year, section_name, firstname, middlename, lastname,
             qualifier,
             trim(coalesce(firstname, '') || ' ' || coalesce(middlename, '') || ' '
                  || coalesce(lastname, '')) AS author_full_name
      FROM persons JOIN art USING (okey)
      WHERE firstname IS NOT NULL OR lastname IS NOT NULL""",
    "fct": """
      SELECT article_id, uri, pub_date, pub_year, pub_month, section_name, news_desk,
             type_of_material, document_type, word_count,
             coalesce(authors, 0) AS author_count,
             coalesce(keywords, 0) AS keyword_count,
             coalesce(majors, 0) AS major_keyword_count,
             headline_main, byline_original, abstract, web_url,
             has_keywords, has_authors, has_multimedia
      FROM art
      LEFT JOIN (SELECT article_id, count(*) AS authors FROM uau GROUP BY 1) USING (article_id)
      LEFT JOIN (SELECT article_id, count(*) AS keywords,
                        count(*) FILTER (keyword_major = 'Y') AS majors
                 FROM ukw GROUP BY 1) USING (article_id)""",
    "spop": f"""
      SELECT snapshot_date, user_id AS article_id,
             'press://popular/' || user_id AS uri, event_id AS asset_id,
             CASE WHEN user_id % 31 <> 30
                  THEN CAST(snapshot_date - CAST(user_id * 7 % 500 AS INTEGER) AS DATE)
             END AS published_date,
             strftime(ts, '%Y-%m-%d %H:%M:%S') AS updated_at,
             CASE WHEN user_id % 4 = 0 THEN 'Unknown' ELSE 'Press' END AS source,
             CASE WHEN user_id % 9 = 0 THEN 'Unknown' ELSE event_type END AS section,
             CASE WHEN user_id % 2 = 0 THEN 'Unknown' ELSE 'sub' || (user_id % 3) END AS subsection,
             CASE WHEN event_id % 3 = 0 THEN 'Interactive' ELSE 'Article' END AS article_type,
             'Title ' || user_id AS title, 'About ' || event_id AS abstract,
             'By user ' || user_id AS byline, 'https://press.example/p/' || user_id AS url,
             k, CASE WHEN k % 6 <> 0 THEN 'image=' || (k % 3 + 1) END AS media_count_by_type,
             'k=' || k AS adx_keywords
      FROM (SELECT CAST(ts AS DATE) AS snapshot_date, user_id, max(event_id) AS event_id, max(ts) AS ts,
                   arg_max(event_type, event_id) AS event_type,
                   CAST(sum(CAST(regexp_extract(props, '"k": (\\d+)', 1) AS BIGINT)) AS BIGINT) AS k
            FROM events GROUP BY ALL) e""",
    "ufacet": """
      SELECT snapshot_date, article_id, facet_type,
             'Brand#' || (1 + (article_id + shift + i) % 25) || ' red widget' AS facet_value, i
      FROM spop,
           (VALUES ('des_facet', 4, 0), ('org_facet', 3, 5), ('per_facet', 7, 10),
                   ('geo_facet', 5, 15)) f(facet_type, modulus, shift),
           range(6) r(i)
      WHERE i < k % modulus""",
    "fpop": """
      SELECT snapshot_date, article_id, uri, asset_id, published_date, updated_at,
             CAST(snapshot_date - published_date AS INTEGER) AS days_since_published,
             source, section, subsection, article_type, title, abstract, byline, url,
             CAST(k % 4 AS INTEGER) AS description_facet_count,
             CAST(k % 3 AS INTEGER) AS organization_facet_count,
             CAST(k % 7 AS INTEGER) AS person_facet_count,
             CAST(k % 5 AS INTEGER) AS geo_facet_count,
             adx_keywords
      FROM spop""",
    "by_month": f"""
      SELECT CAST(date_trunc('month', pub_date) AS DATE) AS pub_month,
             count(*) AS total_articles,
             {mean('word_count', 0)} AS avg_word_count,
             {number('sum(word_count)')} AS total_word_count,
             max(word_count) AS max_word_count,
             count(*) FILTER (has_authors) AS articles_with_authors,
             count(*) FILTER (has_keywords) AS articles_with_keywords,
             count(*) FILTER (has_multimedia) AS articles_with_multimedia,
             {mean('author_count', 2)} AS avg_authors_per_article,
             {mean('keyword_count', 2)} AS avg_keywords_per_article,
             count(DISTINCT section_name) AS unique_sections,
             count(DISTINCT news_desk) AS unique_news_desks,
             count(DISTINCT type_of_material) AS unique_material_types,
             {share('count(*) FILTER (has_authors)', 'count(*)', 1)} AS pct_with_authors,
             {share('count(*) FILTER (has_keywords)', 'count(*)', 1)} AS pct_with_keywords,
             {share('count(*) FILTER (has_multimedia)', 'count(*)', 1)} AS pct_with_multimedia
      FROM fct GROUP BY 1""",
    "author_mart": f"""
      SELECT author_full_name, firstname, lastname,
             count(DISTINCT article_id) AS total_articles,
             min(u.pub_date) AS first_article_date, max(u.pub_date) AS last_article_date,
             CAST(max(u.pub_date) - min(u.pub_date) AS INTEGER) AS career_span_days,
             count(DISTINCT u.pub_year) AS years_active,
             min(u.pub_year) AS first_year, max(u.pub_year) AS last_year,
             {mean('word_count', 0)} AS avg_word_count,
             {number('sum(word_count)')} AS total_words_written,
             max(word_count) AS longest_article_words,
             count(DISTINCT u.section_name) AS sections_written_for,
             {mean('keyword_count', 1)} AS avg_keywords_per_article,
             {rnd('count(DISTINCT article_id)::DOUBLE / nullif(count(DISTINCT u.pub_year), 0)', 1)}
               AS articles_per_year
      FROM uau u JOIN fct USING (article_id)
      GROUP BY author_full_name, firstname, lastname""",
    "section_mart": f"""
      SELECT section_name, news_desk, pub_year, article_count, year_total,
             {share('article_count', 'year_total', 2)} AS pct_of_year_total,
             avg_word_count, total_word_count, articles_with_authors, articles_with_keywords,
             avg_authors, avg_keywords, prior_year_count,
             article_count - coalesce(prior_year_count, 0) AS yoy_change,
             {growth('article_count', 'prior_year_count')} AS yoy_change_pct
      FROM (
        SELECT *, lag(article_count) OVER (PARTITION BY section_name, news_desk ORDER BY pub_year)
                    AS prior_year_count
        FROM (
          SELECT section_name, news_desk, pub_year, count(*) AS article_count,
                 {mean('word_count', 0)} AS avg_word_count,
                 {number('sum(word_count)')} AS total_word_count,
                 count(*) FILTER (has_authors) AS articles_with_authors,
                 count(*) FILTER (has_keywords) AS articles_with_keywords,
                 {mean('author_count', 2)} AS avg_authors,
                 {mean('keyword_count', 2)} AS avg_keywords
          FROM fct GROUP BY 1, 2, 3)
        JOIN (SELECT pub_year, count(*) AS year_total FROM fct GROUP BY 1) USING (pub_year))""",
    "kw_year": """
      SELECT keyword_name, keyword_value, pub_year,
             count(DISTINCT article_id) AS article_count, count(*) AS keyword_occurrences
      FROM ukw WHERE trim(keyword_value) <> '' GROUP BY 1, 2, 3""",
    "kw_mart": f"""
      SELECT keyword_name, keyword_value, pub_year, article_count, keyword_occurrences,
             rank_in_year, prior_year_count,
             article_count - coalesce(prior_year_count, 0) AS yoy_change,
             {growth('article_count', 'prior_year_count')} AS yoy_change_pct,
             prior_year_rank, coalesce(prior_year_rank, 0) - rank_in_year AS rank_change
      FROM (
        SELECT *, lag(article_count) OVER past AS prior_year_count,
               lag(rank_in_year) OVER past AS prior_year_rank
        FROM (SELECT *, row_number() OVER (
                     PARTITION BY pub_year
                     ORDER BY article_count DESC, md5(keyword_name || '-' || keyword_value))
                     AS rank_in_year
              FROM kw_year)
        WINDOW past AS (PARTITION BY keyword_name, keyword_value ORDER BY pub_year))""",
    "today": "SELECT * FROM fpop WHERE snapshot_date = (SELECT max(snapshot_date) FROM fpop)",
    "facets_now": """
      SELECT facet_type, facet_value FROM ufacet
      WHERE snapshot_date = (SELECT max(snapshot_date) FROM fpop)""",
    "sticky": """
      SELECT article_id, count(DISTINCT snapshot_date) AS days_listed,
             min(snapshot_date) AS first_listed, max(snapshot_date) AS last_listed,
             avg(description_facet_count) AS avg_description_facet_count,
             avg(geo_facet_count) AS avg_geo_facet_count,
             avg(person_facet_count) AS avg_person_facet_count,
             avg(organization_facet_count) AS avg_organization_facet_count
      FROM fpop GROUP BY 1""",
    "monthly_z": """
      SELECT pub_month, total_articles, mean_articles, stddev_articles,
             (total_articles - mean_articles) / nullif(stddev_articles, 0) AS z
      FROM by_month, (SELECT avg(total_articles) AS mean_articles,
                             stddev_samp(total_articles) AS stddev_articles FROM by_month)""",
    "shown": f"""
      SELECT * FROM fct
      WHERE pub_date BETWEEN {AS_OF} - INTERVAL 100 YEAR AND {AS_OF} AND word_count <> 0""",
    "picked": """
      SELECT * FROM shown
      WHERE pub_date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'
        AND section_name IN ('BUILDING', 'MACHINERY', 'Unknown')
        AND news_desk IN ('1-URGENT', '2-HIGH', 'Unknown')
        AND type_of_material IN ('News', 'Op-Ed')""",
    "kw_2000": "SELECT * FROM kw_mart WHERE pub_year = 2000",
    "kw_latest": "SELECT * FROM kw_mart WHERE pub_year = (SELECT max(pub_year) FROM kw_mart)",
    "sec_2000": "SELECT * FROM section_mart WHERE pub_year = 2000",
    "both_periods": """
      SELECT article_id, section_name, word_count, author_count, keyword_count,
             pub_date BETWEEN DATE '1996-01-01' AND DATE '1997-12-31' AS a,
             pub_date BETWEEN DATE '1999-01-01' AND DATE '2000-12-31' AS b
      FROM fct""",
    **load_oracle.BASE,
}

TEXT_KEYWORDS = """(SELECT string_agg(concat_ws(':', rank, name, coalesce(value, '~'), major), '|'
                     ORDER BY rank, name, value NULLS FIRST, major)
                   FROM kw WHERE kw.okey = art.okey)"""
TEXT_PERSONS = """(SELECT string_agg(concat_ws(':', coalesce(firstname, '~'), coalesce(lastname, '~'),
                     coalesce(middlename, '~'), '~'), '|'
                     ORDER BY firstname NULLS FIRST, lastname NULLS FIRST, middlename NULLS FIRST)
                  FROM persons WHERE persons.okey = art.okey)"""
TEXT_MEDIA = """(SELECT string_agg(kind || '=' || n, ',' ORDER BY kind)
                FROM media WHERE media.okey = art.okey)"""


def _facet_text(facet: str) -> str:
    return f"""coalesce((SELECT string_agg(facet_value, '|' ORDER BY i) FROM ufacet u
                 WHERE u.snapshot_date = p.snapshot_date AND u.article_id = p.article_id
                   AND facet_type = '{facet}'), '') AS {facet}"""


FACET_TEXTS = ", ".join(_facet_text(f) for f in ("des_facet", "org_facet", "per_facet", "geo_facet"))


def _dimension(key: str, columns: str, rel: str, where: str) -> str:
    parts = " || '-' || ".join(
        f"coalesce({c}, '_dbt_utils_surrogate_key_null_')" for c in columns.split(", ")
    )
    return f"SELECT DISTINCT md5({parts}) AS {key}, {columns} FROM {rel} WHERE {where}"


def _top(rel: str, columns: str, order: str, n: int) -> str:
    return f"SELECT {columns} FROM {rel} ORDER BY {order} LIMIT {n}"


NAME = "author_full_name, firstname, lastname"
FCT = "SELECT * FROM fct"
AUTHOR_MART = "SELECT * FROM author_mart"


def _unique(table: str, column: str, rel: str) -> str:
    return f"""SELECT 'unique' AS check_kind, '{table}' AS table_name, '{column}' AS column_name,
      (SELECT count(*) FROM (SELECT {column} FROM {rel} WHERE {column} IS NOT NULL
                             GROUP BY 1 HAVING count(*) > 1)) AS violations"""


def _not_null(table: str, column: str, rel: str) -> str:
    return f"""SELECT 'not_null' AS check_kind, '{table}' AS table_name, '{column}' AS column_name,
      (SELECT count(*) FROM {rel} WHERE {column} IS NULL) AS violations"""


DIM_AUTHORS = _dimension(
    "author_key",
    "firstname, middlename, lastname, qualifier, author_full_name",
    "uau",
    "trim(author_full_name) <> ''",
)
DIM_KEYWORDS = _dimension(
    "keyword_key", "keyword_name, keyword_value", "ukw", "trim(keyword_value) <> ''"
)


def _by_article(rows: str, *columns: str) -> str:
    texts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in ("pub_year", "section_name", *columns))
    part = f"CAST('0x' || substr(md5(concat_ws('|', {texts})), 1, 12) AS BIGINT)"
    return f"SELECT article_id, pub_date, count(*) AS n, {number(f'sum({part})')} AS hash_sum FROM {rows} GROUP BY 1, 2"


DIM_SECTIONS = _dimension("section_key", "section_name, news_desk", "art", "true")

RELATIONS = {
    "stg_archive_articles": "art",
    "stg_most_popular_articles": "spop",
    "fct_articles": "fct",
    "fct_article_popularity": "fpop",
    "dim_authors": f"({DIM_AUTHORS})",
    "dim_keywords": f"({DIM_KEYWORDS})",
    "dim_sections": f"({DIM_SECTIONS})",
    "agg_articles_by_month": "by_month",
    "agg_author_performance": "author_mart",
}


def _check_rows() -> str:
    from newsmart.operators.checks import NOT_NULL, UNIQUE

    rows = [_unique(t, c, RELATIONS[t]) for t, c in UNIQUE]
    rows += [_not_null(t, c, RELATIONS[t]) for t, c in NOT_NULL]
    return " UNION ALL ".join(rows)


BODIES: dict[str, str] = {
    "p1_stg_archive_articles": f"""
      SELECT article_id, uri, pub_date, pub_year, pub_month, section_name, news_desk,
             type_of_material, document_type, word_count, web_url, headline_main, byline_original,
             abstract, snippet, coalesce({TEXT_KEYWORDS}, '') AS keywords,
             coalesce({TEXT_PERSONS}, '') AS byline_person,
             {TEXT_MEDIA} AS multimedia_count_by_type, has_keywords, has_authors, has_multimedia
      FROM art""",
    "p2_stg_most_popular_articles": f"""
      SELECT p.* EXCLUDE (k), {FACET_TEXTS} FROM spop p""",
    "u1_int_keywords_flattened": "SELECT * FROM ukw",
    "u2_int_authors_flattened": "SELECT * FROM uau",
    "u1_keywords_by_article": _by_article("ukw", "keyword_name", "keyword_value", "keyword_rank", "keyword_major"),
    "u2_authors_by_article": _by_article("uau", "firstname", "middlename", "lastname", "qualifier", "author_full_name"),
    "u3_facets_flattened": "SELECT * EXCLUDE (i) FROM ufacet",
    "c1_fct_articles": FCT,
    "c1_fct_articles_any_ids": FCT,
    "c2_fct_article_popularity": f"SELECT p.*, {FACET_TEXTS} FROM fpop p",
    "c3_dim_authors": DIM_AUTHORS,
    "c4_dim_keywords": DIM_KEYWORDS,
    "c5_dim_sections": DIM_SECTIONS,
    "a1_agg_articles_by_month": "SELECT * FROM by_month",
    "a2_agg_author_performance": AUTHOR_MART,
    "a2_agg_author_performance_any_ids": AUTHOR_MART,
    "a3_agg_section_trends": "SELECT * FROM section_mart",
    "a4_keyword_year_stats": "SELECT * FROM kw_year",
    "a4_agg_keyword_trends": "SELECT * FROM kw_mart",
    "q01_archive_profile": f"""
      SELECT 'fct_articles' AS table_name, count(*) AS total_records,
             min(pub_date) AS earliest_date, max(pub_date) AS latest_date,
             count(DISTINCT section_name) AS unique_sections,
             count(DISTINCT news_desk) AS unique_desks,
             {mean('word_count', 0)} AS avg_word_count,
             {mean('author_count', 2)} AS avg_author_count,
             {mean('keyword_count', 2)} AS avg_keyword_count
      FROM fct""",
    "q02_popularity_profile": f"""
      SELECT 'fct_article_popularity' AS table_name, count(*) AS total_records,
             min(snapshot_date) AS earliest_snapshot, max(snapshot_date) AS latest_snapshot,
             count(DISTINCT article_id) AS unique_articles,
             {mean('days_since_published', 1)} AS avg_days_since_published
      FROM fpop""",
    "q03_articles_per_year": f"""
      SELECT pub_year, count(*) AS article_count, {mean('word_count', 0)} AS avg_word_count,
             count(DISTINCT section_name) AS sections_active
      FROM fct GROUP BY 1 ORDER BY 1 DESC LIMIT 50""",
    "q04_monthly_trend": f"""
      SELECT pub_month, total_articles, avg_word_count, pct_with_authors, pct_with_keywords,
             pct_with_multimedia, unique_sections
      FROM by_month WHERE pub_month >= {AS_OF} - INTERVAL 5 YEAR""",
    "q05_busiest_months": _top(
        "by_month",
        "pub_month, total_articles, avg_word_count, unique_sections, "
        "CAST(year(pub_month) AS INTEGER) AS year, CAST(month(pub_month) AS INTEGER) AS month",
        "total_articles DESC, pub_month",
        20,
    ),
    "q06_word_count_by_decade": f"""
      SELECT {DECADE.format('pub_year')} AS decade, count(*) AS article_count,
             {mean('word_count', 0)} AS avg_word_count,
             {rnd('stddev_samp(word_count)', 0)} AS stddev_word_count,
             min(word_count) AS min_word_count, max(word_count) AS max_word_count
      FROM fct GROUP BY 1""",
    "q07_top_sections": f"""
      SELECT section_name, count(*) AS article_count, {mean('word_count', 0)} AS avg_word_count,
             count(DISTINCT pub_year) AS years_active,
             min(pub_date) AS first_article, max(pub_date) AS last_article
      FROM fct GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 30""",
    "q08_section_growth": _top(
        "sec_2000",
        "section_name, pub_year, article_count, prior_year_count, yoy_change, yoy_change_pct, "
        "pct_of_year_total",
        "yoy_change_pct DESC NULLS LAST, section_name, news_desk",
        30,
    ),
    "q09_sections_by_decade": f"""
      SELECT {DECADE.format('pub_year')} AS decade, section_name,
             {number('sum(article_count)')} AS total_articles,
             {mean('avg_word_count', 0)} AS avg_word_count
      FROM section_mart GROUP BY 1, 2 HAVING sum(article_count) > 1000""",
    "q10_news_desks": f"""
      SELECT news_desk, count(*) AS article_count,
             count(DISTINCT section_name) AS sections_covered,
             {mean('word_count', 0)} AS avg_word_count,
             min(pub_date) AS first_article, max(pub_date) AS last_article
      FROM fct GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 30""",
    "q11_top_keywords": f"""
      SELECT keyword_value, keyword_name, {number('sum(article_count)')} AS total_articles,
             min(pub_year) AS first_appeared, max(pub_year) AS last_appeared,
             count(DISTINCT pub_year) AS years_active
      FROM kw_mart GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 50""",
    "q12_recent_keywords": f"""
      SELECT keyword_value, keyword_name, {number('sum(article_count)')} AS total_articles,
             avg(article_count) AS avg_articles_per_year
      FROM kw_mart WHERE pub_year >= 1996 GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 50""",
    "q13_fastest_keywords": """
      SELECT keyword_value, keyword_name, pub_year, article_count, prior_year_count, yoy_change,
             yoy_change_pct, rank_in_year
      FROM kw_mart WHERE pub_year IN (1999, 2000) AND article_count > 5 AND yoy_change_pct > 50
      ORDER BY yoy_change_pct DESC, 1, 2, 3 LIMIT 30""",
    "q14_top_keywords_per_decade": f"""
      SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY decade ORDER BY total_articles DESC, keyword_value)
                    AS rank_in_decade
        FROM (SELECT {DECADE.format('pub_year')} AS decade, keyword_value,
                     {number('sum(article_count)')} AS total_articles
              FROM kw_mart GROUP BY 1, 2))
      WHERE rank_in_decade <= 5""",
    "q15_tracked_keywords": """
      SELECT keyword_value, pub_year, article_count, rank_in_year FROM kw_mart
      WHERE lower(keyword_value) IN ('brand#1 red widget', 'brand#2 blue bolt', 'brand#3 small ring')""",
    "q16_prolific_authors": _top(
        "author_mart",
        "author_full_name, total_articles, first_article_date, last_article_date, years_active, "
        "articles_per_year, avg_word_count, total_words_written, sections_written_for, "
        "first_year, last_year",
        f"total_articles DESC, {NAME}",
        50,
    ),
    "q17_productive_authors": _top(
        "author_mart WHERE years_active >= 5",
        "author_full_name, total_articles, years_active, articles_per_year, first_year, last_year",
        f"articles_per_year DESC, {NAME}",
        30,
    ),
    "q18_versatile_authors": _top(
        "author_mart",
        "author_full_name, sections_written_for, total_articles, years_active, avg_word_count",
        f"sections_written_for DESC, total_articles DESC, {NAME}",
        30,
    ),
    "q19_longest_careers": _top(
        "author_mart",
        "author_full_name, first_year, last_year, years_active, career_span_days, total_articles, "
        "articles_per_year",
        f"career_span_days DESC, {NAME}",
        30,
    ),
    "q20_longest_articles": _top(
        "author_mart",
        "author_full_name, longest_article_words, avg_word_count, total_articles",
        f"longest_article_words DESC, {NAME}",
        30,
    ),
    "q21_author_debuts": f"""
      SELECT {DECADE.format('first_year')} AS debut_decade, count(*) AS new_authors
      FROM author_mart GROUP BY 1""",
    "q22_recent_popular": _top(
        f"fpop WHERE snapshot_date >= {POPULAR_AS_OF} - 7",
        "snapshot_date, title, section, published_date, days_since_published, url, byline, "
        "description_facet_count, person_facet_count, geo_facet_count",
        "snapshot_date DESC, days_since_published NULLS FIRST, article_id",
        100,
    ),
    "q23_popularity_age_buckets": f"""
      SELECT CASE WHEN days_since_published = 0 THEN '0 days (same day)'
                  WHEN days_since_published > 0 AND days_since_published <= 7 THEN '1-7 days'
                  WHEN days_since_published > 7 AND days_since_published <= 30 THEN '8-30 days'
                  WHEN days_since_published > 30 AND days_since_published <= 365 THEN '31-365 days'
                  ELSE '365+ days (evergreen)' END AS age_bucket,
             count(*) AS article_count, {mean('days_since_published', 1)} AS avg_days_old
      FROM fpop GROUP BY 1""",
    "q24_evergreen": _top(
        "fpop WHERE days_since_published > 365",
        "title, section, published_date, snapshot_date, days_since_published, url",
        "days_since_published DESC, snapshot_date, article_id",
        50,
    ),
    "q25_popular_sections": f"""
      SELECT section, count(DISTINCT article_id) AS unique_popular_articles,
             count(*) AS total_appearances, {mean('days_since_published', 1)} AS avg_age_when_popular
      FROM fpop GROUP BY 1""",
    "q26_facet_richness": f"""
      SELECT CASE WHEN n = 0 THEN 'No facets' WHEN n <= 5 THEN '1-5 facets'
                  WHEN n <= 10 THEN '6-10 facets' ELSE '11+ facets' END AS facet_bucket,
             count(*) AS article_count,
             {mean('description_facet_count', 1)} AS avg_description_facets,
             {mean('geo_facet_count', 1)} AS avg_geo_facets,
             {mean('person_facet_count', 1)} AS avg_person_facets
      FROM (SELECT *, description_facet_count + geo_facet_count + person_facet_count AS n FROM fpop)
      GROUP BY 1""",
    "q27_event_years": f"""
      SELECT pub_year, count(*) AS article_count, {mean('word_count', 0)} AS avg_word_count,
             count(DISTINCT section_name) AS sections_active,
             CASE pub_year WHEN 1996 THEN 'Early' WHEN 1998 THEN 'Middle' WHEN 2000 THEN 'Late' END
               AS historical_context
      FROM fct WHERE pub_year IN (1996, 1998, 2000, 2001) GROUP BY 1""",
    "q28_keyword_evolution": """
      SELECT pub_year, keyword_value, article_count, rank_in_year, yoy_change_pct FROM kw_mart
      WHERE regexp_matches(lower(keyword_value), 'red widget|brand#4 |small ring')""",
    "q29_author_count_buckets": f"""
      SELECT CASE author_count WHEN 0 THEN 'No attribution' WHEN 1 THEN 'Single author'
                  WHEN 2 THEN '2 authors' WHEN 3 THEN '3 authors' ELSE '4+ authors' END
               AS author_bucket,
             count(*) AS article_count,
             {share('count(*)', '(SELECT count(*) FROM fct)', 2)} AS pct_of_total
      FROM fct GROUP BY 1""",
    "q30_collaboration_by_year": f"""
      SELECT pub_year, count(*) AS total_articles,
             count(*) FILTER (author_count = 0) AS no_author,
             count(*) FILTER (author_count = 1) AS single_author,
             count(*) FILTER (author_count = 2) AS two_authors,
             count(*) FILTER (author_count > 2) AS three_plus_authors,
             {share('count(*) FILTER (author_count > 1)', 'count(*)', 2)} AS pct_collaborative
      FROM fct GROUP BY 1 ORDER BY 1 DESC LIMIT 50""",
    "q31_keyword_density": f"""
      SELECT section_name, count(*) AS article_count, {mean('keyword_count', 2)} AS avg_keywords,
             {mean('major_keyword_count', 2)} AS avg_major_keywords,
             {share('count(*) FILTER (has_keywords)', 'count(*)', 2)} AS pct_with_keywords
      FROM fct GROUP BY 1 HAVING count(*) > 1000""",
    "q32_word_count_quartiles": f"""
      SELECT section_name, count(*) AS article_count, min(word_count) AS min_words,
             quantile_disc(word_count, 0.25) AS p25_words,
             quantile_disc(word_count, 0.5) AS median_words,
             quantile_disc(word_count, 0.75) AS p75_words,
             max(word_count) AS max_words, {mean('word_count', 0)} AS avg_words
      FROM fct GROUP BY 1 HAVING count(*) > 1000""",
    "q33_monthly_outliers": f"""
      SELECT pub_month, total_articles, mean_articles, stddev_articles, {rnd('z', 2)} AS z_score
      FROM monthly_z WHERE abs(z) > 3""",
    "q34_sudden_keywords": """
      SELECT keyword_value, keyword_name, pub_year AS first_year,
             article_count AS first_year_count
      FROM (SELECT *, row_number() OVER (PARTITION BY keyword_value ORDER BY pub_year, keyword_name)
                        AS nth FROM kw_mart)
      WHERE nth = 1 AND article_count > 4
      ORDER BY article_count DESC, 1, 2 LIMIT 50""",
    "q35_trending_summary": f"""
      SELECT {POPULAR_AS_OF} AS as_of_date, count(DISTINCT article_id) AS trending_articles_count,
             {mean('days_since_published', 1)} AS avg_article_age,
             count(DISTINCT section) AS sections_represented,
             (SELECT string_agg(section, '|' ORDER BY section)
              FROM (SELECT DISTINCT section FROM today ORDER BY 1 LIMIT 10)) AS top_sections
      FROM today""",
    "q36_header_metrics": """
      SELECT count(*) AS total_articles, (SELECT count(*) FROM author_mart) AS total_authors,
             count(DISTINCT section_name) AS total_sections,
             CAST(year(max(pub_date)) - year(min(pub_date)) AS INTEGER) AS years_of_coverage,
             max(pub_date) AS latest_article_date,
             (SELECT max(snapshot_date) FROM fpop) AS latest_snapshot_date
      FROM fct""",
    "q37_sparkline": f"""
      SELECT pub_month, total_articles, avg_word_count, pct_with_keywords, unique_sections
      FROM by_month WHERE pub_month >= {AS_OF} - INTERVAL 12 MONTH""",
    "r01_snapshot_daily_summary": """
      SELECT snapshot_date, count(DISTINCT article_id) AS unique_articles,
             avg(days_since_published) AS avg_age_of_popular,
             string_agg(DISTINCT section, '|' ORDER BY section) AS sections_represented
      FROM fpop GROUP BY 1""",
    "r02_keyword_cooccurrence": """
      SELECT a.keyword_value AS keyword_1, b.keyword_value AS keyword_2,
             count(DISTINCT a.article_id) AS cooccurrence_count
      FROM ukw a JOIN ukw b ON a.article_id = b.article_id AND a.keyword_value < b.keyword_value
      GROUP BY 1, 2 HAVING count(DISTINCT a.article_id) >= 2""",
    "r02_keyword_cooccurrence_3_articles": """
      SELECT a.keyword_value AS keyword_1, b.keyword_value AS keyword_2,
             count(DISTINCT a.article_id) AS cooccurrence_count
      FROM ukw a JOIN ukw b ON a.article_id = b.article_id AND a.keyword_value < b.keyword_value
      GROUP BY 1, 2 HAVING count(DISTINCT a.article_id) >= 3""",
    "r03_keyword_spikes": """
      SELECT keyword_value, pub_year, article_count, prior_year_count, yoy_change_pct
      FROM kw_mart WHERE yoy_change_pct > 300 AND article_count > 3""",
    "r04_top_keyword_values": f"""
      SELECT keyword_value, {number('sum(article_count)')} AS total_articles
      FROM kw_mart GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 50""",
    "r05_trending_keywords": _top(
        "kw_2000",
        "keyword_value, article_count, yoy_change_pct",
        "yoy_change_pct DESC NULLS LAST, keyword_value, keyword_name",
        30,
    ),
    "r06_section_composition": f"""
      SELECT pub_year, section_name, count(*) AS article_count,
             {share('count(*)', 'any_value(t)', 2)} AS pct_of_year
      FROM fct JOIN (SELECT pub_year, count(*) AS t FROM fct GROUP BY 1) USING (pub_year)
      GROUP BY 1, 2""",
    "r06_latest_section_distribution": """
      SELECT section_name, news_desk, pub_year, article_count, yoy_change_pct, pct_of_year_total
      FROM section_mart WHERE pub_year = (SELECT max(pub_year) FROM section_mart)""",
    "r07_growing_and_declining_sections": """
      SELECT section_name, news_desk, article_count, prior_year_count, yoy_change_pct, direction
      FROM (SELECT *, CASE WHEN yoy_change_pct > 0 THEN 'growing' ELSE 'declining' END AS direction,
                   row_number() OVER (PARTITION BY yoy_change_pct > 0
                     ORDER BY abs(yoy_change_pct) DESC, section_name, news_desk) AS nth
            FROM sec_2000 WHERE yoy_change_pct <> 0)
      WHERE nth <= 10""",
    "r08_section_year_matrix": """
      SELECT section_name, pub_year, count(*) AS article_count FROM fct GROUP BY 1, 2""",
    "r09_rank_history": """
      SELECT keyword_name, keyword_value, pub_year, rank_in_year, article_count
      FROM kw_mart WHERE (keyword_name, keyword_value) IN
        (SELECT (keyword_name, keyword_value) FROM kw_latest WHERE rank_in_year <= 10)""",
    "r10_top_keywords_per_year": """
      SELECT pub_year, rank_in_year, keyword_name, keyword_value, article_count
      FROM kw_mart WHERE rank_in_year <= 20""",
    "r11_keyword_momentum": """
      SELECT keyword_value, keyword_name, article_count, yoy_change_pct, keyword_occurrences,
             CASE WHEN yoy_change_pct >= growth THEN 'Rising Stars'
                  WHEN article_count < volume THEN 'Niche'
                  WHEN yoy_change_pct < 0 THEN 'Declining' ELSE 'Established' END AS quadrant
      FROM kw_latest, (SELECT quantile_disc(article_count, 0.5) AS volume,
                              quantile_disc(yoy_change_pct, 0.5) AS growth
                       FROM kw_latest WHERE yoy_change_pct IS NOT NULL)
      WHERE yoy_change_pct IS NOT NULL""",
    "r12_keyword_weights": f"""
      SELECT keyword_value, article_count,
             {rnd('article_count::DOUBLE / max(article_count) OVER ()', 4)} AS weight
      FROM (SELECT keyword_value, {number('sum(article_count)')} AS article_count
            FROM kw_latest GROUP BY 1)""",
    "r13_declining_keywords": """
      SELECT keyword_value, keyword_name, article_count, prior_year_count, yoy_change,
             yoy_change_pct, rank_in_year, prior_year_rank, rank_change
      FROM kw_2000 WHERE yoy_change < 0""",
    "r14_career_histogram": """
      SELECT CAST(years_active // 2 * 2 AS INTEGER) AS years_from, count(*) AS authors
      FROM author_mart GROUP BY 1""",
    "r15_power_authors": """
      SELECT author_full_name, total_articles, years_active, articles_per_year,
             sections_written_for
      FROM author_mart WHERE articles_per_year >= 5 AND years_active >= 5""",
    "r15_specialists_and_generalists": f"""
      SELECT CASE WHEN sections_written_for = 1 THEN 'specialist' ELSE 'generalist' END
               AS author_kind,
             count(*) AS authors, {mean('articles_per_year', 2)} AS avg_articles_per_year,
             {mean('total_articles', 2)} AS avg_total_articles
      FROM author_mart GROUP BY 1""",
    "r16_popularity_decay": """
      SELECT days_since_published, count(*) AS article_count FROM fpop
      WHERE days_since_published IS NOT NULL GROUP BY 1""",
    "r17_article_stickiness": "SELECT * FROM sticky",
    "r17_facet_correlation": f"""
      SELECT count(*) AS articles,
             {rnd('corr(avg_description_facet_count, days_listed)', 6)} AS description_corr,
             {rnd('corr(avg_geo_facet_count, days_listed)', 6)} AS geo_corr,
             {rnd('corr(avg_person_facet_count, days_listed)', 6)} AS person_corr,
             {rnd('corr(avg_organization_facet_count, days_listed)', 6)} AS organization_corr
      FROM sticky""",
    "r18_busiest_years": """
      SELECT pub_year, count(*) AS article_count FROM fct GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""",
    "r19_month_year_heatmap": """
      SELECT pub_year, pub_month, count(*) AS article_count FROM fct GROUP BY 1, 2""",
    "r20_author_share_by_year": f"""
      SELECT pub_year, count(*) FILTER (author_count = 1) AS one_author,
             count(*) FILTER (author_count = 2) AS two_authors,
             count(*) FILTER (author_count = 3) AS three_authors,
             count(*) FILTER (author_count > 3) AS four_plus_authors,
             {share('count(*) FILTER (author_count > 1)', 'count(*) FILTER (author_count > 0)', 2)}
               AS pct_multi_author
      FROM fct GROUP BY 1""",
    "r21_popular_today": _top(
        "today",
        "snapshot_date, article_id, title, section, days_since_published, url",
        "days_since_published NULLS LAST, article_id",
        20,
    ),
    "r22_facets_today": """
      SELECT facet_type, facet_value, count(*) AS frequency FROM facets_now GROUP BY 1, 2""",
    "r23_compare_sections": """
      SELECT section_name, count(*) FILTER (a) AS first_count, count(*) FILTER (b) AS second_count,
             count(*) FILTER (b) - count(*) FILTER (a) AS change
      FROM both_periods WHERE a OR b GROUP BY 1""",
    "r23_compare_keywords": """
      SELECT keyword_value, count(DISTINCT article_id) FILTER (a) AS first_count,
             count(DISTINCT article_id) FILTER (b) AS second_count,
             count(DISTINCT article_id) FILTER (b) - count(DISTINCT article_id) FILTER (a) AS change
      FROM ukw JOIN both_periods USING (article_id)
      WHERE (a OR b) AND trim(keyword_value) <> ''
      GROUP BY 1""",
    "r23_compare_lengths": " UNION ALL ".join(
        f"""SELECT '{period}' AS period, count(*) AS article_count,
             {mean('word_count', 0)} AS avg_word_count, max(word_count) AS max_word_count,
             {mean('author_count', 2)} AS avg_authors, {mean('keyword_count', 2)} AS avg_keywords
           FROM both_periods WHERE {flag}"""
        for period, flag in (("first", "a"), ("second", "b"))
    ),
    "r23_section_change_by_decade": f"""
      SELECT section_name, decade, article_count, prior_decade_count,
             article_count - prior_decade_count AS change
      FROM (SELECT *, lag(article_count) OVER (PARTITION BY section_name ORDER BY decade)
                        AS prior_decade_count
            FROM (SELECT section_name, {DECADE.format('pub_year')} AS decade,
                         count(*) AS article_count FROM fct GROUP BY 1, 2))""",
    "r24_metadata_completeness": f"""
      SELECT pub_year, count(*) AS total_articles,
             {share('count(*) FILTER (has_authors)', 'count(*)', 1)} AS pct_with_authors,
             {share('count(*) FILTER (has_keywords)', 'count(*)', 1)} AS pct_with_keywords,
             {share('count(*) FILTER (has_multimedia)', 'count(*)', 1)} AS pct_with_multimedia
      FROM fct GROUP BY 1""",
    "r25_materials_by_year": """
      SELECT pub_year, type_of_material, count(*) AS article_count FROM fct GROUP BY 1, 2""",
    "r25_opinion_share": f"""
      SELECT pub_year, count(*) AS total_articles,
             count(*) FILTER (type_of_material = 'Op-Ed') AS opinion_articles,
             count(*) FILTER (type_of_material = 'News') AS news_articles,
             {share("count(*) FILTER (type_of_material = 'Op-Ed')", 'count(*)', 2)} AS pct_opinion,
             {share("count(*) FILTER (type_of_material = 'News')", 'count(*)', 2)} AS pct_news
      FROM fct GROUP BY 1""",
    "r26_section_popularity_bias": f"""
      SELECT section, archive_pct, popular_pct, {rnd('popular_pct - archive_pct', 2)} AS bias
      FROM (
        SELECT coalesce(a.section, p.section) AS section,
               coalesce({share('a.n', '(SELECT count(*) FROM fct)', 2)}, 0) AS archive_pct,
               coalesce({share('p.n', '(SELECT count(*) FROM fpop)', 2)}, 0) AS popular_pct
        FROM (SELECT section_name AS section, count(*) AS n FROM fct GROUP BY 1) a
        FULL JOIN (SELECT section, count(*) AS n FROM fpop GROUP BY 1) p
          ON a.section = p.section)""",
    "r27_landing_totals": """
      SELECT count(*) AS total_articles, (SELECT count(*) FROM author_mart) AS total_authors,
             CAST(year(max(pub_date)) - year(min(pub_date)) AS INTEGER) AS years_of_coverage,
             (SELECT title FROM today ORDER BY days_since_published NULLS LAST, article_id LIMIT 1)
               AS current_most_popular
      FROM fct""",
    "r28_author_leaderboard": _top(
        "author_mart WHERE contains(lower(author_full_name), 'author#00000001')",
        "author_full_name, total_articles, total_words_written, first_year, last_year, "
        "years_active, articles_per_year",
        f"total_articles DESC, {NAME}",
        50,
    ),
    "r29_election_cycle": f"""
      SELECT CAST(pub_year % 4 AS INTEGER) AS cycle_year, count(DISTINCT pub_year) AS years,
             {number('sum(article_count)')} AS article_count,
             {mean('article_count', 2)} AS avg_per_keyword
      FROM kw_mart WHERE contains(keyword_value, 'widget') GROUP BY 1""",
    "r30_facets_against_history": f"""
      SELECT facet_value, frequency_today, archive_articles, first_year, last_year
      FROM (SELECT facet_value, count(*) AS frequency_today FROM facets_now GROUP BY 1)
      LEFT JOIN (SELECT keyword_value, {number('sum(article_count)')} AS archive_articles,
                        min(pub_year) AS first_year, max(pub_year) AS last_year
                 FROM kw_mart GROUP BY 1) ON facet_value = keyword_value""",
    "r31_news_desk_volume": """
      SELECT news_desk, pub_year, count(*) AS article_count,
             count(DISTINCT section_name) AS sections_covered
      FROM fct GROUP BY 1, 2""",
    "r31_news_desk_structure": """
      SELECT news_desk, min(pub_year) AS first_year, max(pub_year) AS last_year,
             count(DISTINCT pub_year) AS years_active, count(*) AS article_count
      FROM fct GROUP BY 1""",
    "r32_yearly_spikes": f"""
      SELECT pub_year, article_count, neighbour_avg,
             {rnd('article_count / neighbour_avg', 2)} AS factor
      FROM (SELECT a.pub_year, a.n AS article_count, avg(b.n) AS neighbour_avg
            FROM (SELECT pub_year, count(*) AS n FROM fct GROUP BY 1) a
            JOIN (SELECT pub_year, count(*) AS n FROM fct GROUP BY 1) b
              ON abs(a.pub_year - b.pub_year) = 1
            GROUP BY 1, 2)
      WHERE article_count / neighbour_avg > 1""",
    "d1_default_articles": f"""
      SELECT article_id, pub_date, word_count FROM fct
      WHERE pub_date BETWEEN {AS_OF} - INTERVAL 4 YEAR AND {AS_OF} AND word_count <> 0""",
    "d2_filtered_articles": """
      SELECT article_id, pub_date, section_name, news_desk, type_of_material, word_count
      FROM picked""",
    "d3_people_and_topics": """
      SELECT article_id, section_name, word_count FROM shown
      WHERE article_id IN (SELECT article_id FROM uau WHERE author_full_name IN
              ('F1  Author#000000001', 'F2  Author#000000002', 'F1  Author#000000011'))
        AND article_id IN (SELECT article_id FROM ukw WHERE keyword_value IN
              ('Brand#1 red widget', 'Brand#2 blue bolt', 'Brand#3 small ring', ' '))""",
    "d4_articles_by_month": f"""
      SELECT CAST(date_trunc('month', pub_date) AS DATE) AS pub_month,
             count(*) AS total_articles, {mean('word_count', 0)} AS avg_word_count
      FROM picked GROUP BY 1""",
    "d5_breakdown": " UNION ALL ".join(
        f"SELECT '{c}' AS dimension, {c} AS member, count(*) AS article_count FROM picked GROUP BY 2"
        for c in ("section_name", "news_desk", "type_of_material")
    ),
    "d7_kept_breakdown": " UNION ALL ".join(
        f"SELECT '{c}' AS dimension, {c} AS member, count(*) AS article_count FROM picked GROUP BY 2"
        for c in ("section_name", "news_desk", "type_of_material")
    ),
    "d7_cached_breakdowns": " UNION ALL ".join(
        f"SELECT '{c}' AS dimension, {c} AS member, count(*) AS article_count, step, step = 'kept' AS was_kept "
        "FROM picked JOIN (VALUES ('made', 1998), ('kept', 1998), ('changed', 3000), ('expired', 3000)) t(step, upto) "
        "ON pub_year < upto GROUP BY 2, 4, 5"
        for c in ("section_name", "news_desk", "type_of_material")
    ),
    "d6_top_lists": """
      (SELECT keyword_value AS member, count(DISTINCT article_id) AS article_count,
              'keyword' AS list
       FROM ukw WHERE trim(keyword_value) <> '' AND article_id IN (SELECT article_id FROM picked)
       GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10)
      UNION ALL
      (SELECT author_full_name, count(DISTINCT article_id), 'author'
       FROM uau WHERE article_id IN (SELECT article_id FROM picked)
       GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10)""",
    "f1_display_texts": """
      SELECT pub_month, format('{:,}', total_word_count) AS words_text,
             format('{:,.2f}', avg_keywords_per_article) AS keywords_text,
             format('{:.1f}%', pct_with_authors) AS authors_text,
             CASE WHEN month(pub_month) = 1 THEN 'N/A' ELSE format('{:,}', total_articles) END
               AS articles_text
      FROM by_month""",
    "v1_v2_declared_checks": _check_rows(),
    "v1_repeated_days": """
      SELECT pub_date AS value, count(*) AS n_records FROM art GROUP BY 1 HAVING count(*) > 1""",
    "v2_missing_abstracts": "SELECT article_id FROM art WHERE abstract IS NULL",
    "v3_source_not_empty": "SELECT * FROM (SELECT count(*) AS total_rows FROM orders) WHERE total_rows = 0",
    "v3_source_without_early_articles": """
      SELECT * FROM (SELECT count(*) AS total_rows FROM orders WHERE o_orderdate < DATE '1990-01-01')
      WHERE total_rows = 0""",
    "v4_same_grain": """
      SELECT count(*) AS source_rows, count(*) AS staging_rows, count(*) - count(*) AS difference
      FROM orders HAVING count(*) <> (SELECT count(*) FROM art)""",
    "v4_grain_of_rows_with_media": """
      SELECT count(*) AS source_rows, count(*) FILTER (has_multimedia) AS staging_rows,
             count(*) FILTER (NOT has_multimedia) AS difference
      FROM art HAVING count(*) FILTER (NOT has_multimedia) > 0""",
    **load_oracle.BODIES,
}


def _needs(text: str) -> list[str]:
    """Shared relations a text uses, each after the ones it is built from."""
    found: list[str] = []
    for name in BASE:
        if re.search(rf"(?:FROM|JOIN|,)\s+{name}\b", text):
            for inner in [*_needs(BASE[name]), name]:
                if inner not in found:
                    found.append(inner)
    return found


def compose(body: str) -> str:
    names = _needs(body)
    if not names:
        return body.strip()
    ctes = ",\n".join(f"{n} AS ({BASE[n].strip()})" for n in names)
    return f"WITH {ctes}\n{body.strip()}"


# The same rows by way of an index.
BODIES["d3_by_postings"] = BODIES["d3_people_and_topics"]
BODIES["r28_leaderboard_by_trigrams"] = BODIES["r28_author_leaderboard"]
BODIES["r29_cycle_by_trigrams"] = BODIES["r29_election_cycle"]

# The same rows from the states of several loads.
BODIES["a1_months_of_three_loads"] = BODIES["a1_agg_articles_by_month"]
BODIES["a4_trends_of_three_loads"] = BODIES["a4_agg_keyword_trends"]
BODIES["q32_quartiles_of_three_loads"] = BODIES["q32_word_count_quartiles"]

#: Their rows are compared one by one by verify.py; a digest of each article's rows has a name of its own.
MANY_ROWS = ("u1_int_keywords_flattened", "u2_int_authors_flattened")


def full_sql() -> dict[str, str]:
    return {name: compose(body) for name, body in BODIES.items()}


def all_sql() -> dict[str, str]:
    """SQL of all queries but those with very many rows."""
    return {name: text for name, text in full_sql().items() if name not in MANY_ROWS}
