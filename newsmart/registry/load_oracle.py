"""SQL for the registered queries of the ingest path, straight from the test tables."""

from __future__ import annotations


def _texts(flags: str) -> str:
    return f"""(SELECT string_agg(concat_ws(':', rank, name, coalesce(value, '~'), major), '|'
                 ORDER BY rank, name, value NULLS FIRST, major)
               FROM kw WHERE kw.okey = {flags}.okey)"""


PERSON_TEXT = """(SELECT string_agg(concat_ws(':', coalesce(firstname, '~'), coalesce(lastname, '~'),
                   coalesce(middlename, '~'), '~'), '|'
                   ORDER BY firstname NULLS FIRST, lastname NULLS FIRST, middlename NULLS FIRST)
                 FROM persons WHERE persons.okey = raw_docs.okey AND raw_docs.okey % 11 <> 0)"""

BASE: dict[str, str] = {
    # docs that can be read, before validation
    "raw_docs": """
      SELECT o_orderkey AS okey, 'a' || o_orderkey AS article_id,
             CAST(o_orderdate AS DATE) AS day,
             CAST(year(o_orderdate) AS INTEGER) AS year,
             CAST(month(o_orderdate) AS INTEGER) AS month,
             CASE WHEN o_orderkey % 41 = 0 THEN '12x' WHEN o_orderkey % 43 = 0 THEN '12.5'
                  WHEN o_orderkey % 47 = 0 THEN '120.0'
                  WHEN o_orderkey % 59 = 0 THEN '12.00000000001'
                  WHEN o_orderkey % 13 <> 0 THEN CAST(CAST(floor(o_totalprice) AS BIGINT) % 5000 AS VARCHAR)
             END AS words_text,
             CASE WHEN o_orderkey % 17 = 0 THEN '  ' WHEN o_orderkey % 19 = 0 THEN NULL
                  WHEN o_orderkey % 23 = 0 THEN ' ' || c_mktsegment || ' ' ELSE c_mktsegment END
               AS section_name,
             CASE WHEN o_orderkey % 29 <> 0 THEN o_orderpriority END AS news_desk,
             CASE o_orderstatus WHEN 'O' THEN 'News' WHEN 'F' THEN 'Op-Ed' WHEN 'P' THEN 'Review' END
               AS type_of_material,
             o_orderpriority,
             nullif(concat_ws(',',
               CASE o_orderkey % 3 WHEN 1 THEN 'image=1' WHEN 2 THEN 'image=2' END,
               CASE WHEN o_orderkey % 2 = 1 THEN 'video=1' END), '') AS media_text
      FROM orders LEFT JOIN customer ON o_custkey = c_custkey
      WHERE o_orderkey % 101 <> 0 AND o_orderkey % 53 <> 0""",
    "slim_docs": f"""
      SELECT article_id, 'press://article/' || okey AS uri,
             strftime(day, '%Y-%m-%d') || 'T05:00:00+0000' AS pub_date,
             day, year, month, section_name, news_desk, type_of_material,
             'article' AS document_type, CAST(CAST(words_text AS DOUBLE) AS BIGINT) AS word_count,
             'https://press.example/a/' || okey AS web_url,
             '  Report ' || okey || ' ' AS headline_main,
             'By ' || o_orderpriority AS byline_original,
             CASE WHEN okey % 7 <> 0 THEN 'Abstract of ' || okey END AS abstract,
             chr(9) || (okey % 100) || ' lines ' AS snippet,
             coalesce({_texts('raw_docs')}, '') AS keywords,
             coalesce({PERSON_TEXT}, '') AS byline_person,
             CASE WHEN okey % 10 <> 0 THEN media_text END AS multimedia_count_by_type
      FROM raw_docs WHERE NOT (okey % 41 = 0 OR okey % 43 = 0 OR (okey % 59 = 0 AND okey % 47 <> 0))""",
    "raw_results": """
      SELECT CAST(ts AS DATE) AS snapshot_date, user_id AS id, max(event_id) AS event_id,
             max(ts) AS ts, arg_max(event_type, event_id) AS event_type,
             CAST(sum(CAST(regexp_extract(props, '"k": (\\d+)', 1) AS BIGINT)) AS BIGINT) AS k
      FROM events GROUP BY CAST(ts AS DATE), user_id""",
    "slim_results": """
      SELECT r.snapshot_date, r.id, 'press://popular/' || r.id AS uri,
             'https://press.example/p/' || r.id AS url, event_id AS asset_id,
             CASE WHEN r.id % 4 <> 0 THEN 'Press' END AS source,
             CASE WHEN r.id % 31 = 30 THEN '2023-13-45'
                  ELSE strftime(r.snapshot_date - CAST(r.id * 7 % 500 AS INTEGER), '%Y-%m-%d') END
               AS published_date,
             strftime(ts, '%Y-%m-%d %H:%M:%S') AS updated,
             CASE WHEN r.id % 9 = 0 THEN ' ' ELSE event_type END AS section,
             CASE WHEN r.id % 2 = 0 THEN '' ELSE 'sub' || (r.id % 3) END AS subsection,
             ' By user ' || r.id AS byline,
             CASE WHEN event_id % 3 = 0 THEN 'Interactive' ELSE 'Article' END AS type,
             'Title ' || r.id || '  ' AS title, 'About ' || event_id AS abstract,
             'k=' || k AS adx_keywords,
             CASE WHEN r.id % 6 <> 0 THEN coalesce(des, '') ELSE '' END AS des_facet,
             coalesce(org, '') AS org_facet, coalesce(per, '') AS per_facet,
             coalesce(geo, '') AS geo_facet,
             CASE WHEN r.id % 4 > 0 THEN 'image=2' ELSE 'image=1' END AS media_count_by_type
      FROM raw_results r
      LEFT JOIN (
        SELECT snapshot_date, article_id AS id,
               string_agg(facet_value, '|' ORDER BY i) FILTER (facet_type = 'des_facet') AS des,
               string_agg(facet_value, '|' ORDER BY i) FILTER (facet_type = 'org_facet') AS org,
               string_agg(facet_value, '|' ORDER BY i) FILTER (facet_type = 'per_facet') AS per,
               string_agg(facet_value, '|' ORDER BY i) FILTER (facet_type = 'geo_facet') AS geo
        FROM ufacet GROUP BY 1, 2) f ON f.snapshot_date = r.snapshot_date AND f.id = r.id
      WHERE event_id % 37 <> 0""",
    # popularity rows of the loaded table
    "popular_src": """
      SELECT p.snapshot_date, p.article_id AS id, p.uri, p.url, p.asset_id,
             CASE WHEN p.article_id % 4 <> 0 THEN 'Press' END AS source,
             CASE WHEN p.article_id % 31 = 30 THEN '2023-13-45'
                  ELSE strftime(p.published_date, '%Y-%m-%d') END AS published_date,
             p.updated_at AS updated,
             CASE WHEN p.article_id % 9 = 0 THEN ' ' ELSE p.section END AS section,
             CASE WHEN p.article_id % 2 = 0 THEN '' ELSE p.subsection END AS subsection,
             ' By user ' || p.article_id AS byline, p.article_type AS type,
             p.title || '  ' AS title, p.abstract, p.adx_keywords, p.media_count_by_type,
             coalesce(string_agg(facet_value, '|' ORDER BY i)
                      FILTER (facet_type = 'des_facet'), '') AS des_facet,
             coalesce(string_agg(facet_value, '|' ORDER BY i)
                      FILTER (facet_type = 'org_facet'), '') AS org_facet,
             coalesce(string_agg(facet_value, '|' ORDER BY i)
                      FILTER (facet_type = 'per_facet'), '') AS per_facet,
             coalesce(string_agg(facet_value, '|' ORDER BY i)
                      FILTER (facet_type = 'geo_facet'), '') AS geo_facet
      FROM spop p LEFT JOIN ufacet u
        ON u.snapshot_date = p.snapshot_date AND u.article_id = p.article_id
      GROUP BY ALL""",
    # articles of the loaded table, uncleaned
    "src": """
      SELECT o_orderkey AS okey, 'a' || o_orderkey AS article_id,
             CAST(o_orderdate AS DATE) AS pub_date,
             CASE WHEN o_orderkey % 13 <> 0 THEN CAST(floor(o_totalprice) AS BIGINT) % 5000 END
               AS word_count
      FROM orders""",
}

SLIM = "SELECT * EXCLUDE (day, year, month) FROM slim_docs"
LOADED = "SELECT * EXCLUDE (day, year, month) REPLACE (day AS pub_date) FROM slim_docs"
PART = "strftime(pub_date, '%Y-%m') AS part_month"

BODIES: dict[str, str] = {
    "s1_s4_raw_archive_scan": "SELECT article_id, year, month, words_text AS word_count FROM raw_docs",
    "s2_raw_popular_scan": """
      SELECT snapshot_date, CAST(id AS VARCHAR) AS id,
             CASE WHEN event_id % 37 = 0 THEN 'none' ELSE CAST(event_id AS VARCHAR) END AS asset_id
      FROM raw_results""",
    "s1_raw_month_objects": """
      SELECT 'a' || o_orderkey AS article_id, CAST(year(o_orderdate) AS INTEGER) AS year,
             CAST(month(o_orderdate) AS INTEGER) AS month,
             CASE WHEN o_orderkey % 13 <> 0
                  THEN CAST(CAST(floor(o_totalprice) AS BIGINT) % 5000 AS VARCHAR) END AS word_count
      FROM orders WHERE o_orderkey % 101 <> 0""",
    "s2_raw_day_objects": """
      SELECT snapshot_date, CAST(id AS VARCHAR) AS id, CAST(event_id AS VARCHAR) AS asset_id
      FROM raw_results""",
    "s9_refused_files": """
      SELECT 'archive_slim' AS source, CAST(1995 AS INTEGER) AS year, CAST(2 AS INTEGER) AS month,
             CAST(NULL AS DATE) AS snapshot_date, 'word_count is not an integer' AS reason,
             CAST(1 AS BIGINT) AS files
      WHERE EXISTS (SELECT 1 FROM orders WHERE o_orderkey % 7 = 0 AND year(o_orderdate) = 1995
                    AND month(o_orderdate) = 2)
      UNION ALL
      SELECT 'most_popular_slim', NULL, NULL, DATE '2024-01-02', 'asset_id is not an integer', 1
      WHERE EXISTS (SELECT 1 FROM raw_results WHERE snapshot_date = DATE '2024-01-02')
      UNION ALL SELECT 'most_popular_slim', NULL, NULL, NULL, 'no snapshot date', 1""",
    "s9_replayed_batch": f"""
      SELECT {PART}, count(*) AS articles, count(*) FILTER (okey % 40 <> 0) AS with_id,
             count(DISTINCT CASE WHEN okey % 40 <> 0 THEN article_id END) AS ids
      FROM src WHERE pub_date < DATE '1996-01-01' GROUP BY 1""",
    # months before the last but one and days more than a week back are closed by the first run
    "s10_listed_in_steps": """
      SELECT feed, period, CAST(CASE WHEN shut THEN 1 ELSE 2 END AS BIGINT) AS times_listed
      FROM (
        SELECT DISTINCT 'archive_slim' AS feed, strftime(day, '%Y-%m') AS period,
               date_trunc('month', day) < date_trunc('month', d) - INTERVAL 1 MONTH AS shut
        FROM slim_docs, (SELECT max(snapshot_date) AS d FROM raw_results) t
        UNION SELECT 'most_popular_slim', strftime(snapshot_date, '%Y-%m-%d'), snapshot_date < d - INTERVAL 7 DAY
        FROM slim_results, (SELECT max(snapshot_date) AS d FROM raw_results) t)""",
    "k12_backfill_outcomes": """
      SELECT feed, CASE WHEN outcome = 'loaded' AND run = 2 THEN 'skipped' ELSE outcome END AS outcome,
             CAST(1 AS BIGINT) AS files, CAST(run AS INTEGER) AS run
      FROM (VALUES ('archive_slim', 'loaded'), ('archive_slim', 'error'),
                   ('most_popular_slim', 'loaded'), ('most_popular_slim', 'error'),
                   ('most_popular_slim', 'no snapshot date')) t(feed, outcome),
           (VALUES (1), (2)) r(run)""",
    "s3_s8_feed_folders": """
      SELECT 'archive_slim' AS feed, year, month, CAST(NULL AS DATE) AS snapshot_date
      FROM slim_docs
      UNION SELECT 'most_popular_slim', NULL, NULL, snapshot_date FROM slim_results""",
    "s5_popular_file_dates": """
      SELECT DISTINCT snapshot_date, 'pending' AS status FROM slim_results""",
    "s6_slim_archive_scan": """
      SELECT * EXCLUDE (day, year, month) REPLACE (CAST(word_count AS VARCHAR) AS word_count)
      FROM slim_docs""",
    "s7_slim_popular_scan": """
      SELECT * REPLACE (CAST(id AS VARCHAR) AS id, CAST(asset_id AS VARCHAR) AS asset_id)
      FROM slim_results""",
    "s9_streamed_archive": LOADED,
    "s9_streamed_popular": "SELECT * FROM slim_results",
    "s10_months_left": """
      SELECT DISTINCT year, month,
             CASE WHEN year < 1998 THEN 'loaded' ELSE 'pending' END AS status
      FROM slim_docs""",
    "s10_files_by_status": """
      SELECT * FROM (VALUES ('archive_slim', 'pending', CAST(2 AS BIGINT)), ('most_popular_slim', 'pending', 2),
                            ('most_popular_slim', 'no snapshot date', 1)) t(feed, status, files)""",
    "s11_declared_source": "SELECT * FROM popular_src",
    "k13_s12_layers": "SELECT * FROM by_month",
    "k16_full_refresh": "SELECT article_id, pub_date, keyword_count FROM fct",
    "t1_slim_articles": SLIM,
    "t2_slim_popular": "SELECT * FROM slim_results",
    "t3_media_counts": """
      SELECT article_id, CASE WHEN okey % 10 <> 0 THEN media_text END AS media FROM raw_docs""",
    "t5_rejected_articles": """
      SELECT 'malformed json' AS reject_reason, count(*) AS records
      FROM orders WHERE o_orderkey % 101 = 0
      UNION ALL
      SELECT 'word_count is not an integer', count(*) FROM raw_docs
      WHERE okey % 41 = 0 OR okey % 43 = 0 OR (okey % 59 = 0 AND okey % 47 <> 0)""",
    "t5_rejected_popular": """
      SELECT CAST(id AS VARCHAR) AS id, snapshot_date, 'asset_id is not an integer' AS reject_reason
      FROM raw_results WHERE event_id % 37 = 0""",
    "t7_archive_rows": "SELECT article_id, day AS pub_date, word_count FROM slim_docs",
    "k1_k2_slim_months": "SELECT year, month, count(*) AS articles FROM slim_docs GROUP BY 1, 2",
    "k2_overwritten_days": "SELECT snapshot_date, count(*) AS articles FROM slim_results GROUP BY 1",
    "k3_k6_loaded_archive": LOADED,
    "k5_k7_loaded_popular": "SELECT * FROM slim_results",
    "k6_insert_only_merge": f"""
      SELECT article_id, pub_date, {PART},
             CASE WHEN pub_date < DATE '1998-01-01' THEN word_count ELSE -1 END AS word_count
      FROM src""",
    "k6_merge_by_key_index": f"""
      SELECT article_id, pub_date, {PART},
             CASE WHEN pub_date < DATE '1998-01-01' THEN word_count ELSE -1 END AS word_count
      FROM src""",
    "k7_insert_only_merge_popular": """
      SELECT snapshot_date, id,
             CASE WHEN snapshot_date <= DATE '2024-01-15' THEN event_id ELSE -1 END AS asset_id
      FROM raw_results""",
    "k8_k9_manifest": """
      SELECT 'archive_slim' AS source, year, month, CAST(NULL AS DATE) AS snapshot_date,
             CAST(1 AS BIGINT) AS times_noted
      FROM slim_docs
      UNION SELECT 'most_popular_slim', NULL, NULL, snapshot_date, 1 FROM slim_results""",
    "k11_clustered_months": f"""
      SELECT article_id, pub_date, raw_docs_all.section_name, raw_docs_all.news_desk, word_count, {PART}
      FROM src JOIN (
        SELECT o_orderkey AS okey,
               CASE WHEN o_orderkey % 17 = 0 THEN '  ' WHEN o_orderkey % 19 = 0 THEN NULL
                    WHEN o_orderkey % 23 = 0 THEN ' ' || c_mktsegment || ' ' ELSE c_mktsegment END
                 AS section_name,
               CASE WHEN o_orderkey % 29 <> 0 THEN o_orderpriority END AS news_desk
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey) raw_docs_all USING (okey)
      WHERE pub_date BETWEEN DATE '1997-03-10' AND DATE '1997-04-20'""",
    "k11_interleaved_desks": """
      SELECT article_id, pub_date, section_name, o_orderpriority AS news_desk, word_count
      FROM src JOIN (
        SELECT o_orderkey AS okey, o_orderpriority,
               CASE WHEN o_orderkey % 17 = 0 THEN '  ' WHEN o_orderkey % 19 = 0 THEN NULL
                    WHEN o_orderkey % 23 = 0 THEN ' ' || c_mktsegment || ' ' ELSE c_mktsegment END
                 AS section_name
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey) o USING (okey)
      WHERE okey % 29 <> 0 AND o_orderpriority IN ('1-URGENT', '5-LOW')""",
    "k14_upsert": f"""
      SELECT article_id, pub_date, word_count, {PART}
      FROM (SELECT article_id,
                   CASE WHEN pub_date >= DATE '1998-01-01' THEN -1 ELSE word_count END AS word_count,
                   CASE WHEN pub_date >= DATE '1998-01-01'
                        THEN CAST(pub_date + INTERVAL 12 MONTH AS DATE) ELSE pub_date END AS pub_date
            FROM src)""",
    "k15_incremental_fct": f"""
      SELECT article_id, pub_date, word_count, author_count, keyword_count, {PART}
      FROM fct
      WHERE abstract IS NOT NULL
         OR pub_date > (SELECT max(pub_date) FROM art WHERE pub_year <= 1998 AND abstract IS NOT NULL)""",
}
