"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Thresholds, keyword lists and year labels that name real-world things are given values that occur
in the test tables; the functions' own defaults stay as they are. Arrays and maps are rendered as
text, so results compare column by column.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmart.functions.exprs import number_text, percent_text
from newsmart.operators import checks, results, tables
from newsmart.operators.flatten import facets_flattened
from newsmart.operators.indexes import Postings, Trigrams
from newsmart.operators.states import MartStates
from newsmart.plans import core, dashboard, explore, marts, rollups
from newsmart.registry import loads
from newsmart.registry.press import AS_OF, POPULAR_AS_OF, Press, press

Query = Callable[[SparkSession, str], DataFrame]

TRACKED = ("brand#1 red widget", "brand#2 blue bolt", "brand#3 small ring")
EVENT_YEARS = (1996, 1998, 2000, 2001)
EVENT_LABELS = ((1996, 1997, "Early"), (1998, 1998, "Middle"), (2000, 2000, "Late"))
FIRST = (dt.date(1996, 1, 1), dt.date(1997, 12, 31))
SECOND = (dt.date(1999, 1, 1), dt.date(2000, 12, 31))
CHOSEN = dashboard.ArticleFilter(
    start=dt.date(1996, 1, 1),
    end=dt.date(2000, 12, 31),
    sections=("BUILDING", "MACHINERY", "Unknown"),
    desks=("1-URGENT", "2-HIGH", "Unknown"),
    materials=("News", "Op-Ed"),
)
PEOPLE_AND_TOPICS = dashboard.ArticleFilter(
    authors=("F1  Author#000000001", "F2  Author#000000002", "F1  Author#000000011"),
    keywords=("Brand#1 red widget", "Brand#2 blue bolt", "Brand#3 small ring", " "),
)


def keywords_text(c: str = "keywords") -> Column:
    """``rank:name:value:major`` entries joined by ``|``, nulls as ``~``."""
    return F.array_join(
        F.transform(
            c,
            lambda k: F.concat_ws(
                ":",
                k["rank"].cast("string"),
                k["name"],
                F.coalesce(k["value"], F.lit("~")),
                k["major"],
            ),
        ),
        "|",
    )


def persons_text(c: str = "byline_person") -> Column:
    return F.array_join(
        F.transform(
            c,
            lambda p: F.concat_ws(
                ":",
                *[
                    F.coalesce(p[f], F.lit("~"))
                    for f in ("firstname", "lastname", "middlename", "qualifier")
                ],
            ),
        ),
        "|",
    )


def counts_text(c: str) -> Column:
    """``type=n`` entries in key order; null stays null."""
    entries = F.array_sort(F.map_entries(c))
    text = F.array_join(
        F.transform(entries, lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ","
    )
    return F.when(F.col(c).isNotNull(), text)


def list_text(c: str) -> Column:
    return F.array_join(c, "|")


def _stg(p: Press) -> DataFrame:
    return p.stg.withColumns(
        {
            "keywords": keywords_text(),
            "byline_person": persons_text(),
            "multimedia_count_by_type": counts_text("multimedia_count_by_type"),
        }
    )


FACETS = ("des_facet", "org_facet", "per_facet", "geo_facet")


def _stg_popular(p: Press) -> DataFrame:
    return p.stg_popular.withColumns(
        {
            "updated_at": F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss"),
            "media_count_by_type": counts_text("media_count_by_type"),
            **{f: list_text(f) for f in FACETS},
        }
    )


def _fct_popularity(p: Press) -> DataFrame:
    return core.fct_article_popularity(p.stg_popular).withColumns(
        {
            "updated_at": F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss"),
            **{f: list_text(f) for f in FACETS},
        }
    )


def _profile_cast(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("int") for c in columns})


def _display(p: Press) -> DataFrame:
    return p.months.select(
        "pub_month",
        number_text("total_word_count").alias("words_text"),
        number_text("avg_keywords_per_article", 2).alias("keywords_text"),
        percent_text("pct_with_authors").alias("authors_text"),
        number_text(F.when(F.month("pub_month") != 1, F.col("total_articles"))).alias(
            "articles_text"
        ),
    )


def _declared_checks(p: Press) -> DataFrame:
    return checks.check_report(
        {
            "stg_archive_articles": p.stg,
            "stg_most_popular_articles": p.stg_popular,
            "fct_articles": p.fct,
            "fct_article_popularity": p.pop,
            "dim_authors": core.dim_authors(p.stg),
            "dim_keywords": core.dim_keywords(p.stg),
            "dim_sections": core.dim_sections(p.stg),
            "agg_articles_by_month": p.months,
            "agg_author_performance": p.author_marts,
        }
    )


def _filtered(p: Press, chosen: dashboard.ArticleFilter) -> DataFrame:
    return dashboard.filtered(p.fct, p.stg, chosen, AS_OF)


def _filtered_stg(p: Press, chosen: dashboard.ArticleFilter) -> DataFrame:
    return dashboard.filtered(p.stg, p.stg, chosen, AS_OF)


def _index_name(p: Press, table: str) -> str:
    database = f"newsmart_index_{p.mark}"
    tables.create_database(p.spark, database, f"{p.root}/index")
    return f"{database}.{table}"


def _by_postings(p: Press) -> DataFrame:
    index = Postings(p.spark, _index_name(p, "postings"))
    p.once("postings", p.root, lambda: index.build(p.stg))
    return dashboard.filtered(p.fct, p.stg, PEOPLE_AND_TOPICS, AS_OF, index)


def _kept_marts(p: Press) -> MartStates:
    """States of three loads: articles up to 1996, later ones, and a tenth of all that comes late; the last load is repeated."""
    states = MartStates(p.spark, f"{p.root}/mart_states")

    def write() -> None:
        late = F.coalesce(F.crc32("article_id"), F.lit(0)) % 10 == 0
        early = F.coalesce(F.col("pub_year") <= 1996, F.lit(False))
        fct = p.fct.withColumn("pub_year", F.year("pub_date"))
        for name, part in (("early", early & ~late), ("later", ~early & ~late), ("late", late), ("late", late)):
            states.add(name, fct.where(part), p.keyword_names.where(part))

    p.once("mart_states", p.root, write)
    return states


def _author_names(p: Press) -> Trigrams:
    index = Trigrams(p.spark, _index_name(p, "author_names"))
    p.once("author_names", p.root, lambda: index.build(p.author_marts.select("author_full_name")))
    return index


def _keyword_values(p: Press) -> Trigrams:
    index = Trigrams(p.spark, _index_name(p, "keyword_values"))
    p.once("keyword_values", p.root, lambda: index.build(p.trends.select("keyword_value")))
    return index


def _top_lists(p: Press) -> DataFrame:
    staged = _filtered_stg(p, CHOSEN)
    keywords = dashboard.top_keywords(staged).withColumnRenamed("keyword_value", "member")
    authors = dashboard.top_authors(staged).withColumnRenamed("author_full_name", "member")
    return keywords.withColumn("list", F.lit("keyword")).unionByName(
        authors.withColumn("list", F.lit("author"))
    )


def _by_article(flat: DataFrame, *columns: str) -> DataFrame:
    """Per article the number of flattened rows and a sum over hashes of their texts, which no order changes."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in columns])
    part = F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("bigint")
    return flat.groupBy("article_id", "pub_date").agg(F.count(F.lit(1)).alias("n"), F.sum(part).alias("hash_sum"))


def _cached_breakdowns(p: Press) -> DataFrame:
    """A breakdown asked for four times: made, kept, made anew as its table has changed, and again as its hour is over."""
    mark = p.fresh()
    source, kept = f"news_models_{p.mark}", f"news_results_{p.mark}_{mark}"
    tables.create_database(p.spark, source, f"{p.root}/db/models")
    store = results.ResultStore(p.spark, kept, f"{p.root}/db/results-{mark}")
    fct = f"{source}.fct_{mark}"
    tables.write_table(p.fct.where("pub_date < '1998-01-01'"), fct)
    out = None
    for step, now in (("made", 1000.0), ("kept", 4599.0), ("changed", 4599.5), ("expired", 8200.0)):
        if step == "changed":
            tables.write_table(p.fct.where("pub_date >= '1998-01-01'"), fct, mode="append")
        found, was_kept = dashboard.cached_breakdown(store, fct, lambda: p.stg, CHOSEN, AS_OF, [], now)
        rows = found.withColumns({"step": F.lit(step), "was_kept": F.lit(was_kept)})
        saved = p.saved(f"cached_{mark}_{step}", lambda r=rows: r)
        out = saved if out is None else out.unionByName(saved)
    return out


MODELS: dict[str, Callable[[Press], DataFrame]] = {
    # staging and unnesting
    "p1_stg_archive_articles": _stg,
    "p2_stg_most_popular_articles": _stg_popular,
    "u1_int_keywords_flattened": lambda p: p.keywords,
    "u2_int_authors_flattened": lambda p: p.authors,
    "u1_keywords_by_article": lambda p: _by_article(
        p.keywords, "pub_year", "section_name", "keyword_name", "keyword_value", "keyword_rank", "keyword_major"
    ),
    "u2_authors_by_article": lambda p: _by_article(
        p.authors, "pub_year", "section_name", "firstname", "middlename", "lastname", "qualifier", "author_full_name"
    ),
    "u3_facets_flattened": lambda p: facets_flattened(p.stg_popular),
    # facts and dimensions
    "c1_fct_articles": lambda p: core.fct_articles(p.stg, p.unique_ids),
    "c1_fct_articles_any_ids": lambda p: core.fct_articles(p.stg),
    "c2_fct_article_popularity": _fct_popularity,
    "c3_dim_authors": lambda p: core.dim_authors(p.stg),
    "c4_dim_keywords": lambda p: core.dim_keywords(p.stg),
    "c5_dim_sections": lambda p: core.dim_sections(p.stg),
    # marts
    "a1_agg_articles_by_month": lambda p: marts.agg_articles_by_month(p.fct),
    "a2_agg_author_performance": lambda p: marts.agg_author_performance(
        p.stg, p.fct, p.unique_ids
    ),
    "a2_agg_author_performance_any_ids": lambda p: marts.agg_author_performance(p.stg, p.fct),
    "a3_agg_section_trends": lambda p: marts.agg_section_trends(p.fct),
    "a4_keyword_year_stats": lambda p: marts.keyword_year_stats(p.keyword_names),
    "a1_months_of_three_loads": lambda p: _kept_marts(p).months(),
    "a4_trends_of_three_loads": lambda p: _kept_marts(p).keyword_trends(),
    "a4_agg_keyword_trends": lambda p: marts.keyword_trends_from_stats(p.keyword_stats),
    # exploratory queries
    "q01_archive_profile": lambda p: explore.archive_profile(p.fct),
    "q02_popularity_profile": lambda p: explore.popularity_profile(p.pop),
    "q03_articles_per_year": lambda p: explore.articles_per_year(p.fct),
    "q04_monthly_trend": lambda p: explore.monthly_trend(p.months, AS_OF),
    "q05_busiest_months": lambda p: explore.busiest_months(p.months),
    "q06_word_count_by_decade": lambda p: explore.word_count_by_decade(p.fct),
    "q07_top_sections": lambda p: explore.top_sections(p.fct),
    "q08_section_growth": lambda p: explore.section_growth(p.sections, AS_OF),
    "q09_sections_by_decade": lambda p: explore.sections_by_decade(p.sections),
    "q10_news_desks": lambda p: explore.news_desks(p.fct),
    "q11_top_keywords": lambda p: explore.top_keywords(p.trends),
    "q12_recent_keywords": lambda p: explore.recent_keywords(p.trends, AS_OF),
    "q13_fastest_keywords": lambda p: explore.fastest_keywords(p.trends, AS_OF, 5, 50.0),
    "q14_top_keywords_per_decade": lambda p: explore.top_keywords_per_decade(p.trends),
    "q15_tracked_keywords": lambda p: explore.tracked_keywords(p.trends, TRACKED),
    "q16_prolific_authors": lambda p: explore.prolific_authors(p.author_marts),
    "q17_productive_authors": lambda p: explore.productive_authors(p.author_marts),
    "q18_versatile_authors": lambda p: explore.versatile_authors(p.author_marts),
    "q19_longest_careers": lambda p: explore.longest_careers(p.author_marts),
    "q20_longest_articles": lambda p: explore.longest_articles(p.author_marts),
    "q21_author_debuts": lambda p: explore.author_debuts(p.author_marts),
    "q22_recent_popular": lambda p: explore.recent_popular(p.pop, POPULAR_AS_OF),
    "q23_popularity_age_buckets": lambda p: explore.popularity_age_buckets(p.pop),
    "q24_evergreen": lambda p: explore.evergreen(p.pop),
    "q25_popular_sections": lambda p: explore.popular_sections(p.pop),
    "q26_facet_richness": lambda p: explore.facet_richness(p.pop),
    "q27_event_years": lambda p: explore.event_years(p.fct, EVENT_YEARS, EVENT_LABELS),
    "q28_keyword_evolution": lambda p: explore.keyword_evolution(
        p.trends, ("red widget", "brand#4 ", "small ring")
    ),
    "q29_author_count_buckets": lambda p: explore.author_count_buckets(p.fct),
    "q30_collaboration_by_year": lambda p: explore.collaboration_by_year(p.fct),
    "q31_keyword_density": lambda p: explore.keyword_density(p.fct),
    "q32_word_count_quartiles": lambda p: explore.word_count_quartiles(p.fct),
    "q32_quartiles_of_three_loads": lambda p: _kept_marts(p).word_count_quartiles(),
    "q33_monthly_outliers": lambda p: explore.monthly_outliers(p.months),
    "q34_sudden_keywords": lambda p: explore.sudden_keywords(p.trends, 4),
    "q35_trending_summary": lambda p: explore.trending_summary(p.pop, POPULAR_AS_OF).withColumn(
        "top_sections", list_text("top_sections")
    ),
    "q36_header_metrics": lambda p: explore.header_metrics(p.fct, p.author_marts, p.pop),
    "q37_sparkline": lambda p: explore.sparkline(p.months, AS_OF),
    # rollups
    "r01_snapshot_daily_summary": lambda p: rollups.snapshot_daily_summary(p.pop).withColumn(
        "sections_represented", list_text("sections_represented")
    ),
    "r02_keyword_cooccurrence": lambda p: rollups.keyword_cooccurrence(p.keyword_values),
    "r02_keyword_cooccurrence_3_articles": lambda p: rollups.keyword_cooccurrence(p.keyword_values, 3),
    "r03_keyword_spikes": lambda p: rollups.keyword_spikes(p.trends, 300.0, 3),
    "r04_top_keyword_values": lambda p: rollups.top_keyword_values(p.trends),
    "r05_trending_keywords": lambda p: rollups.trending_keywords(p.trends, AS_OF),
    "r06_section_composition": lambda p: rollups.section_composition(p.sections),
    "r06_latest_section_distribution": lambda p: rollups.latest_section_distribution(p.sections),
    "r07_growing_and_declining_sections": lambda p: rollups.growing_and_declining_sections(
        p.sections, AS_OF
    ),
    "r08_section_year_matrix": lambda p: rollups.section_year_matrix(p.sections),
    "r09_rank_history": lambda p: rollups.rank_history(p.trends),
    "r10_top_keywords_per_year": lambda p: rollups.top_keywords_per_year(p.trends),
    "r11_keyword_momentum": lambda p: rollups.keyword_momentum(p.trends),
    "r12_keyword_weights": lambda p: rollups.keyword_weights(p.trends),
    "r13_declining_keywords": lambda p: rollups.declining_keywords(p.trends, AS_OF),
    "r14_career_histogram": lambda p: rollups.career_histogram(p.author_marts, 2),
    "r15_power_authors": lambda p: rollups.power_authors(p.author_marts, 5.0, 5),
    "r15_specialists_and_generalists": lambda p: rollups.specialists_and_generalists(
        p.author_marts
    ),
    "r16_popularity_decay": lambda p: rollups.popularity_decay(p.pop),
    "r17_article_stickiness": lambda p: rollups.article_stickiness(p.pop),
    "r17_facet_correlation": lambda p: rollups.facet_correlation(p.pop),
    "r18_busiest_years": lambda p: rollups.busiest_years(p.sections),
    "r19_month_year_heatmap": lambda p: rollups.month_year_heatmap(p.fct),
    "r20_author_share_by_year": lambda p: rollups.author_share_by_year(p.fct),
    "r21_popular_today": lambda p: rollups.popular_today(p.pop),
    "r22_facets_today": lambda p: rollups.facets_today(p.pop),
    "r23_compare_sections": lambda p: rollups.compare_sections(p.fct, FIRST, SECOND),
    "r23_compare_keywords": lambda p: rollups.compare_keywords(p.keyword_values, FIRST, SECOND),
    "r23_compare_lengths": lambda p: rollups.compare_lengths(p.fct, FIRST, SECOND),
    "r23_section_change_by_decade": lambda p: rollups.section_change_by_decade(p.sections),
    "r24_metadata_completeness": lambda p: rollups.metadata_completeness(p.fct),
    "r25_materials_by_year": lambda p: rollups.materials_by_year(p.fct),
    "r25_opinion_share": lambda p: rollups.opinion_share(p.fct),
    "r26_section_popularity_bias": lambda p: rollups.section_popularity_bias(p.fct, p.pop),
    "r27_landing_totals": lambda p: rollups.landing_totals(p.fct, p.author_marts, p.pop),
    "r28_author_leaderboard": lambda p: rollups.author_leaderboard(p.author_marts, "author#00000001"),
    "r28_leaderboard_by_trigrams": lambda p: rollups.author_leaderboard(
        p.author_marts, "author#00000001", index=_author_names(p)
    ),
    "r29_election_cycle": lambda p: rollups.election_cycle(p.trends, "widget"),
    "r29_cycle_by_trigrams": lambda p: rollups.election_cycle(
        p.trends, "widget", _keyword_values(p)
    ),
    "r30_facets_against_history": lambda p: rollups.facets_against_history(p.pop, p.trends),
    "r31_news_desk_volume": lambda p: rollups.news_desk_volume(p.fct),
    "r31_news_desk_structure": lambda p: rollups.news_desk_structure(p.fct),
    "r32_yearly_spikes": lambda p: rollups.yearly_spikes(p.sections, 1.0),
    # dashboard
    "d1_default_articles": lambda p: dashboard.default_articles(p.fct, AS_OF, 4).select(
        "article_id", "pub_date", "word_count"
    ),
    "d2_filtered_articles": lambda p: _filtered(p, CHOSEN).select(
        "article_id", "pub_date", "section_name", "news_desk", "type_of_material", "word_count"
    ),
    "d3_people_and_topics": lambda p: _filtered(p, PEOPLE_AND_TOPICS).select(
        "article_id", "section_name", "word_count"
    ),
    "d3_by_postings": lambda p: _by_postings(p).select("article_id", "section_name", "word_count"),
    "d4_articles_by_month": lambda p: dashboard.articles_by_month(_filtered(p, CHOSEN)),
    "d5_breakdown": lambda p: dashboard.breakdown(_filtered(p, CHOSEN)),
    "d6_top_lists": _top_lists,
    "d7_kept_breakdown": lambda p: dashboard.breakdown(dashboard.kept(_filtered(p, CHOSEN))),
    "d7_cached_breakdowns": _cached_breakdowns,
    "f1_display_texts": _display,
    # checks
    "v1_v2_declared_checks": _declared_checks,
    "v1_repeated_days": lambda p: checks.unique_violations(p.stg, "pub_date"),
    "v2_missing_abstracts": lambda p: checks.null_violations(p.stg, "abstract").select(
        "article_id"
    ),
    "v3_source_not_empty": lambda p: checks.empty_violations(p.archive),
    "v3_source_without_early_articles": lambda p: checks.empty_violations(
        p.archive.where("pub_date < '1990-01-01'")
    ),
    "v4_same_grain": lambda p: checks.grain_violations(p.archive, p.stg),
    "v4_grain_of_rows_with_media": lambda p: checks.grain_violations(
        p.archive, p.stg.where("has_multimedia")
    ),
}


def _query(model: Callable[[Press], DataFrame]) -> Query:
    return lambda spark, sf_dir: model(press(spark, sf_dir))


def all_queries() -> dict[str, Query]:
    return {name: _query(model) for name, model in {**MODELS, **loads.MODELS}.items()}
