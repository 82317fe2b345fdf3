"""Marts kept up to date: partial states that a load adds to, and rows made from them.

A load's articles go in as a partial state of their own, in a folder of that load, which a repeated load overwrites;
so a load that is repeated after a stop counts once. States of several loads are put together when rows are made:

* months: sums per month, section, desk and material;
* lengths: articles per section and word count, from which quartiles are exact (their rank error is 0);
* keyword articles: occurrences per keyword, year and article, partitioned by year, as an id may come in two loads and
  counts once in a year.

Keyword ranks are made again for the years that a load touched and overwrite those years' folders, after the states
are there. A stop in between leaves ranks of the states before, and the same load, repeated, ranks its years. Nothing
is ever taken back, so a load's name must not be used again for other articles. There is one writer at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsmart.functions.exprs import n_rows, ratio
from newsmart.operators.tables import by_folder
from newsmart.plans import marts

MONTHS, LENGTHS, ARTICLES, RANKED = "months", "lengths", "keyword_articles", "ranked_keywords"
COLUMNS = {
    MONTHS: "pub_month date, section_name string, news_desk string, type_of_material string, n bigint, words bigint, longest bigint, "
    "with_authors bigint, with_keywords bigint, with_multimedia bigint, authors bigint, keywords bigint, load string",
    LENGTHS: "section_name string, word_count bigint, n bigint, load string",
    ARTICLES: "keyword_name string, keyword_value string, article_id string, n bigint, pub_year int, load string",
    RANKED: "keyword_name string, keyword_value string, article_count bigint, keyword_occurrences bigint, rank_in_year bigint, pub_year int",
}


def length_counts(fct: DataFrame) -> DataFrame:
    """Articles per section and word count."""
    return fct.groupBy("section_name", "word_count").agg(n_rows().alias("n"))


def quartiles_from_counts(counts: DataFrame, more_than: int = 1000) -> DataFrame:
    """Exact discrete quartiles per section; a window sees a row for each distinct length of a section."""
    merged = counts.groupBy("section_name", "word_count").agg(F.sum("n").alias("n"))
    known = F.when(F.col("word_count").isNotNull(), F.col("n")).otherwise(0)
    section = Window.partitionBy("section_name")
    below = section.orderBy(F.col("word_count").asc_nulls_first())
    placed = merged.withColumns({"upto": F.sum(known).over(below), "all": F.sum(known).over(section)})

    def quartile(share: float) -> Column:
        return F.min(F.when(F.col("upto") >= F.col("all") * share, F.col("word_count")))

    return (
        placed.groupBy("section_name")
        .agg(
            F.sum("n").alias("article_count"),
            F.min("word_count").alias("min_words"),
            quartile(0.25).alias("p25_words"),
            quartile(0.5).alias("median_words"),
            quartile(0.75).alias("p75_words"),
            F.max("word_count").alias("max_words"),
            F.round(ratio(F.sum(F.col("word_count") * F.col("n")), F.sum(known)), 0).alias("avg_words"),
        )
        .where(F.col("article_count") > more_than)
        .orderBy(F.desc("median_words"), "section_name")
    )


@dataclass
class MartStates:
    """The states below a folder that all executors share."""

    spark: SparkSession
    folder: str

    def add(self, load: str, fct: DataFrame, keywords: DataFrame) -> None:
        """Takes in a load's fact rows and flattened keywords. ``load`` names it; the same load again changes nothing."""
        self._write(MONTHS, marts.month_combinations(fct), load)
        self._write(LENGTHS, length_counts(fct), load)
        self._write(ARTICLES, marts.keyword_articles(keywords), load)
        self._rank(self.read(ARTICLES).where(F.col("load") == load))

    def read(self, state: str) -> DataFrame:
        return self.spark.read.schema(COLUMNS[state]).parquet(f"{self.folder}/{state}")

    def _write(self, state: str, rows: DataFrame, load: str) -> None:
        # partitions other than the load's own stay
        folders = ["pub_year", "load"] if state == ARTICLES else ["load"]
        self._overwrite(state, rows.withColumn("load", F.lit(load)), folders)

    def _overwrite(self, state: str, rows: DataFrame, folders: list[str]) -> None:
        fitted = rows.to(self.spark.createDataFrame([], COLUMNS[state]).schema)
        writer = by_folder(fitted, *folders).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*folders).parquet(f"{self.folder}/{state}")

    def _rank(self, added: DataFrame) -> None:
        years = [r[0] for r in added.select("pub_year").distinct().collect()]  # a row for each year, partitions alone
        here = F.col("pub_year").isin([y for y in years if y is not None])
        if None in years:
            here = here | F.col("pub_year").isNull()
        kinds = ["keyword_name", "keyword_value", "pub_year"]
        articles = self.read(ARTICLES).where(here).groupBy(*kinds, "article_id").agg(F.sum("n").alias("n"))
        self._overwrite(RANKED, marts.ranked_keywords(marts.stats_from_articles(articles)), ["pub_year"])

    def months(self) -> DataFrame:
        """The monthly mart of all loads."""
        return marts.months_from_combinations(self.read(MONTHS).drop("load"))

    def keyword_trends(self) -> DataFrame:
        """The keyword mart of all loads."""
        return marts.keyword_changes(self.read(RANKED))

    def word_count_quartiles(self, more_than: int = 1000) -> DataFrame:
        return quartiles_from_counts(self.read(LENGTHS), more_than)
