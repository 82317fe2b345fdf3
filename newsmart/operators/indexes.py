"""Indexes beside the tables: articles by author and keyword, and names by their trigrams.

Postings hold one row per article and author name or keyword value, ordered by the name and then by article, so
that a filter on some names reads their row groups alone and a name with a third of all articles lies in many
files. Article ids are text, so the postings are ids and not bitmaps, which need dense numbers.

Trigrams hold each distinct name under every run of three characters of its lower-case form. A search takes the
rarest trigrams of what is searched; names that have all of them are candidates, to be verified by the caller.

Both are added to with the rows that a load brings. What is there twice, as after a repeated load, counts once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmart.operators.flatten import authors_flattened, keywords_flattened
from newsmart.operators.tables import current, write_table

AUTHOR, KEYWORD = "author", "keyword"
#: Characters of a run, and how many runs, the rarest, a search looks up.
GRAM, RAREST = 3, 3


def postings(stg: DataFrame) -> DataFrame:
    """(kind, term, article_id) of staging rows. Null names, values and ids can't be searched and are left out."""
    authors = authors_flattened(stg, qualifier=False).select(F.lit(AUTHOR).alias("kind"), F.col("author_full_name").alias("term"), "article_id")
    keywords = keywords_flattened(stg, fields=["value"]).select(F.lit(KEYWORD).alias("kind"), F.col("keyword_value").alias("term"), "article_id")
    return authors.unionByName(keywords).where("term IS NOT NULL AND article_id IS NOT NULL")


@dataclass
class Postings:
    """Articles by author name and keyword value, in a table partitioned by kind."""

    spark: SparkSession
    name: str

    def build(self, stg: DataFrame) -> None:
        self._write(stg, "overwrite")

    def add(self, stg: DataFrame) -> None:
        """Adds the staging rows of new articles."""
        self._write(stg, "append")

    def _write(self, stg: DataFrame, mode: str) -> None:
        write_table(postings(stg), self.name, "kind", ["term"], "article_id", mode)

    def articles(self, kind: str, terms: list[str]) -> DataFrame:
        """(article_id) of the articles with one of the terms, each once."""
        rows = current(self.spark, self.name).where((F.col("kind") == kind) & F.col("term").isin(terms))
        return rows.select("article_id").distinct()


def grams(text: Column) -> Column:
    """The distinct runs of GRAM characters of a text; none if it is shorter."""
    n = F.char_length(text)
    runs = F.transform(F.sequence(F.lit(1), n - (GRAM - 1)), lambda i: F.substr(text, i, F.lit(GRAM)))
    return F.when(n >= GRAM, F.array_distinct(runs))


@dataclass
class Trigrams:
    """Names by the trigrams of their lower-case forms, and how many names each trigram has (in ``<name>_n``)."""

    spark: SparkSession
    name: str

    def build(self, names: DataFrame) -> None:
        """Indexes the only column of ``names``; nulls and names shorter than a trigram are in no list."""
        self._write(self._rows(names), "overwrite")

    def add(self, names: DataFrame) -> None:
        """Adds names that aren't in it."""
        held = current(self.spark, self.name)
        self._write(self._rows(names).join(held, ["term", "gram"], "left_anti"), "append")

    def _rows(self, names: DataFrame) -> DataFrame:
        term = F.col(names.columns[0])
        return names.select(term.alias("term")).distinct().select("term", F.explode(grams(F.lower("term"))).alias("gram"))

    def _write(self, rows: DataFrame, mode: str) -> None:
        counts = rows.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
        # counts only choose among trigrams, so they may be behind after a stop; they are written first, as
        # rows to add are told by what the other table holds
        write_table(counts, f"{self.name}_n", cluster=["gram"], mode=mode)
        write_table(rows.select("gram", "term"), self.name, cluster=["gram"], key="term", mode=mode)

    def candidates(self, part: str) -> DataFrame | None:
        """(term) of all names that can contain ``part``, case ignored, and some more; None where it is shorter than a trigram."""
        low = part.lower()
        own = sorted({low[i : i + GRAM] for i in range(len(low) - GRAM + 1)})
        if not own:
            return None
        counted = current(self.spark, f"{self.name}_n").where(F.col("gram").isin(own)).groupBy("gram").agg(F.sum("n").alias("n"))
        n = {r["gram"]: r["n"] for r in counted.collect()}  # a row for each trigram of the part
        rare = sorted(own, key=lambda g: (n.get(g, 0), g))[:RAREST]
        held = current(self.spark, self.name).where(F.col("gram").isin(rare))
        return held.groupBy("term").agg(F.countDistinct("gram").alias("n")).where(F.col("n") == len(rare)).select("term")
