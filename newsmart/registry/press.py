"""Source tables, models and marts over one folder of test tables.

Sources, facts and marts are written once per session and folder below the shared folder and read
back, the way a warehouse keeps its models as tables; a query then reads what its model stored.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from newsmart.operators.flatten import authors_flattened, keywords_flattened
from newsmart.operators.staging import stg_archive_articles, stg_most_popular_articles
from newsmart.operators.tables import released
from newsmart.plans import core, marts
from newsmart.session import shared_dir
from newsmart.sources import views

# The days the queries take as "today" on the test tables.
AS_OF = dt.date(2001, 8, 1)
POPULAR_AS_OF = dt.date(2024, 1, 30)


class Press:
    #: Nothing is taken for granted about ids: one plan, right for repeated ids too, makes fact and marts.
    unique_ids = False

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.mark = uuid.uuid4().hex[:12]
        self.root = f"{shared_dir(spark)}/newsmart/{self.mark}"
        self._saved: dict[str, DataFrame] = {}
        self._written: set[str] = set()

    def fresh(self) -> str:
        """A name part not used before."""
        return uuid.uuid4().hex[:12]

    def once(self, name: str, folder: str, write: Callable[[], object]) -> str:
        """The folder, after ``write`` has filled it on first use."""
        if name not in self._written:
            with released(self.spark):
                write()
            self._written.add(name)
        return folder

    def saved(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """The named table, written on first use and read back with its known schema."""
        if name not in self._saved:
            df = make()
            path = f"{self.root}/{name}"
            with released(self.spark):
                df.write.mode("overwrite").parquet(path)
            self._saved[name] = self.spark.read.schema(df.schema).parquet(path)
        return self._saved[name]

    @property
    def archive(self) -> DataFrame:
        return self.saved(
            "archive_articles", lambda: views.archive_articles(self.spark, self.sf_dir)
        )

    @property
    def popular(self) -> DataFrame:
        return self.saved(
            "most_popular_articles", lambda: views.popular_articles(self.spark, self.sf_dir)
        )

    @property
    def stg(self) -> DataFrame:
        return stg_archive_articles(self.archive)

    @property
    def stg_popular(self) -> DataFrame:
        return stg_most_popular_articles(self.popular)

    @property
    def keywords(self) -> DataFrame:
        return keywords_flattened(self.stg)

    @property
    def keyword_names(self) -> DataFrame:
        """Flattened keywords without rank and major flag."""
        return keywords_flattened(self.stg, fields=("name", "value"))

    @property
    def keyword_values(self) -> DataFrame:
        return keywords_flattened(self.stg, fields=["value"])

    @property
    def authors(self) -> DataFrame:
        return authors_flattened(self.stg)

    @property
    def fct(self) -> DataFrame:
        return self.saved("fct_articles", lambda: core.fct_articles(self.stg, self.unique_ids))

    @property
    def pop(self) -> DataFrame:
        return self.saved(
            "fct_article_popularity", lambda: core.fct_article_popularity(self.stg_popular)
        )

    @property
    def months(self) -> DataFrame:
        return self.saved("agg_articles_by_month", lambda: marts.agg_articles_by_month(self.fct))

    @property
    def author_marts(self) -> DataFrame:
        return self.saved(
            "agg_author_performance",
            lambda: marts.agg_author_performance(self.stg, self.fct, self.unique_ids),
        )

    @property
    def sections(self) -> DataFrame:
        return self.saved("agg_section_trends", lambda: marts.agg_section_trends(self.fct))

    @property
    def keyword_stats(self) -> DataFrame:
        return self.saved("keyword_year_stats", lambda: marts.keyword_year_stats(self.keyword_names))

    @property
    def trends(self) -> DataFrame:
        return self.saved(
            "agg_keyword_trends", lambda: marts.keyword_trends_from_stats(self.keyword_stats)
        )


_open: dict[tuple[str, str], Press] = {}


def press(spark: SparkSession, sf_dir: str) -> Press:
    """The tables over ``sf_dir`` in this session."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _open:
        _open[key] = Press(spark, sf_dir)
    found = _open[key]
    found.spark = spark
    return found
