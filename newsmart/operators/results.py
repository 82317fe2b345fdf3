"""Results kept for a time: by query, arguments and the state of the tables they were made from."""

from __future__ import annotations

import hashlib
import json
import re
import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmart.operators.tables import create_database
from newsmart.sources import files

#: Seconds that a result counts.
TTL = 3600
_MADE = "newsmart.made_at"


def version(spark: SparkSession, source: str) -> str:
    """The state of a source (a table's name or a folder): its files, their sizes and times, as one short text."""
    folder = source
    if re.fullmatch(r"\w+(\.\w+)*", source) and spark.catalog.tableExists(source):
        described = spark.sql(f"DESCRIBE FORMATTED {source}").where("col_name = 'Location'")
        folder = described.first()["data_type"]
    mark = F.xxhash64("path", "length", "modified")
    found = files.list_or_none(spark, files.literal(folder)).agg(F.count(F.lit(1)), F.sum("length"), F.max("modified"), F.bit_xor(mark)).first()
    return "/".join(str(v) for v in found)


class ResultStore:
    """Results as tables of a database of its own, each dropped with its files when its time is over.

    A result is found again by the query's name, its arguments and the versions of its sources, so a changed
    source never gives an old result. It lies in the database's folder and does not hang on the executors that
    made it. What is out of time is dropped by every call that makes a result, and by ``purge``.
    """

    def __init__(self, spark: SparkSession, database: str, location: str, ttl: float = TTL) -> None:
        self.spark, self.database, self.ttl = spark, database, ttl
        create_database(spark, database, location)

    def key(self, query: str, arguments: dict, sources: Sequence[str]) -> str:
        asked = [query, arguments, {s: version(self.spark, s) for s in sources}]
        return hashlib.sha256(json.dumps(asked, sort_keys=True, default=repr).encode()).hexdigest()[:32]

    def _made(self, table: str) -> float | None:
        """When the table was made; None for one that was never finished."""
        kept = {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
        return float(kept[_MADE]) if _MADE in kept else None

    def get(
        self, query: str, arguments: dict, sources: Sequence[str], make: Callable[[], DataFrame], now: float | None = None
    ) -> tuple[DataFrame, bool]:
        """The result, and whether it was kept from before."""
        now = time.time() if now is None else now
        table = f"{self.database}.r_{self.key(query, arguments, sources)}"
        if self.spark.catalog.tableExists(table):
            made = self._made(table)
            if made is not None and made <= now < made + self.ttl:
                self.spark.catalog.refreshTable(table)
                return self.spark.table(table), True
        self.purge(now)
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        make().write.format("parquet").saveAsTable(table)
        self.spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{_MADE}' = '{now!r}')")
        return self.spark.table(table), False

    def tables(self) -> list[str]:
        return [f"{self.database}.{r.tableName}" for r in self.spark.sql(f"SHOW TABLES IN {self.database}").collect()]

    def purge(self, now: float | None = None) -> list[str]:
        """Drops what is out of time or unfinished; the tables dropped."""
        now = time.time() if now is None else now
        gone = []
        for table in self.tables():
            made = self._made(table)
            if made is None or not made <= now < made + self.ttl:
                self.spark.sql(f"DROP TABLE IF EXISTS {table}")
                gone.append(table)
        return gone
