"""Feed files listed step by step: months and days that are closed are not listed again.

A period is the month of an archive file or the day of a popularity file, taken from its path. Periods that lie far
enough back and whose files are all loaded are closed: their files are put into a stored listing, and from then on
only open periods are listed, by globs of their folders: those that are not closed from the oldest closed one up to
today. A first listing, before anything is closed, takes in everything.

A file that comes late into a closed period, a period older than the oldest closed one, and files whose path names no
period are not seen that way. ``sweep`` lists everything that was modified after the last sweep and opens the periods
of what it finds; run it now and then, once a day or a week.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmart import schemas
from newsmart.functions.exprs import n_rows
from newsmart.operators.tables import current, write_table
from newsmart.sources import files
from newsmart.sources.files import ARCHIVE_SLIM, POPULAR_SLIM

#: Months before this one, and days before today, that stay open.
OPEN_MONTHS, OPEN_DAYS = 1, 7
#: Seconds that a sweep looks back beyond the one before, for clocks that differ.
OVERLAP = 3600

FILES: schemas.Fields = {
    "feed": "string", "period": "string", "path": "string", "object_path": "string", "length": "bigint",
    "modified": "timestamp", "closing": "string",
}
EVENTS: schemas.Fields = {"feed": "string", "period": "string", "event": "string", "closing": "string", "noted_at": "timestamp"}
CLOSED, OPENED, SWEPT = "closed", "opened", "swept"


def period_of(path: Column, feed: Column | str) -> Column:
    """Month (yyyy-MM) or day (yyyy-MM-dd) that a file belongs to, null where its path names none."""
    feed = F.lit(feed) if isinstance(feed, str) else feed
    month = F.format_string("%04d-%02d", files.path_year(path), files.path_month(path))
    month = F.when(files.path_year(path).isNotNull() & files.path_month(path).isNotNull(), month)
    return F.when(feed == ARCHIVE_SLIM, month).otherwise(files.path_snapshot_date(path).cast("string"))


def _months(first: str, last: dt.date) -> Iterator[str]:
    year, month = int(first[:4]), int(first[5:7])
    while (year, month) <= (last.year, last.month):
        yield f"{year:04d}-{month:02d}"
        year, month = (year + 1, 1) if month == 12 else (year, month + 1)


def _days(first: str, last: dt.date) -> Iterator[str]:
    day = dt.date.fromisoformat(first)
    while day <= last:
        yield day.isoformat()
        day += dt.timedelta(days=1)


def glob_of(landing: str, feed: str, periods: list[str]) -> str:
    """One glob for the files and folders of the periods, in either spelling of folders; a year's folder is looked at once."""
    names = []
    if feed == ARCHIVE_SLIM:
        for year in sorted({p[:4] for p in periods}):
            months = dict.fromkeys(m for p in periods if p[:4] == year for m in (p[5:7], str(int(p[5:7]))))
            inner = ",".join(f"{m},{m}.*,month={m}" for m in months)
            names.append(f"{{{year},year={year}}}/{{{inner}}}")
    else:
        names = [f"{p},snapshot_date={p}" for p in periods]
    return f"{files.literal(landing)}/{feed}/{{{','.join(names)}}}"


class Listing:
    """The stored listing of a landing folder, in two tables of a database."""

    def __init__(self, spark: SparkSession, database: str, landing: str) -> None:
        self.spark, self.landing = spark, landing.rstrip("/")
        self.files, self.events = f"{database}.listed_files", f"{database}.listing_events"
        for name, fields in ((self.files, FILES), (self.events, EVENTS)):
            if not spark.catalog.tableExists(name):
                write_table(spark.createDataFrame([], schemas.struct_type(fields)), name)

    def closed(self) -> DataFrame:
        """feed, period and closing of the periods that are closed now."""
        last = F.max_by(F.struct("event", "closing"), "noted_at").alias("last")
        now = current(self.spark, self.events).where(F.col("event") != SWEPT).groupBy("feed", "period").agg(last)
        return now.where(F.col("last.event") == CLOSED).select("feed", "period", F.col("last.closing").alias("closing"))

    def stored(self) -> DataFrame:
        """Files of closed periods, as they were when these were closed."""
        return current(self.spark, self.files).join(self.closed(), ["feed", "period", "closing"], "left_semi")

    def _routed(self, found: DataFrame) -> DataFrame:
        routed = files.route(found, self.landing).where(F.col("feed").isNotNull())
        return routed.withColumn("period", period_of(F.col("object_path"), F.col("feed")))

    def open_periods(self, feed: str, as_of: dt.date) -> list[str] | None:
        """Periods to be listed; None: everything, as none is closed yet. The calendar bounds their number."""
        shut = {r.period for r in self.closed().where(F.col("feed") == feed).select("period").collect()}
        if not shut:
            return None
        ahead = as_of + dt.timedelta(days=1)  # clocks differ
        every = _months(min(shut), ahead) if feed == ARCHIVE_SLIM else _days(min(shut), ahead)
        return [p for p in every if p not in shut]

    def list_open(self, as_of: dt.date) -> DataFrame:
        """Files of open periods with feed, object_path, snapshot_date and period; closed folders aren't looked at."""
        found = None
        for feed in (ARCHIVE_SLIM, POPULAR_SLIM):
            periods = self.open_periods(feed, as_of)
            if periods is None:
                listed = files.list_or_none(self.spark, f"{files.literal(self.landing)}/{feed}")
            else:
                listed = files.list_or_none(self.spark, glob_of(self.landing, feed, periods))
            routed = self._routed(listed)
            shut = self.closed().where(F.col("feed") == feed).select("feed", "period")
            routed = routed.join(shut, ["feed", "period"], "left_anti").select(routed.columns)
            found = routed if found is None else found.unionByName(routed)
        return found

    def note(self, periods: DataFrame, event: str, closing: str, at: Column | None = None) -> None:
        """Adds an event for each (feed, period)."""
        at = F.current_timestamp() if at is None else at
        rows = periods.select("feed", "period", F.lit(event).alias("event"), F.lit(closing).alias("closing"), at.alias("noted_at"))
        write_table(rows, self.events, mode="append")

    def close(self, status: DataFrame, as_of: dt.date) -> None:
        """Closes periods of listed files (with their load status) that lie far enough back and are loaded whole.

        The files are stored first and count once the event is there, so a stop in between closes nothing.
        """
        first = (as_of.replace(day=1) - dt.timedelta(days=1)).replace(day=1)
        for _ in range(OPEN_MONTHS - 1):
            first = (first - dt.timedelta(days=1)).replace(day=1)
        before = F.when(F.col("feed") == ARCHIVE_SLIM, f"{first:%Y-%m}").otherwise((as_of - dt.timedelta(days=OPEN_DAYS)).isoformat())
        done = (
            status.where(F.col("period").isNotNull()).groupBy("feed", "period")
            .agg((n_rows() == F.count_if(F.col("status") == "loaded")).alias("whole"))
            .where(F.col("whole") & (F.col("period") < before)).select("feed", "period")
        )
        closing = uuid.uuid4().hex
        rows = status.join(done, ["feed", "period"], "left_semi").withColumn("closing", F.lit(closing)).select(*FILES)
        write_table(rows, self.files, mode="append")
        shut = current(self.spark, self.files).where(F.col("closing") == closing).select("feed", "period").distinct()
        self.note(shut, CLOSED, closing)

    def sweep(self) -> list[tuple[str, str]]:
        """Opens the closed periods into which files came, or whose files changed, since the last sweep: (feed, period).

        Lists the whole landing folder, and looks at files modified after the last sweep.
        """
        back = F.make_dt_interval(secs=F.lit(OVERLAP))
        swept = current(self.spark, self.events).where(F.col("event") == SWEPT)
        last = swept.select(F.date_format(F.max("noted_at") - back, "yyyy-MM-dd'T'HH:mm:ss"), F.current_timestamp()).first()
        listed = files.list_or_none(self.spark, files.literal(self.landing), last[0])
        found = self._routed(listed).join(self.closed().select("feed", "period"), ["feed", "period"], "left_semi")
        known = self.stored().select("path", "length", "modified")
        late = found.join(known, ["path", "length", "modified"], "left_anti").select("feed", "period").distinct()
        opened = sorted((r.feed, r.period) for r in late.collect())
        kinds, mark = "feed string, period string", uuid.uuid4().hex
        if opened:
            self.note(self.spark.createDataFrame(opened, kinds), OPENED, mark)
        self.note(self.spark.createDataFrame([("", "")], kinds), SWEPT, mark, F.lit(last[1]))
        return opened
