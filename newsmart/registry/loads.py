"""Registered queries of the ingest path.

Raw JSON is written from the article views, with values that do not fit put in by key arithmetic:
broken lines, objects without docs, word counts of several spellings. The steps then run on it the
way they run on delivered files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsmart import schemas
from newsmart.operators import keys, ledger, load, shaping, slim, tables
from newsmart.operators.staging import stg_archive_articles
from newsmart.plans import core, marts
from newsmart.registry.press import Press
from newsmart.sources import files, listing, records
from newsmart.sources.files import ARCHIVE_SLIM, POPULAR_SLIM
from newsmart.streaming.loader import start_loading


#: Docs in a raw object, about.
OBJECT_DOCS = 5000

#: Codec of the raw archive and popularity lines: uncompressed JSON is many times its table. Readers take it by the suffix.
RAW_CODEC = "gzip"

#: Codec of the slim landing, for the same reason; file_status counts ``.json.gz`` as JSON.
SLIM_CODEC = "gzip"


def _in_objects(rows: DataFrame, item: Column, name: str, mark: Column, *folder: str) -> DataFrame:
    """Rows dealt by the hash of ``mark`` to objects of bounded size for each folder: its columns, and the list ``name``."""
    size = rows.groupBy(*[F.col(c).alias(f"of_{c}") for c in folder]).agg(
        F.ceil(F.count(F.lit(1)) / OBJECT_DOCS).alias("parts")
    )
    same = F.lit(True)
    for c in folder:
        same = same & F.col(c).eqNullSafe(F.col(f"of_{c}"))
    part = F.pmod(F.xxhash64(mark), F.col("parts")).alias("part")
    dealt = rows.join(size, same).select(*folder, part, item.alias("item"))
    return dealt.groupBy(*folder, "part").agg(F.collect_list("item").alias(name))


def _key() -> Column:
    return F.substring("article_id", 2, 20).cast("bigint")


def _media(key: Column) -> Column:
    """Up to two images, a video, an item without type and one with an empty type."""
    kinds = F.array(
        F.when(key % 3 > 0, "image"),
        F.when(key % 3 > 1, "image"),
        F.when(key % 2 > 0, "video"),
        F.when(key % 7 == 0, ""),
    )
    return F.transform(kinds, lambda t: F.struct(t.alias("type")))


def _raw_archive(p: Press) -> str:
    """Raw archive objects, one per line, in one folder per year and month."""
    folder = f"{p.root}/landing/archive_raw"

    def write() -> None:
        key = _key()

        def raw(word_count: Column) -> Column:
            doc = F.struct(
                F.col("article_id").alias("_id"),
                "uri",
                F.concat(F.col("pub_date").cast("string"), F.lit("T05:00:00+0000")).alias(
                    "pub_date"
                ),
                "section_name", "news_desk", "type_of_material", "document_type",
                word_count.alias("word_count"),
                "web_url",
                F.struct(F.col("headline_main").alias("main")).alias("headline"),
                F.struct(
                    F.col("byline_original").alias("original"),
                    F.when(key % 11 != 0, F.col("byline_person")).alias("person"),
                ).alias("byline"),
                "abstract", "snippet",
                "keywords",
                F.when(key % 10 != 0, _media(key)).alias("multimedia"),
            )
            return F.to_json(F.struct(F.struct(F.array(doc).alias("docs")).alias("response")))

        text = (
            F.when(key % 101 == 0, '{"response": {"docs": [')
            .when(key % 53 == 0, '{"response": {}}')
            .when(key % 41 == 0, raw(F.lit("12x")))
            .when(key % 43 == 0, raw(F.lit(12.5)))
            .when(key % 47 == 0, raw(F.lit("120.0")))
            .when(key % 59 == 0, raw(F.lit("12.00000000001")))
            .otherwise(raw(F.col("word_count")))
        )
        month = F.lpad(F.month("pub_date").cast("string"), 2, "0")
        lines = p.archive.select(
            F.year("pub_date").alias("year"), month.alias("month"), text.alias("value")
        )
        tables.by_folder(lines, "year", "month").write.partitionBy("year", "month").option(
            "compression", RAW_CODEC
        ).text(folder)

    return p.once("archive_raw", folder, write)


def _raw_popular(p: Press) -> str:
    """Raw popularity objects, one per line, in one folder per day."""
    folder = f"{p.root}/landing/most_popular_raw"

    def write() -> None:
        kinds = F.array(F.lit("image"), F.when(F.col("id") % 4 > 0, "image"))

        def raw(asset_id: Column) -> Column:
            doc = F.struct(
                "id", "uri", "url", asset_id.alias("asset_id"), "source", "published_date",
                "updated", "section", "subsection", "byline", "type", "title", "abstract",
                F.when(F.col("id") % 6 != 0, F.col("des_facet")).alias("des_facet"),
                "org_facet", "per_facet", "geo_facet",
                F.transform(kinds, lambda t: F.struct(t.alias("type"))).alias("media"),
                "adx_keywords",
            )
            return F.to_json(F.struct(F.array(doc).alias("results"), F.lit(1).alias("num_results")))

        text = F.when(F.col("asset_id") % 37 == 0, raw(F.lit("none"))).otherwise(
            raw(F.col("asset_id"))
        )
        lines = p.popular.select("snapshot_date", text.alias("value"))
        tables.by_folder(lines, "snapshot_date").write.partitionBy("snapshot_date").option(
            "compression", RAW_CODEC
        ).text(folder)

    return p.once("most_popular_raw", folder, write)


def _raw_months(p: Press) -> str:
    """Raw objects with many docs, each in a file, one or more a month, below folders that look like a year and a month."""
    folder = f"{p.root}/2024/12/months"

    def write() -> None:
        key = _key()
        doc = F.struct(
            F.col("article_id").alias("_id"), F.col("word_count").cast("string").alias("word_count")
        )
        rows = p.archive.where(key % 101 != 0).withColumns(
            {"year": F.year("pub_date"), "month": F.month("pub_date")}
        )
        docs = _in_objects(rows, doc, "docs", F.col("article_id"), "year", "month")
        value = F.to_json(F.struct(F.struct("docs").alias("response")))
        tables.by_folder(docs, "year", "month").select("year", "month", value.alias("value")).write.partitionBy(
            "year", "month"
        ).option("maxRecordsPerFile", 1).text(folder)

    return p.once("raw_months", folder, write)


def _raw_days(p: Press) -> str:
    """Raw objects with many results, each in a file, one or more a day, below a folder that looks like a date."""
    folder = f"{p.root}/2020-02-02/days"

    def write() -> None:
        doc = F.struct("id", "asset_id")
        days = _in_objects(p.popular, doc, "results", F.struct("id", "asset_id"), "snapshot_date")
        value = F.to_json(F.struct("results", F.size("results").alias("num_results")))
        tables.by_folder(days, "snapshot_date").select("snapshot_date", value.alias("value")).write.partitionBy(
            "snapshot_date"
        ).option("maxRecordsPerFile", 1).text(folder)

    return p.once("raw_days", folder, write)


def _slim_archive(p: Press) -> str:
    folder = f"{p.root}/landing/slim/{ARCHIVE_SLIM}"
    raw = _raw_archive(p)
    return p.once(
        "archive_slim",
        folder,
        lambda: slim.transform_archive(p.spark, raw, folder, multiline=False, compression=SLIM_CODEC),
    )


def _slim_popular(p: Press) -> str:
    folder = f"{p.root}/landing/slim/{POPULAR_SLIM}"
    raw = _raw_popular(p)
    return p.once(
        "most_popular_slim",
        folder,
        lambda: slim.transform_popular(p.spark, raw, folder, multiline=False, compression=SLIM_CODEC),
    )


def _landing(p: Press, archive: bool = True) -> str:
    """The slim landing folder; ``archive=False`` writes only the popularity feed, for loads that read nothing else."""
    if archive:
        _slim_archive(p)
    _slim_popular(p)
    return f"{p.root}/landing/slim"


def _docs(p: Press) -> DataFrame:
    return records.raw_archive(p.spark, _raw_archive(p), multiline=False)


def _results(p: Press) -> DataFrame:
    return records.raw_popular(p.spark, _raw_popular(p), multiline=False)


def _checked(p: Press) -> DataFrame:
    return shaping.checked_articles(shaping.slim_articles(_docs(p)))


def _checked_popular(p: Press) -> DataFrame:
    return shaping.checked_popular(shaping.slim_popular(_results(p)))


def _counts(c: str) -> Column:
    from newsmart.registry.queries import counts_text

    return counts_text(c)


SCALARS = (
    "article_id uri pub_date section_name news_desk type_of_material document_type word_count "
    "web_url headline_main byline_original abstract snippet"
).split()


def _readable(df: DataFrame) -> DataFrame:
    """Slim or loaded articles with their nested columns as text."""
    from newsmart.registry.queries import keywords_text, persons_text

    return df.select(
        *SCALARS,
        keywords_text().alias("keywords"),
        persons_text().alias("byline_person"),
        _counts("multimedia_count_by_type").alias("multimedia_count_by_type"),
    )


POPULAR_SCALARS = (
    "id uri url asset_id source published_date updated section subsection byline type title "
    "abstract adx_keywords"
).split()


def _readable_popular(df: DataFrame) -> DataFrame:
    facets = ("des_facet", "org_facet", "per_facet", "geo_facet")
    return df.select(
        "snapshot_date",
        *POPULAR_SCALARS,
        *[F.array_join(c, "|").alias(c) for c in facets],
        _counts("media_count_by_type").alias("media_count_by_type"),
    )


def _targets(p: Press, name: str, archive: bool = True) -> load.Targets:
    database = f"news_{name}_{p.mark}"
    return load.create_targets(p.spark, database, f"{p.root}/db/{name}", _landing(p, archive))


# --- listings ------------------------------------------------------------------------------------


def _feed_folders(p: Press) -> DataFrame:
    """Feed and folder of every slim file; files outside the feeds are not listed."""
    landing = _landing(p)
    routed = files.route(files.list_files(p.spark, f"{p.root}/landing"), landing)
    return (
        routed.where(F.col("feed").isNotNull())
        .select(
            "feed",
            files.path_year(F.col("path")).alias("year"),
            files.path_month(F.col("path")).alias("month"),
            "snapshot_date",
        )
        .distinct()
    )


def _manifest_of_early_years(p: Press) -> DataFrame:
    path = F.col("object_path")
    routed = files.route(files.list_files(p.spark, _landing(p)), _landing(p))
    return routed.where(files.path_year(path) < 1998).select(
        F.col("feed").alias("source"), path.alias("path"), F.current_timestamp().alias("loaded_at")
    )


def _file_status(p: Press) -> DataFrame:
    routed = files.route(files.list_files(p.spark, _landing(p)), _landing(p))
    return files.file_status(routed, _manifest_of_early_years(p))


def _months_left(p: Press) -> DataFrame:
    path = F.col("path")
    return (
        _file_status(p)
        .where(F.col("feed") == ARCHIVE_SLIM)
        .select(files.path_year(path).alias("year"), files.path_month(path).alias("month"), "status")
        .distinct()
    )


def _popular_files(p: Press) -> DataFrame:
    return (
        _file_status(p)
        .where(F.col("feed") == POPULAR_SLIM)
        .select("snapshot_date", "status")
        .distinct()
    )


# --- slim files ----------------------------------------------------------------------------------


def _skipped_then_written(p: Press) -> DataFrame:
    """Articles per slim month after a second run, which finds every month done and adds nothing."""
    folder = _slim_archive(p)
    slim.transform_archive(p.spark, _raw_archive(p), folder, multiline=False, compression=SLIM_CODEC)
    path = F.col("file_path")
    return (
        records.slim_archive(p.spark, folder)
        .groupBy(files.path_year(path).alias("year"), files.path_month(path).alias("month"))
        .agg(F.count(F.lit(1)).alias("articles"))
    )


def _overwritten(p: Press) -> DataFrame:
    """Articles per slim day after a first run and an overwriting one."""
    folder = f"{p.root}/landing/again-{p.fresh()}/{POPULAR_SLIM}"
    for _ in range(2):
        slim.transform_popular(
            p.spark, _raw_popular(p), folder, overwrite=True, multiline=False
        )
    return (
        records.slim_popular(p.spark, folder)
        .groupBy("snapshot_date")
        .agg(F.count(F.lit(1)).alias("articles"))
    )


# --- merges and loads ----------------------------------------------------------------------------


def _insert_only(p: Press) -> DataFrame:
    """All articles, again with other word counts, merged into those dated before 1998.

    Articles that were there keep their word count.
    """
    rows = p.archive.select("article_id", "pub_date", "word_count").withColumn(
        "part_month", tables.month_of("pub_date")
    )
    name = _new_table(p, "merged_articles")
    tables.write_table(rows.where("pub_date < '1998-01-01'"), name, "part_month")
    again = rows.withColumn("word_count", F.lit(-1).cast("bigint"))
    for _ in range(2):  # the second merge finds every id present
        tables.merge_into(p.spark, name, again, ["article_id"], "part_month")
    return tables.current(p.spark, name)


def _merged_by_index(p: Press) -> DataFrame:
    """The same merges as batches, each given twice, with the table's keys looked up in its key index."""
    rows = p.archive.select("article_id", "pub_date", "word_count").withColumn(
        "part_month", tables.month_of("pub_date")
    )
    name = _new_table(p, "indexed_articles")
    tables.write_table(rows.withColumn(ledger.LOAD_ID, F.lit("")).limit(0), name, "part_month")
    index = keys.KeyIndex(p.spark, name, "article_id")
    again = rows.withColumn("word_count", F.lit(-1).cast("bigint"))
    for batch, source in (
        ("early", rows.where("pub_date < '1998-01-01'")), ("all", again), ("all", again), ("replay", again),
    ):
        ledger.merge_batch(p.spark, name, source, ["article_id"], "part_month", batch, index=index)
        if batch == "early":  # from here on these keys are old ones
            book = ledger.Ledger(p.spark, name)
            ledger.note_index(book, index.flush(book.key_state()))
    return tables.current(p.spark, name).drop(ledger.LOAD_ID)


def _insert_only_popular(p: Press) -> DataFrame:
    """All snapshots, again with other asset ids, merged into those up to the middle of the month."""
    rows = p.popular.select("snapshot_date", "id", "asset_id")
    name = _new_table(p, "merged_popular")
    tables.write_table(rows.where("snapshot_date <= '2024-01-15'"), name, "snapshot_date")
    again = rows.withColumn("asset_id", F.lit(-1).cast("bigint"))
    tables.merge_into(p.spark, name, again, ["snapshot_date", "id"], "snapshot_date")
    return tables.current(p.spark, name)


def _new_table(p: Press, name: str) -> str:
    """A table name not used before: a result handed out earlier keeps its files."""
    database = f"news_models_{p.mark}"
    tables.create_database(p.spark, database, f"{p.root}/db/models")
    return f"{database}.{name}_{p.fresh()}"


def _upserted(p: Press) -> DataFrame:
    """All articles; those since 1998 then come again, a year later and with other word counts."""
    rows = p.archive.select("article_id", "pub_date", "word_count")
    name = _new_table(p, "upserted_articles")

    def dated(df: DataFrame) -> DataFrame:
        return df.withColumn("part_month", tables.month_of("pub_date"))

    tables.write_table(dated(rows), name, "part_month")
    moved = rows.where("pub_date >= '1998-01-01'").select(
        "article_id",
        F.add_months("pub_date", 12).alias("pub_date"),
        F.lit(-1).cast("bigint").alias("word_count"),
    )
    tables.upsert(p.spark, name, dated(moved), ["article_id"], "part_month")
    return tables.current(p.spark, name)


def _incremental(p: Press) -> DataFrame:
    """The article fact built in two runs: articles up to 1998, then what is dated later.

    Older articles without an abstract arrive between the runs; the date filter leaves them out.
    """
    name = _new_table(p, "incremental_fct")
    early = (F.year("pub_date") <= 1998) & F.col("abstract").isNotNull()

    def build(stg: DataFrame) -> DataFrame:
        return core.fct_articles(stg).withColumn("part_month", tables.month_of("pub_date"))

    stg = stg_archive_articles(p.archive)
    for part, fresh in ((stg.where(early), True), (stg, False)):
        tables.run_incremental(
            p.spark, name, part, build, ["article_id"], "pub_date", "part_month",
            ["section_name"], full_refresh=fresh, lookback_days=3, prune="pub_date",
        )
    return tables.current(p.spark, name).select(
        "article_id", "pub_date", "word_count", "author_count", "keyword_count", "part_month"
    )


def _clustered(p: Press) -> DataFrame:
    """Two months read from the partitioned and clustered article table."""
    import datetime as dt

    name = _new_table(p, "clustered_articles")
    rows = p.archive.select("article_id", "pub_date", "section_name", "news_desk", "word_count")
    tables.write_table(
        rows.withColumn("part_month", tables.month_of("pub_date")),
        name,
        "part_month",
        ["pub_date", "section_name", "news_desk"],
        "article_id",
    )
    return tables.in_months(
        tables.current(p.spark, name), "pub_date", dt.date(1997, 3, 10), dt.date(1997, 4, 20)
    )


def _interleaved(p: Press) -> DataFrame:
    """Articles of two desks, from a table in which the filter's column is the last of three clustered ones."""
    name = _new_table(p, "interleaved_articles")
    rows = p.archive.select("article_id", "pub_date", "section_name", "news_desk", "word_count")
    tables.write_table(rows, name, cluster=["pub_date", "section_name", "news_desk"], key="article_id", interleave=True)
    return tables.current(p.spark, name).where(F.col("news_desk").isin("1-URGENT", "5-LOW"))


def _full_refresh(p: Press) -> DataFrame:
    """The article fact built from a part, then rebuilt from everything by a full refresh."""
    name = _new_table(p, "refreshed_fct")

    def build(stg: DataFrame) -> DataFrame:
        return core.fct_articles(stg, p.unique_ids).withColumn(
            "part_month", tables.month_of("pub_date")
        )

    for part in (p.stg.where("pub_year = 1999"), p.stg):
        tables.run_incremental(
            p.spark, name, part, build, ["article_id"], "pub_date", "part_month", full_refresh=True
        )
    return tables.current(p.spark, name).select("article_id", "pub_date", "keyword_count")


def _layers(p: Press) -> DataFrame:
    """Staging as a view, the fact and the monthly mart as tables of their layers."""
    prefix = f"news_{p.mark}_{p.fresh()}_"
    for layer in tables.LAYERS:
        database = tables.layer_name(layer, prefix)
        tables.create_database(p.spark, database, f"{p.root}/db/{database}")
    stg = tables.materialize(p.stg, f"stg_articles_{p.mark}", "view")
    core_db, marts_db = (tables.layer_name(layer, prefix) for layer in ("core", "analytics"))
    fct = tables.materialize(
        core.fct_articles(stg, p.unique_ids), f"{core_db}.fct_articles", "table"
    )
    months = tables.materialize(marts.agg_articles_by_month(fct), "agg_articles_by_month", "inline")
    tables.materialize(months, f"{marts_db}.agg_articles_by_month", "table")
    return tables.layer_table(p.spark, "analytics", "agg_articles_by_month", prefix)


def _declared_source(p: Press) -> DataFrame:
    """The loaded popularity source with its columns as declared, whatever order they are stored in."""
    stored = p.popular.select(*reversed(p.popular.columns), F.lit("extra").alias("not_declared"))
    return _readable_popular(tables.declared(stored, schemas.POPULAR_ARTICLES))


def _backfilled(p: Press) -> tuple[load.Targets, DataFrame]:
    to = _targets(p, f"backfill_{p.fresh()}")
    report = load.backfill(p.spark, to)
    return to, report


def _spoiled_landing(p: Press) -> str:
    """Slim files of two days and two months, one of each with a record that does not fit, and an undated file."""
    folder = f"{p.root}/spoiled"

    def write() -> None:
        months = p.archive.where("pub_date < '1995-03-01'")
        bad = F.when((F.month("pub_date") == 2) & (_key() % 7 == 0), "12x").otherwise(F.col("word_count").cast("string"))
        rows = months.select(
            "article_id", F.date_format("pub_date", "yyyy-MM-dd").alias("pub_date"), bad.alias("word_count"),
            F.year("pub_date").alias("year"), F.month("pub_date").alias("month"),
        )
        rows.repartition(1).write.partitionBy("year", "month").json(f"{folder}/{ARCHIVE_SLIM}")
        days = p.popular.where("snapshot_date <= '2024-01-02'")
        bad = F.when(F.day("snapshot_date") == 2, "none").otherwise(F.col("asset_id").cast("string"))
        rows = days.select("id", bad.alias("asset_id"), "snapshot_date")
        rows.repartition(1).write.partitionBy("snapshot_date").json(f"{folder}/{POPULAR_SLIM}")
        rows.drop("snapshot_date").repartition(1).write.json(f"{folder}/{POPULAR_SLIM}/undated")

    p.once("spoiled", folder, write)
    return folder


def _spoiled_targets(p: Press, name: str) -> load.Targets:
    fresh = p.fresh()
    return load.create_targets(
        p.spark, f"news_{name}_{p.mark}_{fresh}", f"{p.root}/db/{name}-{fresh}", _spoiled_landing(p)
    )


def _backfill_outcomes(p: Press) -> DataFrame:
    """Files per feed and outcome of a first and a second backfill over a landing folder with bad files."""
    to = _spoiled_targets(p, "outcomes")
    first = load.backfill(p.spark, to, strict=False).withColumn("run", F.lit(1))
    second = load.backfill(p.spark, to, strict=False).withColumn("run", F.lit(2))
    return first.unionByName(second)


def _listed_in_steps(p: Press) -> DataFrame:
    """Slim months and days, how often each was listed in two backfills, with all but the last open ones closed by the first."""
    landing = _landing(p)
    to = _targets(p, f"steps_{p.fresh()}")
    day = p.popular.agg(F.max("snapshot_date")).first()[0]
    seen = None
    for run in (1, 2):
        open_files = listing.Listing(p.spark, to.database, landing).list_open(day)
        counted = open_files.select("feed", "period").distinct()
        saved = p.saved(f"listed_{to.database}_{run}", lambda c=counted: c)
        seen = saved if seen is None else seen.unionByName(saved)
        load.backfill(p.spark, to, as_of=day)
    return seen.groupBy("feed", "period").agg(F.count(F.lit(1)).alias("times_listed"))


def _replayed(p: Press) -> DataFrame:
    """Articles by month, with every 40th id missing, after a load that is stopped behind its merge and two that go on."""
    folder = f"{p.root}/keyless"

    def write() -> None:
        rows = p.archive.where("pub_date < '1996-01-01'").select(
            F.when(_key() % 40 != 0, F.col("article_id")).alias("article_id"),
            F.date_format("pub_date", "yyyy-MM-dd").alias("pub_date"),
            F.year("pub_date").alias("year"), F.month("pub_date").alias("month"),
        )
        rows.repartition(1).write.partitionBy("year", "month").option("ignoreNullFields", "false").json(f"{folder}/{ARCHIVE_SLIM}")

    p.once("keyless", folder, write)
    fresh = p.fresh()
    to = load.create_targets(p.spark, f"news_replayed_{p.mark}_{fresh}", f"{p.root}/db/replayed-{fresh}", folder)
    slim_rows = records.slim_archive(p.spark, f"{folder}/{ARCHIVE_SLIM}")
    # what a load leaves that is stopped between its merge and its last note: rows of an attempt that isn't done
    book = ledger.Ledger(p.spark, to.archive)
    rows = shaping.archive_rows(shaping.accepted_articles(shaping.checked_articles(slim_rows)))
    rows = rows.withColumns({"part_month": tables.month_of("pub_date"), ledger.LOAD_ID: F.lit("stopped/1")})
    months = [r[0] for r in rows.select("part_month").distinct().collect()]
    book.note("stopped", "stopped/1", ledger.BEGUN, months)
    tables.write_table(rows, to.archive, "part_month", mode="append")
    for _ in range(2):
        load.load_records(p.spark, to, ARCHIVE_SLIM, slim_rows)
    return (
        tables.current(p.spark, to.archive).groupBy("part_month")
        .agg(F.count(F.lit(1)).alias("articles"), F.count("article_id").alias("with_id"), F.countDistinct("article_id").alias("ids"))
    )


def _no_manifest(p: Press) -> DataFrame:
    return p.spark.createDataFrame([], schemas.struct_type(schemas.LOAD_MANIFEST))


def _refused_files(p: Press) -> DataFrame:
    """What a stream refused, by feed, folder and reason."""
    to = _spoiled_targets(p, "refused")
    for feed in (ARCHIVE_SLIM, POPULAR_SLIM):
        start_loading(p.spark, to, feed, f"{p.root}/stream/{p.fresh()}", available_now=True).awaitTermination()
    path = F.col("path")
    return (
        tables.current(p.spark, to.refused)
        .groupBy(
            "source", files.path_year(path).alias("year"), files.path_month(path).alias("month"),
            files.path_snapshot_date(path).alias("snapshot_date"), "reason",
        )
        .agg(F.count(F.lit(1)).alias("files"))
    )


def _loaded(p: Press) -> DataFrame:
    """The archive table after two backfills; the second one finds every file noted."""
    to, _ = _backfilled(p)
    load.backfill(p.spark, to)
    return _readable(tables.current(p.spark, to.archive))


def _loaded_popular(p: Press) -> DataFrame:
    to, _ = _backfilled(p)
    return _readable_popular(tables.current(p.spark, to.popular))


def _manifest(p: Press) -> DataFrame:
    """Feeds and folders in the manifest after a backfill, each file once."""
    to, _ = _backfilled(p)
    path = F.concat(F.lit("/"), F.col("path"))
    once = tables.current(p.spark, to.manifest).groupBy("source", "path").agg(F.count(F.lit(1)).alias("n"))
    return (
        once.select(
            "source",
            files.path_year(path).alias("year"),
            files.path_month(path).alias("month"),
            files.path_snapshot_date(path).alias("snapshot_date"),
            F.col("n").alias("times_noted"),
        )
        .distinct()
    )


def _streamed(p: Press) -> DataFrame:
    """The archive table after a stream has taken all files, and again with a new checkpoint."""
    to = _targets(p, f"stream_{p.fresh()}")
    for run in ("first", "second"):
        query = start_loading(
            p.spark, to, ARCHIVE_SLIM, f"{p.root}/stream/{p.fresh()}-{run}", available_now=True
        )
        query.awaitTermination()
    return _readable(tables.current(p.spark, to.archive))


def _streamed_popular(p: Press) -> DataFrame:
    """The popularity table after a stream of its feed; the archive feed is not written, as the stream never reads it."""
    to = _targets(p, f"stream_{p.fresh()}", archive=False)
    query = start_loading(
        p.spark, to, POPULAR_SLIM, f"{p.root}/stream/{p.fresh()}", available_now=True
    )
    query.awaitTermination()
    return _readable_popular(tables.current(p.spark, to.popular))


MODELS: dict[str, Callable[[Press], DataFrame]] = {
    "s1_s4_raw_archive_scan": lambda p: _docs(p).where(F.col(schemas.CORRUPT).isNull()).select(
        F.col("_id").alias("article_id"), "year", "month", "word_count"
    ),
    "s2_raw_popular_scan": lambda p: _results(p).select("snapshot_date", "id", "asset_id"),
    "s1_raw_month_objects": lambda p: records.raw_archive(p.spark, _raw_months(p)).select(
        F.col("_id").alias("article_id"), "year", "month", "word_count"
    ),
    "s2_raw_day_objects": lambda p: records.raw_popular(p.spark, _raw_days(p)).select(
        "snapshot_date", "id", "asset_id"
    ),
    "s9_refused_files": _refused_files,
    "s9_replayed_batch": _replayed,
    "s10_listed_in_steps": _listed_in_steps,
    "k12_backfill_outcomes": _backfill_outcomes,
    "s3_s8_feed_folders": _feed_folders,
    "s5_popular_file_dates": _popular_files,
    "s6_slim_archive_scan": lambda p: _readable(records.slim_archive(p.spark, _slim_archive(p))),
    "s7_slim_popular_scan": lambda p: _readable_popular(
        records.slim_popular(p.spark, _slim_popular(p))
    ),
    "s9_streamed_archive": _streamed,
    "s9_streamed_popular": _streamed_popular,
    "s10_months_left": _months_left,
    "s10_files_by_status": lambda p: files.status_counts(
        files.file_status(
            files.route(files.list_files(p.spark, _spoiled_landing(p)), _spoiled_landing(p)),
            _no_manifest(p),
        )
    ),
    "s11_declared_source": _declared_source,
    "t1_slim_articles": lambda p: _readable(shaping.accepted_articles(_checked(p))),
    "t2_slim_popular": lambda p: _readable_popular(shaping.accepted_popular(_checked_popular(p))),
    "t3_media_counts": lambda p: shaping.slim_articles(
        _docs(p).where(F.col(schemas.CORRUPT).isNull())
    ).select("article_id", _counts("multimedia_count_by_type").alias("media")),
    "t5_rejected_articles": lambda p: shaping.rejected(_checked(p))
    .groupBy(shaping.REASON)
    .agg(F.count(F.lit(1)).alias("records")),
    "t5_rejected_popular": lambda p: shaping.rejected(_checked_popular(p)).select(
        "id", "snapshot_date", shaping.REASON
    ),
    "t7_archive_rows": lambda p: shaping.archive_rows(
        shaping.accepted_articles(_checked(p))
    ).select("article_id", "pub_date", "word_count"),
    "k1_k2_slim_months": _skipped_then_written,
    "k2_overwritten_days": _overwritten,
    "k3_k6_loaded_archive": _loaded,
    "k5_k7_loaded_popular": _loaded_popular,
    "k6_insert_only_merge": _insert_only,
    "k6_merge_by_key_index": _merged_by_index,
    "k7_insert_only_merge_popular": _insert_only_popular,
    "k8_k9_manifest": _manifest,
    "k11_clustered_months": _clustered,
    "k11_interleaved_desks": _interleaved,
    "k13_s12_layers": _layers,
    "k14_upsert": _upserted,
    "k15_incremental_fct": _incremental,
    "k16_full_refresh": _full_refresh,
}
