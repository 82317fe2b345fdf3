"""Article-shaped views of the order, line-item and event tables.

An order becomes an article, its lines become keywords, authors and media; a user's events of a day
become a row of that day's popularity snapshot. Nulls, blanks and repeated entries are put in by key
arithmetic so that the cleaning and counting rules have work to do.

Distinct keywords and suppliers are gathered per order in one shuffle; the media counts come from a narrow second
pass over the lines, per order and line status first, so that partial sums meet and not single lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmart.schemas import KEYWORDS, PERSONS, POPULAR_ARTICLES, struct_type

def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _every(key: Column, n: int, rest: int = 0) -> Column:
    return key % n == rest


def _keyword() -> Column:
    brand = F.col("p_brand")
    value = F.when(brand == "Brand#13", " ").when(
        brand != "Brand#7", F.concat_ws(" ", "p_brand", "p_name")
    )
    return F.struct(
        F.col("l_linenumber").cast("bigint").alias("rank"),
        F.lower("p_type").alias("name"),
        value.alias("value"),
        F.when(F.col("l_returnflag") == "R", "Y").otherwise("N").alias("major"),
    )


def _person(number: Column) -> Column:
    text = number.cast("string")
    return F.struct(
        F.when(~_every(number, 5), F.concat(F.lit("F"), (number % 10).cast("string"))).alias(
            "firstname"
        ),
        F.when(~_every(number, 25), F.concat(F.lit("Author#"), F.lpad(text, 9, "0"))).alias(
            "lastname"
        ),
        F.when(_every(number, 3), F.concat(F.lit("M"), text)).alias("middlename"),
        F.lit(None).cast("string").alias("qualifier"),
    )


def _some_twice(entries: Column, chosen) -> Column:
    """The entries in order, the chosen ones two times."""
    return F.sort_array(F.concat(entries, F.filter(entries, chosen)))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keywords, persons and media counts of each order."""
    lines = _read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus"
    )
    parts = _read(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand", "p_name")
    joined = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
    sets = joined.groupBy("l_orderkey").agg(
        F.collect_set(F.when(F.col("p_partkey").isNotNull(), _keyword())).alias("k"),
        F.collect_set("l_suppkey").alias("s"),
    )
    by_status = joined.groupBy("l_orderkey", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))
    entry = F.struct("l_linestatus", "n")
    media = by_status.groupBy("l_orderkey").agg(F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("media"))
    by_order = sets.join(media, "l_orderkey")
    return by_order.select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.transform(
            _some_twice(F.col("k"), lambda k: k["rank"] % 4 == 0),
            lambda k: F.struct(
                k["name"].alias("name"), k["value"].alias("value"), k["rank"].alias("rank"),
                k["major"].alias("major"),
            ),
        ).alias("keywords"),
        F.sort_array(F.transform(_some_twice(F.col("s"), lambda n: n % 6 == 1), _person)).alias(
            "byline_person"
        ),
        F.col("media").alias("multimedia_count_by_type"),
    )


def archive_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One article per order, in the loaded-table schema."""
    key = F.col("o_orderkey")
    text = key.cast("string")
    segment = F.col("c_mktsegment")
    section = (
        F.when(_every(key, 17), "  ")
        .when(_every(key, 19), F.lit(None))
        .when(_every(key, 23), F.concat(F.lit(" "), segment, F.lit(" ")))
        .otherwise(segment)
    )
    status = F.col("o_orderstatus")
    material = F.when(status == "O", "News").when(status == "F", "Op-Ed").when(
        status == "P", "Review"
    )
    words = (F.floor("o_totalprice") % 5000).cast("bigint")
    columns = {
        "article_id": F.concat(F.lit("a"), text),
        "uri": F.concat(F.lit("press://article/"), text),
        "pub_date": F.to_date("o_orderdate"),
        "section_name": section,
        "news_desk": F.when(~_every(key, 29), F.col("o_orderpriority")),
        "type_of_material": material,
        "document_type": F.lit("article"),
        "word_count": F.when(~_every(key, 13), words),
        "web_url": F.concat(F.lit("https://press.example/a/"), text),
        "headline_main": F.concat(F.lit("  Report "), text, F.lit(" ")),
        "byline_original": F.concat(F.lit("By "), F.col("o_orderpriority")),
        "abstract": F.when(~_every(key, 7), F.concat(F.lit("Abstract of "), text)),
        "snippet": F.concat(F.lit("\t"), (key % 100).cast("string"), F.lit(" lines ")),
        "keywords": F.coalesce("keywords", F.array().cast(KEYWORDS)),
        "byline_person": F.coalesce("byline_person", F.array().cast(PERSONS)),
        "multimedia_count_by_type": F.col("multimedia_count_by_type"),
    }
    orders = _read(spark, sf_dir, "orders")
    customers = _read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
    joined = joined.join(_lines(spark, sf_dir), "o_orderkey", "left")
    return joined.select(*[c.alias(n) for n, c in columns.items()])


def _facet(user: Column, k: Column, modulus: int, shift: int) -> Column:
    """``k mod modulus`` facet values that read like the archive's keyword values."""
    return F.transform(
        F.filter(F.array(*[F.lit(i) for i in range(modulus - 1)]), lambda i: i < k % modulus),
        lambda i: F.concat(
            F.lit("Brand#"), (1 + (user + shift + i) % 25).cast("string"), F.lit(" red widget")
        ),
    )


def popular_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events of a user and day as one snapshot row, in the loaded-table schema.

    The newest event gives the section, the number in the events' properties is summed up.
    """
    number = F.regexp_extract("props", r'"k": (\d+)', 1).cast("bigint")
    first = (
        _read(spark, sf_dir, "events")
        .groupBy(F.to_date("ts").alias("snapshot_date"), "user_id")
        .agg(
            F.max("event_id").alias("event_id"), F.max("ts").alias("ts"),
            F.max_by("event_type", "event_id").alias("event_type"), F.sum(number).alias("k"),
        )
    )
    user, event, k = F.col("user_id"), F.col("event_id"), F.col("k")
    age = (user * 7 % 500).cast("int")
    published = F.when(_every(user, 31, 30), "2023-13-45").otherwise(
        F.date_format(F.date_sub("snapshot_date", age), "yyyy-MM-dd")
    )
    user_text, event_text = user.cast("string"), event.cast("string")
    images = F.create_map(F.lit("image"), k % 3 + 1)
    columns = {
        "snapshot_date": F.col("snapshot_date"),
        "id": user,
        "uri": F.concat(F.lit("press://popular/"), user_text),
        "url": F.concat(F.lit("https://press.example/p/"), user_text),
        "asset_id": event,
        "source": F.when(_every(user, 4), F.lit(None)).otherwise(F.lit("Press")),
        "published_date": published,
        "updated": F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
        "section": F.when(_every(user, 9), " ").otherwise(F.col("event_type")),
        "subsection": F.when(_every(user, 2), "").otherwise(
            F.concat(F.lit("sub"), (user % 3).cast("string"))
        ),
        "byline": F.concat(F.lit(" By user "), user_text),
        "type": F.when(_every(event, 3), "Interactive").otherwise(F.lit("Article")),
        "title": F.concat(F.lit("Title "), user_text, F.lit("  ")),
        "abstract": F.concat(F.lit("About "), event_text),
        "des_facet": _facet(user, k, 4, 0),
        "org_facet": _facet(user, k, 3, 5),
        "per_facet": _facet(user, k, 7, 10),
        "geo_facet": _facet(user, k, 5, 15),
        "media_count_by_type": F.when(~_every(k, 6), images),
        "adx_keywords": F.concat(F.lit("k="), k.cast("string")),
    }
    return first.select(*[c.alias(n) for n, c in columns.items()]).to(struct_type(POPULAR_ARTICLES))
