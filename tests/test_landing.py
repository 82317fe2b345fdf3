"""How loads write: raw files parsed once, records that lie together not shuffled, loaded files not read again."""

import gzip
import json

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_loads import article, database, put_archive, put_raw, targets  # noqa: F401

from newsmart.functions.exprs import coerce_long
from newsmart.operators import ledger, load, shaping, slim, tables
from newsmart.sources import files, records, views
from newsmart.sources.files import ARCHIVE_SLIM
from newsmart.streaming.loader import start_loading


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def names(folder, ending):
    return sorted(p for p in folder.rglob("*") if p.is_file() and p.name.endswith(ending))


# --- slim files (F1) -----------------------------------------------------------------------------


def test_raw_files_are_parsed_once(spark, tmp_path, monkeypatch):
    put_raw(tmp_path, "2020/01.json", {"_id": "a"}, {"_id": "b", "word_count": "x"})
    put_raw(tmp_path, "2020/02.json", {"_id": "c"})
    real, read = slim.write_slim, []

    def seen(accepted, *args):
        read.extend(accepted.inputFiles())
        real(accepted, *args)

    monkeypatch.setattr(slim, "write_slim", seen)
    out = tmp_path / "slim"
    rejected = slim.transform_archive(spark, str(tmp_path / "archive_raw"), str(out))
    assert read and not [f for f in read if "archive_raw" in f]
    assert rows(rejected, "article_id", "month") == [("b", 1)]
    found = records.slim_archive(spark, str(out))
    assert rows(found, "article_id") == [("a",), ("c",)]
    assert spark.catalog.listTables(tables.SCRATCH) == []


def test_slim_records_that_lie_together_stay_where_they_are(spark, tmp_path):
    """Two tasks with a folder each, and eight tasks that all have rows of five folders."""
    near = spark.range(0, 40, 1, 2).select("id", (F.col("id") >= 20).cast("int").alias("year"))
    far = spark.range(0, 40, 1, 8).select("id", (F.col("id") % 5).cast("int").alias("year"))
    assert tables.lie_together(tables.pieces(near, "year"))
    assert not tables.lie_together(tables.pieces(far, "year"))
    assert tables.lie_together([])
    for name, df, n in (("near", near, 2), ("far", far, 5)):
        slim.write_slim(df, str(tmp_path / name), ["year"], False)
        assert len(names(tmp_path / name, ".json")) == n
        back = spark.read.schema("id bigint, year int").json(str(tmp_path / name))
        assert rows(back, "id", "year") == rows(df, "id", "year")


def test_more_folders_than_writers(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "WRITERS", 2)
    df = spark.range(0, 30, 1, 1).select("id", (F.col("id") % 6).cast("int").alias("year"))
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    slim.write_slim(df, str(tmp_path / "out"), ["year"], False)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    assert rows(spark.read.schema("id bigint, year int").json(str(tmp_path / "out")), "id", "year") == rows(df, "id", "year")


# --- loads (F2, F4) ------------------------------------------------------------------------------


def test_whole_files_are_told_without_a_shuffle_of_records(spark, tmp_path, database):  # noqa: F811
    put_archive(tmp_path, "2020/05.json", article("a"), article("b"))
    put_archive(tmp_path, "2020/06.json", article("c"), article("d", word_count="x"))
    put_archive(tmp_path, "2020/07.json", article("e"))
    read = records.slim_archive(spark, str(tmp_path / ARCHIVE_SLIM))
    read = shaping.checked_articles(read).withColumn("file_path", files.below("file_path", str(tmp_path)))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with lists of files too large to be sent around
    try:
        with tables.scratch(read.drop("_corrupt_record")) as saved:
            done = spark.createDataFrame([("archive_slim/2020/07.json",)], "path string")
            none = spark.createDataFrame([], "path string")
            whole = load._whole_files(spark.table(saved), none, done)
            assert "Exchange" not in plan(whole)
            assert rows(whole, "article_id") == [("a",), ("b",)]
            assert rows(load._whole_files(spark.table(saved), done, none), "article_id") == [("a",), ("b",)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("indexed", [False, True])
def test_stored_rows_are_merged_without_another_copy(spark, database, monkeypatch, indexed):  # noqa: F811
    name, source = f"{database}.merged", f"{database}.source"
    tables.write_table(spark.createDataFrame([], "article_id string, n int, load_id string, part_month string"), name, "part_month")
    given = [("a", 1, "2020-01"), (None, 1, None), ("b", 1, "2020-02"), ("b", 2, "2020-02")]
    tables.write_table(spark.createDataFrame(given, "article_id string, n int, part_month string"), source)
    index = load.KeyIndex(spark, name, "article_id") if indexed else None

    def copied(*_):
        raise AssertionError("copied")

    monkeypatch.setattr(ledger, "scratch", copied)
    for batch in ("1", "2"):
        rows_in = spark.table(source).where("article_id is not null") if batch == "2" else spark.table(source)
        assert ledger.merge_batch(spark, name, rows_in, ["article_id"], "part_month", batch, index=index, stored=True)
    assert rows(tables.current(spark, name), "article_id", "n", "part_month") == sorted(given, key=repr)


# --- integers (F3) -------------------------------------------------------------------------------


def test_plain_digits_are_told_by_one_look(spark):
    text = coerce_long(F.col("t"))
    assert text._jc.toString().startswith("CASE WHEN rlike(t, ")
    given = [("7", 7), ("+7", 7), ("7\n", 7), (" 7\u0085", 7), ("\x007", None), ("7\x07", None), ("٧", None), ("9" * 19, None)]
    df = spark.createDataFrame(given, "t string, want bigint")
    assert df.where(~text.eqNullSafe(F.col("want"))).collect() == []


def test_year_and_month_of_deep_paths(spark):
    given = [
        ("/x/1999/01/y/2020/05/f.json", 2020, 5), ("1999/01.json", 1999, 1), ("/a/year=2020/month=7/f.json.gz", 2020, 7),
        ("2020/05/f.json", 2020, 5), ("/2020/5/a/f.json", None, None), ("x2020/05/f.json", None, None), ("/a/b/2020/11.json", 2020, 11),
    ]
    df = spark.createDataFrame(given, "p string, y int, m int")
    bad = ~(files.path_year(F.col("p")).eqNullSafe(F.col("y")) & files.path_month(F.col("p")).eqNullSafe(F.col("m")))
    assert df.where(bad).collect() == []


# --- streams (F5) --------------------------------------------------------------------------------


def test_a_new_checkpoint_does_not_read_loaded_files_again(spark, tmp_path, targets):  # noqa: F811
    def run(checkpoint):
        query = start_loading(spark, targets, ARCHIVE_SLIM, str(tmp_path / checkpoint), available_now=True)
        query.awaitTermination()
        return query.exception()

    folder = tmp_path / "in" / ARCHIVE_SLIM / "2020"
    folder.mkdir(parents=True)
    for month in ("05", "06 [a]{b}"):
        (folder / f"{month}.json.gz").write_bytes(gzip.compress(json.dumps(article(f"m{month[:2]}")).encode()))
    assert run("first") is None
    for path in folder.glob("*.gz"):  # can't be read any more
        path.write_bytes(path.read_bytes()[:20])
        crc = path.with_name(f".{path.name}.crc")
        assert not crc.exists()
    put_archive(tmp_path / "in", "2020/07.json", article("m07"))
    assert run("second") is None
    assert rows(tables.current(spark, targets.archive), "article_id") == [("m05",), ("m06",), ("m07",)]
    assert tables.current(spark, targets.manifest).count() == 3


# --- views ---------------------------------------------------------------------------------------


def test_lines_are_gathered_once_per_order(spark, tmp_path):
    """A repeated line and part count in the media, and once in keywords and persons."""
    line = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_returnflag string, l_linestatus string"
    given = [(1, 1, 5, 1, "R", "O"), (1, 1, 5, 1, "R", "O"), (1, 2, 7, 2, "N", "F"), (1, 9, None, 3, "N", "F"), (2, None, 5, 4, None, "F")]
    spark.createDataFrame(given, line).write.parquet(str(tmp_path / "lineitem.parquet"))
    part = [(1, "T", "Brand#1", "n"), (1, "T", "Brand#1", "n"), (2, "U", "Brand#7", "n")]
    spark.createDataFrame(part, "p_partkey bigint, p_type string, p_brand string, p_name string").write.parquet(str(tmp_path / "part.parquet"))
    found = {r.o_orderkey: r for r in views._lines(spark, str(tmp_path)).collect()}
    assert found[1].multimedia_count_by_type == {"F": 2, "O": 4} and found[2].multimedia_count_by_type == {"F": 1}
    assert [(k.name, k.value, k.rank, k.major) for k in found[1].keywords] == [("t", "Brand#1 n", 1, "Y"), ("u", None, 2, "N")]
    assert len(found[1].byline_person) == 3 and found[2].keywords == []  # supplier 7 stands twice
