"""File listings, slim files, merges, incremental tables, backfill and stream."""

import datetime as dt
import itertools
import json
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from newsmart import schemas
from newsmart.operators import load, slim, tables
from newsmart.operators.staging import stg_archive_articles
from newsmart.registry import loads
from newsmart.session import shared_dir
from newsmart.sources import files, records
from newsmart.sources.files import ARCHIVE_SLIM, POPULAR_SLIM
from newsmart.streaming.loader import start_loading

D = dt.date
_names = itertools.count()


@pytest.fixture
def database(spark, tmp_path):
    name = f"db{next(_names)}"
    tables.create_database(spark, name, str(tmp_path / name))
    return name


def put(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(f"{line if isinstance(line, str) else json.dumps(line)}\n" for line in lines))
    return path


def put_archive(root, month, *docs):
    return put(root / ARCHIVE_SLIM / month, *docs)


def put_popular(root, day, *docs):
    return put(root / POPULAR_SLIM / day / "viewed_30.ndjson", *docs)


def article(i, day="2020-05-06", **more):
    return {"article_id": i, "pub_date": f"{day}T04:00:00+0000", "keywords": [], "byline_person": [],
            **more}


# --- listings ------------------------------------------------------------------------------------


def test_routing(spark, tmp_path):
    put_archive(tmp_path / "in", "2020/05.ndjson", {})
    put_popular(tmp_path / "in", "2026-02-19", {})
    put_popular(tmp_path / "in", "latest", {})
    put(tmp_path / "in" / "other" / ARCHIVE_SLIM / "2020" / "01.ndjson", {})
    put(tmp_path / "in" / ARCHIVE_SLIM / "2020" / "notes.txt", "x")
    listed = files.list_files(spark, str(tmp_path))
    assert listed.count() == 5
    routed = files.route(listed, str(tmp_path), prefix="in")
    assert rows(routed, "object_path", "feed", "snapshot_date") == [
        ("archive_slim/2020/05.ndjson", ARCHIVE_SLIM, None),
        ("archive_slim/2020/notes.txt", ARCHIVE_SLIM, None),
        ("most_popular_slim/2026-02-19/viewed_30.ndjson", POPULAR_SLIM, D(2026, 2, 19)),
        ("most_popular_slim/latest/viewed_30.ndjson", POPULAR_SLIM, None),
        ("other/archive_slim/2020/01.ndjson", None, None),
    ]
    manifest = spark.createDataFrame(
        [(ARCHIVE_SLIM, "archive_slim/2020/05.ndjson")], "source string, path string"
    )
    status = files.file_status(routed, manifest)
    assert rows(files.status_counts(status), "feed", "status", "files") == [
        (ARCHIVE_SLIM, "loaded", 1), (POPULAR_SLIM, "no snapshot date", 1),
        (POPULAR_SLIM, "pending", 1),
    ]


@pytest.mark.parametrize(
    ("path", "year", "month"),
    [
        ("file:/a/archive_raw/2020/05.json", 2020, 5),
        ("s3://b/archive_slim/1995/12.ndjson", 1995, 12),
        ("/x/year=2001/month=3/part-0.json", 2001, 3),
        ("/x/archive/readme.json", None, None),
    ],
)
def test_month_of_a_path(spark, path, year, month):
    df = spark.createDataFrame([(path,)], "p string")
    p = F.col("p")
    assert tuple(df.select(files.path_year(p), files.path_month(p)).first()) == (year, month)


# --- slim files ----------------------------------------------------------------------------------


def put_raw(root, month, *docs):
    return put(root / "archive_raw" / month, {"response": {"docs": list(docs)}})


def test_transform_skips_months_that_exist(spark, tmp_path):
    raw, out = str(tmp_path / "archive_raw"), str(tmp_path / ARCHIVE_SLIM)
    put_raw(tmp_path, "2020/01.json", {"_id": "a", "word_count": 3}, {"_id": "b", "word_count": "x"})
    rejected = slim.transform_archive(spark, raw, out)
    assert rows(rejected, "article_id", "month") == [("b", 1)]
    put_raw(tmp_path, "2020/01.json", {"_id": "changed"})
    put_raw(tmp_path, "2020/02.json", {"_id": "c"})
    assert slim.transform_archive(spark, raw, out).count() == 0
    assert rows(records.slim_archive(spark, out), "article_id", "word_count") == [
        ("a", "3"), ("c", None)
    ]
    assert slim.transform_archive(spark, raw, out) is None
    slim.transform_archive(spark, raw, out, overwrite=True)
    assert rows(records.slim_archive(spark, out), "article_id") == [("c",), ("changed",)]


def test_slim_lines_hold_nulls(spark, tmp_path):
    put(tmp_path / "most_popular_raw" / "2026-02-19" / "viewed_30.json",
        {"results": [{"id": 1, "media": []}], "num_results": 1})
    out = tmp_path / POPULAR_SLIM
    slim.transform_popular(spark, str(tmp_path / "most_popular_raw"), str(out))
    (line,) = [json.loads(x) for f in out.rglob("*.json") for x in f.read_text().splitlines()]
    assert line["id"] == 1 and line["title"] is None and line["media_count_by_type"] is None
    assert line["des_facet"] == [] and set(line) == set(schemas.SLIM_POPULAR)
    assert rows(records.slim_popular(spark, str(out)), "id", "snapshot_date") == [
        ("1", D(2026, 2, 19))
    ]


def test_no_raw_files(spark, tmp_path):
    (tmp_path / "archive_raw").mkdir()
    assert slim.transform_archive(spark, str(tmp_path / "archive_raw"), str(tmp_path / "out")) is None


# --- merges --------------------------------------------------------------------------------------

PAIR = "article_id string, n int, part_month string"


def test_insert_only_merge(spark):
    target = spark.createDataFrame([("a", 1), ("n", 1), (None, 1)], "article_id string, n int")
    source = spark.createDataFrame(
        [("a", 2), ("b", 2), ("b", 3), (None, 2)], "article_id string, n int"
    )
    # Matches are not updated, repeats within the source all come in, null keys always do.
    fresh = tables.insert_only(source, target, ["article_id"])
    assert rows(fresh, "article_id", "n") == [("b", 2), ("b", 3), (None, 2)]
    once = tables.insert_only(source, target, ["article_id"], dedupe_source=True)
    assert sorted(r[0] or "" for r in rows(once, "article_id")) == ["", "b"]
    two = tables.insert_only(
        source.withColumn("d", F.lit(1)), target.withColumn("d", F.lit(2)), ["d", "article_id"]
    )
    assert two.count() == 4


def test_merge_into_empty_and_again(spark, database):
    name = f"{database}.merged"
    empty = spark.createDataFrame([], PAIR)
    tables.write_table(empty, name, "part_month")
    source = spark.createDataFrame([("a", 1, "2020-01"), ("b", 1, None)], PAIR)
    for _ in range(2):
        tables.merge_into(spark, name, source, ["article_id"], "part_month")
    assert rows(tables.current(spark, name), "article_id", "part_month") == [("a", "2020-01"), ("b", None)]


def test_upsert_moves_rows_between_partitions(spark, database):
    name = f"{database}.upserted"
    before = [("a", 1, "2020-01"), ("b", 1, "2020-01"), ("c", 1, "2020-02"), ("d", 1, None)]
    tables.write_table(spark.createDataFrame(before, PAIR), name, "part_month")
    new = [("c", 2, "2020-03"), ("a", 2, "2020-01"), ("e", 2, "2020-03"), ("d", 2, "2020-03")]
    tables.upsert(spark, name, spark.createDataFrame(new, PAIR), ["article_id"], "part_month")
    after = [
        ("a", 2, "2020-01"), ("b", 1, "2020-01"), ("c", 2, "2020-03"), ("d", 2, "2020-03"),
        ("e", 2, "2020-03"),
    ]
    assert rows(tables.current(spark, name), "article_id", "n", "part_month") == after
    # Nothing new leaves the table as it is.
    tables.upsert(spark, name, spark.createDataFrame([], PAIR), ["article_id"], "part_month")
    assert rows(tables.current(spark, name), "article_id", "n", "part_month") == after


def _fact(stg):
    return stg.select("article_id", "pub_date", "word_count").withColumn(
        "part_month", tables.month_of("pub_date")
    )


def _run(spark, name, source, **more):
    tables.run_incremental(
        spark, name, stg_archive_articles(source), _fact, ["article_id"], "pub_date", "part_month",
        **more,
    )


def test_incremental_runs(spark, database, articles):
    name = f"{database}.facts"
    _run(spark, name, articles(
        {"article_id": "1", "pub_date": D(2020, 1, 5), "word_count": 1},
        {"article_id": "2", "pub_date": D(2020, 2, 5), "word_count": 1},
    ))
    _run(spark, name, articles(
        {"article_id": "1", "pub_date": D(2020, 3, 1), "word_count": 9},  # seen again, later
        {"article_id": "3", "pub_date": D(2020, 2, 5), "word_count": 9},  # not after the newest
        {"article_id": "4", "pub_date": D(2019, 1, 1), "word_count": 9},  # late
        {"article_id": "5", "word_count": 9},  # undated
        {"article_id": "6", "pub_date": D(2020, 2, 6), "word_count": 9},
    ), lookback_days=30)
    assert rows(tables.current(spark, name), "article_id", "word_count") == [("1", 9), ("2", 1), ("6", 9)]
    _run(spark, name, articles({"article_id": "7", "pub_date": D(1990, 1, 1)}), full_refresh=True)
    assert rows(tables.current(spark, name), "article_id") == [("7",)]


def test_incremental_run_on_an_empty_table_loads_nothing(spark, database, articles):
    name = f"{database}.facts"
    _run(spark, name, articles())
    _run(spark, name, articles({"article_id": "1", "pub_date": D(2020, 1, 5)}))
    assert tables.current(spark, name).count() == 0


def test_layers_and_month_pruning(spark, tmp_path):
    database = tables.layer_name("core", "dev_")
    assert (database, tables.layer_name("unheard of")) == ("dev_dbt_core", "dbt_core")
    tables.create_database(spark, database, str(tmp_path / "layer"))
    data = [(str(i), D(2020, 1 + i % 12, 1 + i % 28), "s") for i in range(100)]
    df = spark.createDataFrame(data, "article_id string, pub_date date, section_name string")
    tables.write_table(
        df.withColumn("part_month", tables.month_of("pub_date")),
        f"{database}.articles", "part_month", ["section_name"], "article_id",
    )
    first, last = D(2020, 3, 10), D(2020, 4, 20)
    found = tables.in_months(
        tables.layer_table(spark, "core", "articles", "dev_"), "pub_date", first, last
    )
    assert rows(found, "article_id") == sorted((i,) for i, d, _ in data if first <= d <= last)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part_month" in plan


# --- loads ---------------------------------------------------------------------------------------


@pytest.fixture
def targets(spark, tmp_path):
    name = f"db{next(_names)}"
    return load.create_targets(spark, name, str(tmp_path / name), str(tmp_path / "in"))


def _outcome(df):
    return {(r["feed"], r["outcome"]): r["files"] for r in df.collect()}


def test_backfill(spark, tmp_path, targets):
    root = tmp_path / "in"
    put_archive(root, "2020/05.ndjson", article("a", word_count=5), article("b"))
    put_archive(root, "2020/06.ndjson", article("a", word_count=6), article("c", "2020-06-01"))
    put_archive(root, "2020/07.ndjson", article("d"), article("bad", word_count="12x"))
    put_archive(root, "2020/08.ndjson", article("e"), '{"article_id": ')
    put_archive(root, "2020/09.ndjson", "")
    put_popular(root, "2026-02-19", {"id": 1, "title": "t"}, {"id": 2})
    put_popular(root, "2026-02-20", {"id": 1, "title": "t2"})
    put_popular(root, "today", {"id": 9})
    with pytest.raises(load.BackfillError) as failed:
        load.backfill(spark, targets)
    # A file with a record that does not fit is left out whole; a blank file counts as loaded.
    assert {(f, o): n for f, o, n in failed.value.counts} == {
        (ARCHIVE_SLIM, "loaded"): 3,
        (ARCHIVE_SLIM, "error"): 2,
        (POPULAR_SLIM, "loaded"): 2,
        (POPULAR_SLIM, "no snapshot date"): 1,
    }
    assert rows(tables.current(spark, targets.refused), "source", "path", "reason") == [
        (ARCHIVE_SLIM, "archive_slim/2020/07.ndjson", "word_count is not an integer"),
        (ARCHIVE_SLIM, "archive_slim/2020/08.ndjson", "malformed json"),
        (POPULAR_SLIM, "most_popular_slim/today/viewed_30.ndjson", "no snapshot date"),
    ]
    archive = tables.current(spark, targets.archive)
    ids = [r["article_id"] for r in archive.select("article_id").collect()]
    # Two files of one run share the source of the merge, so a repeated id comes in twice.
    assert sorted(ids) == ["a", "a", "b", "c"]
    assert rows(tables.current(spark, targets.popular), "snapshot_date", "id", "title") == [
        (D(2026, 2, 19), 1, "t"), (D(2026, 2, 19), 2, None), (D(2026, 2, 20), 1, "t2")
    ]
    put_archive(root, "2020/07.ndjson", article("d"), article("good", word_count="12"))
    put_archive(root, "2020/10.ndjson", article("a", word_count=7), article("f"))
    second = load.backfill(spark, targets, strict=False)
    assert _outcome(second)[ARCHIVE_SLIM, "loaded"] == 2
    assert _outcome(second)[ARCHIVE_SLIM, "skipped"] == 3
    found = rows(tables.current(spark, targets.archive), "article_id", "word_count", "part_month")
    assert ("good", 12, "2020-05") in found and ("f", None, "2020-05") in found
    assert not [r for r in found if r[1] == 7]
    manifest = rows(tables.current(spark, targets.manifest), "source", "path")
    assert len(manifest) == len(set(manifest)) == 7
    assert spark.catalog.listTables(tables.SCRATCH) == []  # nothing staged is left behind


def test_odd_folder_names(spark, tmp_path):
    root = tmp_path / "in a+b%c=ü"
    name = f"db{next(_names)}"
    to = load.create_targets(spark, name, str(tmp_path / name), str(root))
    put_archive(root, "2020/05.ndjson", article("a"))
    put_archive(root, "2020/06.ndjson", article("b", word_count="x"))
    for _ in range(2):
        load.backfill(spark, to, strict=False)
    assert rows(tables.current(spark, to.archive), "article_id") == [("a",)]
    assert rows(tables.current(spark, to.manifest), "path") == [("archive_slim/2020/05.ndjson",)]


def test_replay_without_manifest_adds_nothing(spark, tmp_path, targets):
    path = put_archive(tmp_path / "in", "2020/05.ndjson", article("a"), article("b"))
    slim_rows = records.slim_archive(spark, str(path))
    load.load_records(spark, targets, ARCHIVE_SLIM, slim_rows)
    # The same file under a manifest that never got its row.
    tables.write_table(
        spark.createDataFrame([], schemas.struct_type(schemas.LOAD_MANIFEST)), targets.manifest
    )
    load.load_records(spark, targets, ARCHIVE_SLIM, slim_rows)
    assert rows(tables.current(spark, targets.archive), "article_id") == [("a",), ("b",)]
    assert tables.current(spark, targets.manifest).count() == 1


def _stream(spark, targets, feed, checkpoint):
    query = start_loading(spark, targets, feed, str(checkpoint), 1, available_now=True)
    query.awaitTermination()
    assert query.exception() is None


def test_stream_loads_each_file_once(spark, tmp_path, targets):
    root = tmp_path / "in"
    put_archive(root, "2020/05.ndjson", article("a", word_count=1))
    put_archive(root, "2020/06.ndjson", article("a", word_count=2), article("b"))
    _stream(spark, targets, ARCHIVE_SLIM, tmp_path / "cp")
    found = rows(tables.current(spark, targets.archive), "article_id")
    assert found == [("a",), ("b",)]  # one file per batch: the second merge finds "a"
    put_archive(root, "2020/07.ndjson", article("c"), article("x", word_count="1.5"))
    put_archive(root, "2020/08.ndjson", article("d"))
    _stream(spark, targets, ARCHIVE_SLIM, tmp_path / "cp")
    assert rows(tables.current(spark, targets.archive), "article_id") == [("a",), ("b",), ("d",)]
    _stream(spark, targets, ARCHIVE_SLIM, tmp_path / "cp2")  # the manifest stops a new checkpoint
    assert rows(tables.current(spark, targets.archive), "article_id") == [("a",), ("b",), ("d",)]
    assert tables.current(spark, targets.manifest).count() == 3


def test_popular_stream(spark, tmp_path, targets):
    put_popular(tmp_path / "in", "2026-02-19", {"id": 1}, {"id": 2})
    put_popular(tmp_path / "in", "undated", {"id": 3})
    _stream(spark, targets, POPULAR_SLIM, tmp_path / "cp")
    assert rows(tables.current(spark, targets.popular), "snapshot_date", "id") == [
        (D(2026, 2, 19), 1), (D(2026, 2, 19), 2)
    ]
    assert rows(tables.current(spark, targets.manifest), "path") == [
        ("most_popular_slim/2026-02-19/viewed_30.ndjson",)
    ]
    with pytest.raises(ValueError):
        start_loading(spark, targets, "other", str(tmp_path / "cp"))


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_an_error_in_one_feed_does_not_stop_the_other(spark, tmp_path, targets, monkeypatch):
    put_archive(tmp_path / "in", "2020/05.ndjson", article("a"))
    put_popular(tmp_path / "in", "2026-02-19", {"id": 1})

    def broken(*_):
        raise OSError("no such disk")

    monkeypatch.setattr(records, "slim_archive", broken)
    with pytest.raises(load.BackfillError, match="no such disk") as failed:
        load.backfill(spark, targets)
    assert (POPULAR_SLIM, "loaded", 1) in failed.value.counts
    assert (ARCHIVE_SLIM, "error", 1) in failed.value.counts
    assert tables.current(spark, targets.popular).count() == 1


def test_a_few_files_at_once_load_the_same(spark, tmp_path, targets, monkeypatch):
    monkeypatch.setattr(load, "FILES_AT_ONCE", 2)
    for m in range(1, 6):
        put_archive(tmp_path / "in", f"2020/{m:02d}.ndjson", article(f"m{m}"))
    assert _outcome(load.backfill(spark, targets)) == {(ARCHIVE_SLIM, "loaded"): 5}
    assert tables.current(spark, targets.archive).count() == 5


def test_stream_notes_what_it_refuses_and_replays_add_nothing(spark, tmp_path, targets):
    put_archive(tmp_path / "in", "2020/05.ndjson", article("a"), article(None))
    put_archive(tmp_path / "in", "2020/06.ndjson", article("b", word_count="1.00000000000001"))
    put_popular(tmp_path / "in", "latest", {"id": 1})
    for turn in range(2):
        for feed in (ARCHIVE_SLIM, POPULAR_SLIM):
            _stream(spark, targets, feed, tmp_path / f"checkpoint-{turn}-{feed}")
        tables.write_table(
            spark.createDataFrame([], schemas.struct_type(schemas.LOAD_MANIFEST)), targets.manifest
        )
    # A record without a key is loaded, and once: the ledger knows the file though checkpoint and manifest are gone.
    assert rows(tables.current(spark, targets.archive), "article_id") == [("a",), (None,)]
    assert rows(tables.current(spark, targets.refused), "path", "reason") == [
        ("archive_slim/2020/06.ndjson", "word_count is not an integer"),
        ("most_popular_slim/latest/viewed_30.ndjson", "no snapshot date"),
    ]


# --- paths, slim months, merges and upserts ------------------------------------------------------


def test_values_come_from_below_the_root(spark, tmp_path):
    root = tmp_path / "2024" / "12" / "2020-02-02" / "raw"
    put(root / "1999" / "05.json", {"response": {"docs": [{"_id": "a"}, {"_id": "b"}]}})
    put(root / "notes.json", {"response": {"docs": [{"_id": "c"}]}})
    put(tmp_path / "2020-03-03" / "days" / "2021-01-05" / "viewed_30.json", {"results": [{"id": 1}, {"id": 2}]})
    found = records.raw_archive(spark, str(root))
    assert rows(found, "_id", "year", "month") == [("a", 1999, 5), ("b", 1999, 5), ("c", None, None)]
    days = records.raw_popular(spark, str(tmp_path / "2020-03-03" / "days"))
    assert rows(days, "id", "snapshot_date") == [("1", D(2021, 1, 5)), ("2", D(2021, 1, 5))]


def test_below_knows_where_the_root_is(spark):
    paths = ["file:///a/b/c/x", "file:/a/b/a/b/y", "s3://bucket/in/z", "/elsewhere/a/b/x"]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    assert [r[0] for r in df.select(files.below("path", "/a/b")).collect()] == ["c/x", "a/b/y", *paths[2:]]
    assert df.select(files.below("path", "s3://bucket/in/")).collect()[2][0] == "z"


def test_a_month_without_accepted_records_is_done(spark, tmp_path, monkeypatch):
    raw, out = tmp_path / "raw", str(tmp_path / "slim")
    put(raw / "2020" / "01.json", {"response": {"docs": []}})
    put(raw / "2020" / "02.json", {"response": {"docs": [{"_id": "a", "word_count": "x"}]}})
    put(raw / "2020" / "03.json", {"response": {"docs": [{"_id": "b"}]}})
    monkeypatch.setattr(slim, "FILES_AT_ONCE", 2)
    assert slim.transform_archive(spark, str(raw), out).count() == 1
    assert slim.transform_archive(spark, str(raw), out) is None
    put(raw / "2020" / "04.json", {"response": {"docs": [{"_id": "c"}]}})
    slim.transform_archive(spark, str(raw), out)
    assert rows(records.slim_archive(spark, out), "article_id") == [("b",), ("c",)]
    slim.transform_archive(spark, str(raw), out, overwrite=True)
    assert rows(records.slim_archive(spark, out), "article_id") == [("b",), ("c",)]


def test_merge_reads_only_the_partitions_of_the_source(spark, database):
    name = f"{database}.days"
    old = spark.createDataFrame([(D(2020, 1, d), d, "old") for d in range(1, 20)], "snapshot_date date, id long, v string")
    tables.write_table(old, name, "snapshot_date")
    source = spark.createDataFrame([(D(2020, 1, 3), 3, "new"), (D(2020, 1, 3), 99, "new")], old.schema)
    days = [r[0] for r in source.select("snapshot_date").distinct().collect()]
    target = spark.table(name).where(F.col("snapshot_date").isin(days))
    plan = tables.insert_only(source, target, ["snapshot_date", "id"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan and "2020-01-03" in plan
    tables.merge_into(spark, name, source, ["snapshot_date", "id"], "snapshot_date")
    got = rows(tables.current(spark, name).where("v = 'new' or id = 3"), "id", "v")
    assert got == [(3, "old"), (99, "new")]


def test_a_stopped_upsert_can_be_repeated(spark, database, monkeypatch):
    name = f"{database}.moved"
    old = spark.createDataFrame([("a", 1, "2020-01"), ("b", 1, "2020-02"), ("c", 1, "2020-02")], "id string, v int, part_month string")
    tables.write_table(old, name, "part_month")
    new = spark.createDataFrame([("a", 2, "2020-03"), ("b", 2, "2020-03")], old.schema)

    def stop(*_):
        raise OSError("stopped")

    real = tables._overwrite_partitions
    monkeypatch.setattr(tables, "_overwrite_partitions", stop)
    with pytest.raises(OSError):
        tables.upsert(spark, name, new, ["id"], "part_month")
    monkeypatch.setattr(tables, "_overwrite_partitions", real)
    tables.upsert(spark, name, new, ["id"], "part_month")
    assert rows(tables.current(spark, name), "id", "v", "part_month") == [
        ("a", 2, "2020-03"), ("b", 2, "2020-03"), ("c", 1, "2020-02")
    ]


def test_incremental_counts_take_in_rows_on_both_sides(spark, database):
    name = f"{database}.counted"
    source = spark.createDataFrame([("a", D(2020, 1, 1)), ("a", D(2020, 2, 1)), ("b", D(2020, 2, 1))], "id string, day date")

    def build(df):
        n = df.groupBy("id").agg(F.count("*").alias("n"))
        return df.join(n, "id").withColumn("part_month", tables.month_of("day"))

    for part in (source.where("day < '2020-02-01'"), source):
        tables.run_incremental(spark, name, part, build, ["id"], "day", "part_month")
    assert rows(tables.current(spark, name), "id", "n") == [("a", 2), ("b", 1)]


# --- raw objects of the registered queries -----------------------------------------------------------


class _Source:
    """What the writers of raw objects use of the source tables."""

    def __init__(self, spark, root, archive=None, popular=None):
        self.spark, self.root, self.archive, self.popular = spark, root, archive, popular

    def once(self, name, folder, write):
        write()
        return folder


def test_raw_objects_hold_a_bounded_number_of_docs(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(loads, "OBJECT_DOCS", 20)
    days = [f"2001-0{1 + (i % 10 == 0)}-05" if i < 390 else None for i in range(400)]
    archive = spark.createDataFrame([(f"a{i}", i, d) for i, d in enumerate(days, 1)], "article_id string, word_count int, pub_date string")
    archive = archive.withColumn("pub_date", archive.pub_date.cast("date"))
    months = loads._raw_months(_Source(spark, f"{tmp_path}/m", archive=archive))
    most = max(len(json.loads(f.read_text())["response"]["docs"]) for f in Path(months).rglob("*.txt"))
    assert 10 < most < 60
    got = {(r._id, r.year, r.month) for r in records.raw_archive(spark, months).collect()}
    assert {g for g in got if g[1] == 2001} == {(f"a{i}", 2001, int(d[6])) for i, d in enumerate(days, 1) if d and i % 101}
    assert len(got) == sum(1 for i in range(1, 401) if i % 101)

    popular = spark.createDataFrame([(i, i, "2024-01-02") for i in range(300)], "id long, asset_id long, snapshot_date string")
    popular = popular.withColumn("snapshot_date", popular.snapshot_date.cast("date"))
    folder = loads._raw_days(_Source(spark, f"{tmp_path}/d", popular=popular))
    found = [json.loads(f.read_text()) for f in Path(folder).rglob("*.txt")]
    assert max(len(x["results"]) for x in found) < 60 and all(x["num_results"] == len(x["results"]) for x in found)
    assert sorted(int(r.id) for r in records.raw_popular(spark, folder).collect()) == list(range(300))


def _nulls_but(spark, schema, rows):
    """Rows of ``schema`` with the given fields and nulls elsewhere."""
    from pyspark.sql.types import StructType

    schema = StructType([f.__class__(f.name, f.dataType, True) for f in schema.fields])
    return spark.createDataFrame([{f.name: r.get(f.name) for f in schema.fields} for r in rows], schema)


def test_raw_landing_is_compressed_and_reads_back(spark, tmp_path):
    from newsmart.sources import views

    shape = views.archive_articles(spark, "/root/testdata/sf0.001").schema
    archive = _nulls_but(spark, shape, [{"article_id": f"a{i}", "pub_date": D(2001, 1 + i % 2, 5), "word_count": i} for i in range(1, 301)])
    folder = loads._raw_archive(_Source(spark, f"{tmp_path}/a", archive=archive))
    written = [f for f in Path(folder).rglob("part-*") if not f.name.endswith(".crc")]
    assert written and all(f.name.endswith(".gz") for f in written)
    got = {(r._id, r.year, r.month) for r in records.raw_archive(spark, folder, multiline=False).where("_id IS NOT NULL").collect()}
    assert got == {(f"a{i}", 2001, 1 + i % 2) for i in range(1, 301) if i % 101 and i % 53}

    shape = views.popular_articles(spark, "/root/testdata/sf0.001").schema
    popular = _nulls_but(spark, shape, [{"id": i, "asset_id": i, "snapshot_date": D(2024, 1, 2)} for i in range(1, 101)])
    folder = loads._raw_popular(_Source(spark, f"{tmp_path}/p", popular=popular))
    written = [f for f in Path(folder).rglob("part-*") if not f.name.endswith(".crc")]
    assert written and all(f.name.endswith(".gz") for f in written)
    assert sorted(int(r.id) for r in records.raw_popular(spark, folder, multiline=False).collect()) == list(range(1, 101))


def test_slim_landing_is_compressed_and_listed_as_feed_files(spark, tmp_path):
    from newsmart.sources import views

    shape = views.archive_articles(spark, "/root/testdata/sf0.001").schema
    archive = _nulls_but(spark, shape, [{"article_id": f"a{i}", "uri": f"u{i}", "pub_date": D(2001, 1 + i % 2, 5), "word_count": i} for i in range(1, 301)])
    shape = views.popular_articles(spark, "/root/testdata/sf0.001").schema
    popular = _nulls_but(spark, shape, [{"id": i, "asset_id": i, "snapshot_date": D(2024, 1, 2)} for i in range(1, 101)])
    p = _Source(spark, str(tmp_path), archive=archive, popular=popular)
    landing = loads._landing(p)
    written = [f for feed in (ARCHIVE_SLIM, POPULAR_SLIM) for f in Path(landing, feed).rglob("part-*") if not f.name.endswith(".crc")]
    assert written and all(f.name.endswith(".json.gz") for f in written)
    plain = f"{tmp_path}/plain/{ARCHIVE_SLIM}"
    slim.transform_archive(spark, f"{tmp_path}/landing/archive_raw", plain, multiline=False)
    got = sorted(repr(r) for r in records.slim_archive(spark, f"{landing}/{ARCHIVE_SLIM}").drop("file_path").collect())
    assert len(got) > 200 and got == sorted(repr(r) for r in records.slim_archive(spark, plain).drop("file_path").collect())
    none = spark.createDataFrame([], "source string, path string")
    status = files.file_status(files.route(files.list_files(spark, landing), landing), none)
    assert status.where("status = 'pending'").count() == len(written)
    assert {(r.feed, r.year, r.month) for r in status.where(F.col("feed") == ARCHIVE_SLIM).select(
        "feed", files.path_year(F.col("path")).alias("year"), files.path_month(F.col("path")).alias("month")
    ).collect()} == {(ARCHIVE_SLIM, 2001, 1), (ARCHIVE_SLIM, 2001, 2)}


def test_streamed_popular_writes_only_its_feed(spark, tmp_path):
    """The popularity stream needs no archive landing: with events alone it loads every snapshot row."""
    import pandas as pd

    from newsmart.registry.press import Press

    events = pd.DataFrame(
        {
            "event_id": [1, 2, 3, 4],
            "ts": pd.to_datetime(["2024-01-02 10:00", "2024-01-02 11:00", "2024-01-03 09:00", "2024-01-03 09:30"]),
            "user_id": [10, 10, 11, 12],
            "event_type": ["view", "click", "view", "view"],
            "value": [1.0, 2.0, 3.0, 4.0],
            "props": ['{"k": 1}', '{"k": 2}', '{"k": 3}', None],
        }
    )
    tables_dir = tmp_path / "tables"
    tables_dir.mkdir()
    events.to_parquet(tables_dir / "events.parquet", coerce_timestamps="us")
    p = Press(spark, str(tables_dir))
    out = loads.MODELS["s9_streamed_popular"](p)
    assert sorted((str(r.snapshot_date), r.id) for r in out.select("snapshot_date", "id").collect()) == [
        ("2024-01-02", 10), ("2024-01-03", 11), ("2024-01-03", 12)
    ]
    assert not Path(f"{p.root}/landing/slim/{ARCHIVE_SLIM}").exists()
