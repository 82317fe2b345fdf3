"""Batches taken once, key indexes, stepwise listing, kept results, interleaved clusters."""

import datetime as dt
import os
import random
import re
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_loads import article, database, put_archive, put_popular, targets  # noqa: F401

from newsmart.operators import keys, ledger, load, slim, tables
from newsmart.operators.keys import KeyIndex
from newsmart.operators.ledger import LOAD_ID, Ledger, merge_batch
from newsmart.operators.results import ResultStore
from newsmart.operators.shaping import REASON
from newsmart.plans import dashboard
from newsmart.sources import files, records
from newsmart.sources.files import ARCHIVE_SLIM, POPULAR_SLIM
from newsmart.sources.listing import Listing, glob_of

D = dt.date
TABLE = "article_id string, n int, load_id string, part_month string"
SOURCE = "article_id string, n int, part_month string"


@pytest.fixture
def merged(spark, database):  # noqa: F811
    name = f"{database}.merged"
    tables.write_table(spark.createDataFrame([], TABLE), name, "part_month")
    return name


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def listed(spark, name):
    return rows(tables.current(spark, name), "article_id", "n", "part_month")


# --- batches -------------------------------------------------------------------------------------


@pytest.mark.parametrize("indexed", [False, True])
def test_a_batch_is_taken_once(spark, merged, indexed):
    index = KeyIndex(spark, merged, "article_id") if indexed else None
    one = spark.createDataFrame([("a", 1, "2020-01"), (None, 1, "2020-01"), ("b", 1, None), ("b", 2, "2020-03")], SOURCE)
    two = spark.createDataFrame([("a", 9, "2020-02"), ("c", 9, "2020-02"), (None, 9, None)], SOURCE)
    assert merge_batch(spark, merged, one, ["article_id"], "part_month", "1", index=index)
    assert not merge_batch(spark, merged, one, ["article_id"], "part_month", "1", index=index)
    assert merge_batch(spark, merged, two, ["article_id"], "part_month", "2", index=index)
    # an id that is known in another month is not added; rows without a key always are
    assert listed(spark, merged) == sorted(
        [("a", 1, "2020-01"), (None, 1, "2020-01"), ("b", 1, None), ("b", 2, "2020-03"), ("c", 9, "2020-02"), (None, 9, None)], key=repr
    )


@pytest.mark.parametrize("place", ["during the append", "behind the append", "behind the keys"])
def test_a_stopped_batch_is_taken_back(spark, merged, monkeypatch, place):
    index = KeyIndex(spark, merged, "article_id")
    old = spark.createDataFrame([("a", 1, "2020-01"), (None, 1, None)], SOURCE)
    new = spark.createDataFrame([("b", 2, "2020-01"), (None, 2, None), ("c", 2, "2020-02"), ("a", 2, "2020-05")], SOURCE)
    merge_batch(spark, merged, old, ["article_id"], "part_month", "old", index=index)
    real = ledger.write_table, KeyIndex.add, Ledger.note

    def stop(*a, **k):
        raise OSError("stopped")

    def half(df, name, *a, **k):
        real[0](df.where("part_month = '2020-01'"), name, *a, **k)
        stop()

    def not_done(self, batch, attempt, state, *a, **k):
        return stop() if state == ledger.DONE else real[2](self, batch, attempt, state, *a, **k)

    if place == "during the append":
        monkeypatch.setattr(ledger, "write_table", half)
    elif place == "behind the append":
        monkeypatch.setattr(KeyIndex, "add", stop)
    else:
        monkeypatch.setattr(Ledger, "note", not_done)
    with pytest.raises(OSError, match="stopped"):
        merge_batch(spark, merged, new, ["article_id"], "part_month", "new", index=index)
    assert len(listed(spark, merged)) > 2
    monkeypatch.undo()
    merge_batch(spark, merged, new, ["article_id"], "part_month", "new", index=index)
    want = [("a", 1, "2020-01"), (None, 1, None), ("b", 2, "2020-01"), (None, 2, None), ("c", 2, "2020-02")]
    assert listed(spark, merged) == sorted(want, key=repr)
    # keys of the attempt that was taken back don't count
    again = spark.createDataFrame([("b", 3, "2020-09"), ("d", 3, "2020-09")], SOURCE)
    merge_batch(spark, merged, again, ["article_id"], "part_month", "again", index=index)
    assert listed(spark, merged) == sorted([*want, ("d", 3, "2020-09")], key=repr)


def _bare(df):
    return rows(df.drop(LOAD_ID), "*")


@pytest.mark.parametrize("place", ["behind the merge", "before the manifest"])
def test_a_stopped_load_goes_on(spark, tmp_path, targets, monkeypatch, place):  # noqa: F811
    root = tmp_path / "in"
    put_archive(root, "2020/05.ndjson", article("a"), article(None), article(None, "2020-07-01"))
    put_popular(root, "2026-02-19", {"id": 1}, {"title": "no id"})
    real = Ledger.note

    def not_done(self, batch, attempt, state, *a, **k):
        if state == ledger.DONE:
            raise OSError("stopped")
        return real(self, batch, attempt, state, *a, **k)

    def stop(*_):
        raise OSError("stopped")

    if place == "behind the merge":
        monkeypatch.setattr(Ledger, "note", not_done)
    else:
        monkeypatch.setattr(load, "_note", stop)
    with pytest.raises(load.BackfillError, match="stopped"):
        load.backfill(spark, targets)
    assert tables.current(spark, targets.archive).count() == 3
    assert tables.current(spark, targets.manifest).count() == 0
    monkeypatch.undo()
    for _ in range(2):
        load.backfill(spark, targets)
    assert rows(tables.current(spark, targets.archive), "article_id", "part_month") == [
        ("a", "2020-05"), (None, "2020-05"), (None, "2020-07")
    ]
    assert tables.current(spark, targets.popular).count() == 2
    assert rows(tables.current(spark, targets.manifest), "path") == [
        ("archive_slim/2020/05.ndjson",), ("most_popular_slim/2026-02-19/viewed_30.ndjson",)
    ]


def test_an_error_in_some_files_does_not_stop_the_others(spark, tmp_path, targets, monkeypatch):  # noqa: F811
    monkeypatch.setattr(load, "FILES_AT_ONCE", 1)
    for m in (5, 6, 7):
        put_archive(tmp_path / "in", f"2020/{m:02d}.ndjson", article(f"m{m}"))
    real = load.load_records

    def second_fails(spark, to, feed, slim_rows, listed):  # noqa: A002
        if "06" in listed.first()[0]:
            raise OSError("no such disk")
        real(spark, to, feed, slim_rows, listed)

    monkeypatch.setattr(load, "load_records", second_fails)
    with pytest.raises(load.BackfillError, match="no such disk") as failed:
        load.backfill(spark, targets)
    assert sorted(failed.value.counts) == [(ARCHIVE_SLIM, "error", 1), (ARCHIVE_SLIM, "loaded", 2)]


# --- keys ----------------------------------------------------------------------------------------


def test_bits_of_a_bitmap(spark):
    r = random.Random(3)
    marks = sorted({r.randrange(keys.BITS) for _ in range(300)} | {0, 7, 8, keys.BITS - 1})
    bits = spark.createDataFrame([(m,) for m in marks], "p long").agg(F.bitmap_construct_agg("p").alias("bits"))
    asked = spark.range(keys.BITS).select(F.col("id").alias("p")).crossJoin(bits)
    assert [r.p for r in asked.where(keys.has_bit("bits", F.col("p"))).orderBy("p").collect()] == marks


def _by_batches(spark, name, index, sets):
    for i, ids in enumerate(sets):
        source = spark.createDataFrame([(x, i, "2020-01") for x in ids], SOURCE)
        merge_batch(spark, name, source, ["article_id"], "part_month", str(i), index=index)


def _seen(sets):
    first = {}
    for i, ids in enumerate(sets):
        for x in ids:
            first.setdefault(x, i)
    return sorted(((x, i) for x, i in first.items()), key=repr)


@pytest.mark.parametrize("few", [3, 10_000])
def test_keys_move_to_the_old_ones_and_are_found(spark, merged, monkeypatch, few):
    monkeypatch.setattr(keys, "FEW", few)
    monkeypatch.setattr(keys, "RECENT_BATCHES", 2)
    monkeypatch.setattr(keys, "SLOT_KEYS", 3)  # soon too full: written anew with more slots
    r = random.Random(few)
    sets = [sorted({f"k{r.randrange(300)}" for _ in range(n)}) for n in (8, 8, 60, 60, 20)]
    index = KeyIndex(spark, merged, "article_id")
    _by_batches(spark, merged, index, sets)
    assert rows(tables.current(spark, merged), "article_id", "n") == _seen(sets)
    state = Ledger(spark, merged).key_state()
    assert state.old == 2 and state.recent == 3 and state.slots >= 64
    held = {r.tableName for r in spark.sql(f"SHOW TABLES IN {merged.split('.')[0]}").collect() if "key" in r.tableName}
    assert held == {"merged_keys_2", "merged_key_bits_2", "merged_recent_keys_3"}  # those replaced are gone


def test_a_merge_by_index_reads_neither_the_table_nor_other_buckets(spark, merged, monkeypatch):
    monkeypatch.setattr(keys, "RECENT_BATCHES", 1)
    index = KeyIndex(spark, merged, "article_id")
    _by_batches(spark, merged, index, [[f"k{i}" for i in range(500)]])
    source = spark.createDataFrame([("k7", 1, "2021-01"), ("new", 1, "2021-01")], SOURCE)
    state = Ledger(spark, merged).key_state()
    assert state.old == 1
    known = index.known(source, state)
    fresh = tables.without_keys(source, known, ["article_id"])
    assert rows(fresh, "article_id") == [("new",)]
    scans = re.findall(r"FileScan parquet [^\n]*", plan(fresh))
    assert scans and not [s for s in scans if re.search(r"\.merged\[", s)]
    old = [s for s in scans if "merged_keys_1" in s]
    assert old and "PartitionFilters: [" in old[0] and "bucket" in old[0].split("PartitionFilters: ")[1].split("]")[0]
    assert len(known.select("article_id").collect()) < 100  # of 500 in 32 buckets


def test_keys_moved_by_the_batch_itself_can_be_moved_again(spark, merged, monkeypatch):
    monkeypatch.setattr(keys, "RECENT_BATCHES", 1)  # the batch moves its keys, as a large one does
    index = KeyIndex(spark, merged, "article_id")
    _by_batches(spark, merged, index, [["a", "b"]])
    book = Ledger(spark, merged)
    ledger.note_index(book, index.flush(book.key_state()))  # no recent keys left: nothing moves
    state = Ledger(spark, merged).key_state()
    assert (state.old, state.recent) == (1, 2)
    source = spark.createDataFrame([("a", 5, "2020-02"), ("c", 5, "2020-02")], SOURCE)
    merge_batch(spark, merged, source, ["article_id"], "part_month", "next", index=index)
    assert rows(tables.current(spark, merged), "article_id", "n") == [("a", 0), ("b", 0), ("c", 5)]


def test_a_stopped_move_of_keys_can_be_repeated(spark, merged, monkeypatch):
    monkeypatch.setattr(keys, "RECENT_BATCHES", 1)
    index = KeyIndex(spark, merged, "article_id")
    real = ledger.note_index

    def stop(*_):
        raise OSError("stopped")

    monkeypatch.setattr(ledger, "note_index", stop)
    with pytest.raises(OSError, match="stopped"):
        _by_batches(spark, merged, index, [["a", "b"]])
    monkeypatch.setattr(ledger, "note_index", real)
    source = spark.createDataFrame([("a", 5, "2020-02"), ("c", 5, "2020-02")], SOURCE)
    merge_batch(spark, merged, source, ["article_id"], "part_month", "next", index=index)
    assert rows(tables.current(spark, merged), "article_id", "n") == [("a", 0), ("b", 0), ("c", 5)]


# --- incremental models --------------------------------------------------------------------------


def _counted(df):
    n = df.groupBy("id").agg(F.count("*").alias("n"), F.sum(F.size("words")).alias("words_of_id"))
    return df.join(n, "id").withColumn("part_month", tables.month_of("day")).drop("words", "month")


def _days(spark, data):
    df = spark.createDataFrame([(i, d, ["w"] * k) for i, d, k in data], "id string, day date, words array<string>")
    return df.withColumn("month", tables.month_of("day"))


@pytest.mark.parametrize("prune", [None, "month"])
def test_an_incremental_run_equals_a_full_refresh(spark, database, prune):  # noqa: F811
    r = random.Random(5)
    data = [(f"i{r.randrange(60)}", D(2020, 1 + k // 40, 1 + k % 28), k % 4) for k in range(200)] + [("i1", None, 2), ("i2", None, 1)]
    cut = D(2020, 4, 15)
    name, whole = f"{database}.step", f"{database}.whole"
    run = lambda t, s, **k: tables.run_incremental(spark, t, s, _counted, ["id", "day"], "day", "part_month", prune=prune, **k)
    run(name, _days(spark, [x for x in data if x[1] and x[1] <= cut]))
    run(name, _days(spark, data))
    run(whole, _days(spark, data), full_refresh=True)
    newer = lambda t: rows(tables.current(spark, t).where(F.col("day") > F.lit(cut)), "id", "day", "n", "words_of_id")
    by_id = {}
    for i, _, k in data:
        n, w = by_id.get(i, (0, 0))
        by_id[i] = n + 1, w + k
    key_counts = sorted({(i, d, *by_id[i]) for i, d, _ in data if d and d > cut})
    assert sorted(set(newer(whole))) == key_counts


def test_older_arrays_are_read_only_where_a_fresh_key_was_seen(spark, database):  # noqa: F811
    name = f"{database}.source"
    data = [(f"i{k}", D(2020, 1 + k % 6, 5), 3) for k in range(60)]
    tables.write_table(_days(spark, data), name, "month")
    tables.write_table(_days(spark, [("i1", D(2020, 9, 1), 1), ("new", D(2020, 9, 1), 1)]), name, "month", mode="append")
    source = tables.current(spark, name)
    ids = source.where("day > '2020-08-01'").select("id").distinct()
    found = tables.touched_by(spark, source, ids, ["id"], "day", D(2020, 8, 1), "month")
    assert rows(found, "id", "day") == [("i1", D(2020, 2, 5)), ("i1", D(2020, 9, 1)), ("new", D(2020, 9, 1))]
    older = [s for s in re.findall(r"FileScan parquet [^\n]*", plan(found)) if "words" in s and "month#" in s and "2020-02" in s]
    assert older and "PartitionFilters: [isnotnull(month" in older[0]
    none = tables.touched_by(spark, source, ids.where("id = 'new'"), ["id"], "day", D(2020, 8, 1), "month")
    assert plan(none).count("FileScan") == 1  # no older row is read


# --- interleaved clusters ------------------------------------------------------------------------


def _groups_read(spark, name, column, value):
    folder = spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'").first()["data_type"].removeprefix("file:")
    read = total = 0
    for path in Path(folder).rglob("*.parquet"):
        meta = pq.ParquetFile(path).metadata
        at = meta.schema.names.index(column)
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(at).statistics
            total += 1
            read += stats is None or not stats.has_min_max or stats.min <= value <= stats.max
    return read, total


def test_an_interleaved_order_skips_data_for_every_column(spark, database):  # noqa: F811
    r = random.Random(1)
    data = [(i, D(2020, 1, 1) + dt.timedelta(days=r.randrange(300)), f"s{r.randrange(40):02d}", r.randrange(1000)) for i in range(6000)]
    data += [(i, None, None, None) for i in range(6000, 6050)]
    df = spark.createDataFrame(data, "id long, day date, section string, words int")
    read = {}
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "100")
    try:
        for kind in (False, True):
            name = f"{database}.t{kind}"
            tables.write_table(df, name, cluster=["day", "section", "words"], key="id", interleave=kind)
            assert rows(tables.current(spark, name), "id", "day", "section", "words") == rows(df, "id", "day", "section", "words")
            asked = (("day", D(2020, 5, 5)), ("section", "s17"), ("words", 500))
            read[kind] = [n / total for n, total in (_groups_read(spark, name, c, v) for c, v in asked)]
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert min(read[False][1:]) > 0.8  # one lexical order helps the first column only
    assert max(read[True]) < 0.55
    empty = f"{database}.empty"
    tables.write_table(df.limit(0), empty, cluster=["day", "section"], key="id", interleave=True)
    assert tables.current(spark, empty).count() == 0


# --- kept results --------------------------------------------------------------------------------


def _files_below(folder):
    return [f for f in Path(folder).rglob("*") if f.is_file()]


def test_results_are_kept_for_an_hour(spark, tmp_path, database):  # noqa: F811
    source = f"{database}.numbers"
    tables.write_table(spark.range(10).toDF("n"), source)
    store = ResultStore(spark, f"{database}_results", str(tmp_path / "results"))
    made = []

    def ask(now, upto=5):
        def make():
            made.append(now)
            return tables.current(spark, source).where(F.col("n") < upto)

        found, kept = store.get("small", {"upto": upto}, [source], make, now)
        return rows(found, "n"), kept

    five = [(i,) for i in range(5)]
    assert ask(100.0) == (five, False)
    assert ask(3699.0) == (five, True)  # a hit
    assert ask(3699.0, 2) == ([(0,), (1,)], False)  # other arguments
    tables.write_table(spark.range(-1, 0).toDF("n"), source, mode="append")
    assert ask(3699.0) == ([(-1,), *five], False)  # a changed source
    assert ask(7299.0) == ([(-1,), *five], False)  # its hour is over
    assert ask(50.0)[1] is False  # made later than asked for: not from then
    assert made == [100.0, 3699.0, 3699.0, 7299.0, 50.0]
    assert len(store.purge(1e9)) == len(set(store.purge(1e9))) + 1 == 1
    assert store.tables() == [] and _files_below(tmp_path / "results") == []


def test_a_result_that_was_never_finished_is_made_anew(spark, tmp_path, database, monkeypatch):  # noqa: F811
    store = ResultStore(spark, f"{database}_results", str(tmp_path / "results"))
    folder = str(tmp_path / "no" / "such folder [x]")
    assert store.get("q", {}, [folder], lambda: spark.range(3), 10.0)[1] is False
    (table,) = store.tables()
    spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES ('newsmart.made_at')")
    found, kept = store.get("q", {}, [folder], lambda: spark.range(4), 20.0)
    assert (found.count(), kept) == (4, False)


def test_cached_breakdown_depends_on_the_filter(spark, tmp_path, database):  # noqa: F811
    fct = f"{database}.fct"
    data = [(str(i), D(2020, 1, 1 + i), "s" if i % 2 else "t", "d", "m", 5) for i in range(8)]
    names = "article_id string, pub_date date, section_name string, news_desk string, type_of_material string, word_count int"
    tables.write_table(spark.createDataFrame(data, names), fct)
    store = ResultStore(spark, f"{database}_results", str(tmp_path / "results"))
    ask = lambda chosen, now: dashboard.cached_breakdown(store, fct, lambda: None, chosen, D(2021, 1, 1), [], now)
    one, two = dashboard.ArticleFilter(sections=("s",)), dashboard.ArticleFilter(start=D(2020, 1, 5))
    assert [ask(f, 5.0)[1] for f in (one, two, one, two)] == [False, False, True, True]
    assert rows(ask(one, 6.0)[0].where("dimension = 'section_name'"), "member", "article_count") == [("s", 4)]


# --- stepwise listing ----------------------------------------------------------------------------


def test_closed_periods_are_not_listed_again(spark, tmp_path, targets, monkeypatch):  # noqa: F811
    root = tmp_path / "in"
    put_archive(root, "2020/01.ndjson", article("a"))
    put_archive(root, "2020/03.ndjson", article("b"))
    put_archive(root, "year=2020/month=5/part-0.json", article("c"))
    put_archive(root, "2020/06.ndjson", article("x", word_count="12x"))
    put_popular(root, "2020-07-01", {"id": 1})
    put_popular(root, "snapshot_date=2020-07-20", {"id": 2})
    put_popular(root, "undated", {"id": 3})
    asked = []
    real = files.list_files

    def watched(spark, folder, *more):
        asked.append(folder)
        return real(spark, folder, *more)

    monkeypatch.setattr(files, "list_files", watched)
    as_of = D(2020, 7, 21)
    first = load.backfill(spark, targets, strict=False, as_of=as_of)
    assert rows(first, "feed", "outcome", "files") == [
        (ARCHIVE_SLIM, "error", 1), (ARCHIVE_SLIM, "loaded", 3), (POPULAR_SLIM, "loaded", 2), (POPULAR_SLIM, "no snapshot date", 1)
    ]
    steps = Listing(spark, targets.database, targets.landing)
    assert rows(steps.closed(), "feed", "period") == [
        (ARCHIVE_SLIM, "2020-01"), (ARCHIVE_SLIM, "2020-03"), (ARCHIVE_SLIM, "2020-05"), (POPULAR_SLIM, "2020-07-01")
    ]
    assert steps.open_periods(ARCHIVE_SLIM, as_of) == ["2020-02", "2020-04", "2020-06", "2020-07"]
    # the second run looks at open folders only and finds a gap that was filled, and a new day
    put_archive(root, "2020/02.ndjson", article("d"))
    put_popular(root, "2020-07-22", {"id": 4})
    late = put_archive(root, "2020/03/more.ndjson", article("late"))
    asked.clear()
    second = load.backfill(spark, targets, strict=False, as_of=as_of)
    assert rows(second, "feed", "outcome", "files") == [
        (ARCHIVE_SLIM, "error", 1), (ARCHIVE_SLIM, "loaded", 1), (ARCHIVE_SLIM, "skipped", 3), (POPULAR_SLIM, "loaded", 1),
        (POPULAR_SLIM, "skipped", 2),
    ]
    months, days = (a.split("/in/")[1] for a in asked)
    assert "03" not in months and "{2020,year=2020}/{02,02.*" in months
    assert "2020-07-01" not in days and "2020-07-02" in days
    assert rows(tables.current(spark, targets.archive), "article_id") == [("a",), ("b",), ("c",), ("d",)]
    # a late file in a closed month is found by a sweep, and only once
    assert steps.sweep() == [(ARCHIVE_SLIM, "2020-03")]
    load.backfill(spark, targets, strict=False, as_of=as_of)
    assert ("late",) in rows(tables.current(spark, targets.archive), "article_id")
    assert steps.sweep() == []
    assert "2020-03" not in steps.open_periods(ARCHIVE_SLIM, as_of)  # closed again
    os.utime(late, (2e9, 2e9))
    assert steps.sweep() == [(ARCHIVE_SLIM, "2020-03")]  # a changed file


def test_globs_of_periods(spark, tmp_path):
    odd = tmp_path / "in [a]{b}*"
    for name in ("2019/12.ndjson", "2020/1.ndjson", "2020/02/x.json", "year=2020/month=3/y.json", "2020/11.ndjson", "2021/01.ndjson"):
        put_archive(odd, name, {})
    found = files.list_or_none(spark, glob_of(str(odd), ARCHIVE_SLIM, ["2020-01", "2020-02", "2020-03", "2021-01"]))
    names = sorted("/".join(r.path.split("/")[-2:]) for r in found.collect())
    assert names == ["02/x.json", "2020/1.ndjson", "2021/01.ndjson", "month=3/y.json"]
    assert files.list_or_none(spark, glob_of(str(odd), POPULAR_SLIM, ["2020-01-01"])).count() == 0


# --- slim files ----------------------------------------------------------------------------------


def test_rejected_records_are_kept_and_each_step_is_noted(spark, tmp_path, monkeypatch):
    from test_loads import put_raw

    raw, out = str(tmp_path / "archive_raw"), str(tmp_path / "slim")
    for m in (1, 2, 3):
        put_raw(tmp_path, f"2020/0{m}.json", {"_id": f"a{m}"}, {"_id": f"b{m}", "word_count": "x"})
    monkeypatch.setattr(slim, "FILES_AT_ONCE", 1)
    real, calls = slim.write_slim, []

    def stops(*args):
        if len(calls) == 2:
            raise OSError("stopped")
        calls.append(1)
        return real(*args)

    monkeypatch.setattr(slim, "write_slim", stops)
    with pytest.raises(OSError, match="stopped"):
        slim.transform_archive(spark, raw, out)
    monkeypatch.setattr(slim, "write_slim", real)
    # two months are done, so only the third is worked off again
    rejected = slim.transform_archive(spark, raw, out)
    assert rows(rejected, "article_id", REASON, "month") == [("b3", "word_count is not an integer", 3)]
    assert rows(records.slim_archive(spark, out), "article_id") == [("a1",), ("a2",), ("a3",)]
    kept = spark.read.option("recursiveFileLookup", "true").parquet(slim.rejected_folder(out))
    assert {r.article_id for r in kept.collect()} == {"b1", "b2", "b3"}
