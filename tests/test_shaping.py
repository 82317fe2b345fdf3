"""Record shaping: the unit cases of the raw-to-slim step, coercion and rejects."""

import json

import pytest
from pyspark.sql import functions as F

from newsmart import schemas
from newsmart.functions.exprs import coerce_long, not_integer
from newsmart.operators import shaping
from newsmart.sources import records


def _media(spark, items):
    df = spark.createDataFrame([(items,)], f"m {schemas.MEDIA}")
    return df.select(shaping.counts_by_type(F.col("m"))).first()[0]


@pytest.mark.parametrize("items", [[], None])
def test_no_media_is_null(spark, items):
    assert _media(spark, items) is None


def test_media_without_usable_type_is_null(spark):
    assert _media(spark, [{"type": None}, {"type": ""}]) is None


def test_media_counts(spark):
    kinds = ["slideshow", None, "audio", "slideshow", "", "slideshow", "chart", None]
    assert _media(spark, [{"type": k} for k in kinds]) == {"slideshow": 3, "audio": 1, "chart": 1}


def _raw(spark, tmp_path, docs, name="2020/05.json"):
    path = tmp_path / "archive_raw" / name
    path.parent.mkdir(parents=True)
    path.write_text(json.dumps({"response": {"docs": docs}}, indent=1))
    return records.raw_archive(spark, str(tmp_path / "archive_raw"))


def test_empty_doc(spark, tmp_path):
    row = shaping.slim_articles(_raw(spark, tmp_path, [{}])).first()
    assert [row[c] for c in ("article_id", "uri", "headline_main", "word_count")] == [None] * 4
    assert row["keywords"] == [] and row["byline_person"] == []
    assert row["multimedia_count_by_type"] is None


def test_nested_headline_and_byline(spark, tmp_path):
    people = [
        {"firstname": "Ada", "middlename": "K.", "lastname": "Quill", "qualifier": "Jr."},
        {"lastname": "Moss"},
        {"firstname": "Ines"},
    ]
    doc = {
        "_id": "press://9/x",
        "headline": {"main": "Ferry back after storm", "kicker": "Harbour"},
        "byline": {"original": "By Ada K. Quill Jr., Moss and Ines", "person": people},
        "multimedia": [{"type": "audio"}, {"type": "chart", "url": "c.svg"}, {"type": "audio"}],
    }
    docs = _raw(spark, tmp_path, [{"_id": "other"}, doc])
    row = shaping.slim_articles(docs).where("article_id = 'press://9/x'").first()
    assert row["headline_main"] == "Ferry back after storm"
    assert row["byline_original"].startswith("By Ada")
    assert [tuple(p) for p in row["byline_person"]] == [
        ("Ada", "Quill", "K.", "Jr."), (None, "Moss", None, None), ("Ines", None, None, None)
    ]
    assert row["multimedia_count_by_type"] == {"audio": 2, "chart": 1}
    assert {(r["year"], r["month"]) for r in docs.collect()} == {(2020, 5)}


def test_null_structs_and_lists(spark, tmp_path):
    doc = {"_id": "a", "headline": None, "byline": {"person": None}, "keywords": None}
    row = shaping.slim_articles(_raw(spark, tmp_path, [doc])).first()
    assert row["headline_main"] is None
    assert row["keywords"] == [] and row["byline_person"] == []


def test_valid_article(spark, tmp_path):
    doc = {
        "_id": "n-77",
        "pub_date": "1987-11-30T23:10:00+0000",
        "section_name": "Harbour",
        "word_count": 1312,
        "byline": {},
        "keywords": [
            {"name": "place", "value": "Pier 4", "rank": 2, "major": "Y", "weight": "dropped"},
            {"value": "Tides", "rank": 1},
        ],
    }
    checked = shaping.checked_articles(shaping.slim_articles(_raw(spark, tmp_path, [doc])))
    row = shaping.archive_rows(shaping.accepted_articles(checked)).first()
    assert (row["article_id"], row["word_count"], str(row["pub_date"])) == ("n-77", 1312, "1987-11-30")
    assert [tuple(k) for k in row["keywords"]] == [("place", "Pier 4", 2, "Y"), (None, "Tides", 1, None)]


@pytest.mark.parametrize("text", ['{"response": {"docs": []}}', '{"response": {}}', "{}"])
def test_missing_docs_give_no_rows(spark, tmp_path, text):
    (tmp_path / "2020").mkdir()
    (tmp_path / "2020" / "01.json").write_text(text)
    assert records.raw_archive(spark, str(tmp_path)).count() == 0


def test_broken_file_is_rejected_not_lost(spark, tmp_path):
    (tmp_path / "2020").mkdir()
    (tmp_path / "2020" / "01.json").write_text('{"response": {"docs": [{"_id": ')
    (tmp_path / "2020" / "02.json").write_text('{"response": {"docs": [{"_id": "ok"}]}}')
    checked = shaping.checked_articles(
        shaping.slim_articles(records.raw_archive(spark, str(tmp_path)))
    )
    bad = shaping.rejected(checked).collect()
    assert [r["reject_reason"] for r in bad] == ["malformed json"]
    assert bad[0]["file_path"].endswith("01.json")
    assert [r["article_id"] for r in shaping.accepted_articles(checked).collect()] == ["ok"]


def test_bad_integers_are_rejected(spark, tmp_path):
    docs = [
        {"_id": "text", "word_count": "12x"},
        {"_id": "half", "word_count": 12.5},
        {"_id": "spelled", "word_count": "12"},
        {"_id": "whole", "word_count": 12.0},
        {"_id": "none", "word_count": None},
        {"_id": "rank", "keywords": [{"rank": 1}, {"rank": "first"}]},
    ]
    checked = shaping.checked_articles(shaping.slim_articles(_raw(spark, tmp_path, docs)))
    assert {r["article_id"]: r["reject_reason"] for r in shaping.rejected(checked).collect()} == {
        "text": "word_count is not an integer",
        "half": "word_count is not an integer",
        "rank": "keyword rank is not an integer",
    }
    good = shaping.accepted_articles(checked).collect()
    assert {r["article_id"]: r["word_count"] for r in good} == {
        "spelled": 12, "whole": 12, "none": None
    }
    per_file = shaping.reject_counts(checked).first()
    assert (per_file["records"], per_file["rejected"]) == (6, 3)


@pytest.mark.parametrize(
    ("text", "value", "bad"),
    [
        ("7", 7, False),
        (" 7 ", 7, False),
        ("-7", -7, False),
        ("7.000", 7, False),
        ("1e3", 1000, False),
        ("+7", 7, False),
        ("15e-1", None, True),
        ("1.5e1", 15, False),
        ("1e-11", None, True),
        ("12.00000000001", None, True),
        ("12.0000000000000000000000000000000000000000000001", None, True),
        ("7.5", None, True),
        ("seven", None, True),
        ("", None, True),
        ("99999999999999999999", None, True),
        (None, None, False),
    ],
)
def test_integer_coercion(spark, text, value, bad):
    df = spark.createDataFrame([(text,)], "t string")
    assert tuple(df.select(coerce_long(F.col("t")), not_integer(F.col("t"))).first()) == (value, bad)


def _raw_popular(spark, tmp_path, results):
    path = tmp_path / "most_popular_raw" / "2026-02-19" / "viewed_30.json"
    path.parent.mkdir(parents=True)
    path.write_text(json.dumps({"results": results, "num_results": len(results)}))
    return records.raw_popular(spark, str(tmp_path / "most_popular_raw"))


def test_empty_popular_doc(spark, tmp_path):
    row = shaping.slim_popular(_raw_popular(spark, tmp_path, [{}])).first()
    assert row["id"] is None and row["title"] is None
    assert row["des_facet"] == [] and row["media_count_by_type"] is None


def test_full_popular_doc(spark, tmp_path):
    doc = {
        "id": 4071,
        "title": "Night market returns",
        "section": "Food",
        "media": [{"type": "audio"}, {}, {"type": "chart"}, {"type": "audio"}],
        "des_facet": ["Markets"],
        "org_facet": ["Stall Owners Guild", "Port Authority"],
        "per_facet": ["Quill, Ada"],
        "geo_facet": ["Pier 4", "Old Town", "Ferry Hill"],
    }
    docs = _raw_popular(spark, tmp_path, [doc])
    checked = shaping.checked_popular(shaping.slim_popular(docs))
    row = shaping.popular_rows(shaping.accepted_popular(checked)).first()
    assert (row["id"], row["title"], row["section"]) == (4071, "Night market returns", "Food")
    assert row["media_count_by_type"] == {"audio": 2, "chart": 1}
    for facet in ("des_facet", "org_facet", "per_facet", "geo_facet"):
        assert row[facet] == doc[facet]
    assert str(row["snapshot_date"]) == "2026-02-19"


def test_bad_popular_ids_are_rejected(spark, tmp_path):
    docs = [{"id": "x"}, {"id": 1, "asset_id": "y"}, {"id": "2"}]
    checked = shaping.checked_popular(shaping.slim_popular(_raw_popular(spark, tmp_path, docs)))
    reasons = sorted(r["reject_reason"] for r in shaping.rejected(checked).collect())
    assert reasons == ["asset_id is not an integer", "id is not an integer"]
    assert [r["id"] for r in shaping.accepted_popular(checked).collect()] == [2]


@pytest.mark.parametrize(
    ("text", "day"),
    [
        ("2020-05-06T04:00:00+0000", "2020-05-06"),
        ("2020-05-06", "2020-05-06"),
        ("2020-13-01", None),
        ("soon", None),
        (None, None),
    ],
)
def test_publication_day(spark, text, day):
    from newsmart.functions.exprs import parse_day

    found = spark.createDataFrame([(text,)], "t string").select(parse_day(F.col("t"))).first()[0]
    assert (str(found) if found else None) == day
