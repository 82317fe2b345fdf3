import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from newsmart import schemas  # noqa: E402
from newsmart.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=str(shared),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """DataFrame from dicts; fields that a row leaves out are null."""

    def make(fields, rows):
        names = list(fields)
        data = [tuple(row.get(n) for n in names) for row in rows]
        return spark.createDataFrame(data, schemas.struct_type(fields))

    return make


@pytest.fixture
def articles(frame):
    """Rows of the loaded archive table; arrays default to empty, as the loader leaves them."""

    def make(*rows):
        filled = [{"keywords": [], "byline_person": [], **row} for row in rows]
        return frame(schemas.ARCHIVE_ARTICLES, filled)

    return make


@pytest.fixture
def popular(frame):
    def make(*rows):
        facets = {f: [] for f in ("des_facet", "org_facet", "per_facet", "geo_facet")}
        return frame(schemas.POPULAR_ARTICLES, [{**facets, **row} for row in rows])

    return make


def keyword(value, name="subject", rank=1, major="N"):
    return {"name": name, "value": value, "rank": rank, "major": major}


def person(first=None, last=None, middle=None, qualifier=None):
    return {"firstname": first, "lastname": last, "middlename": middle, "qualifier": qualifier}


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
