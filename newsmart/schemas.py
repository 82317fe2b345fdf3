"""Explicit schemas, as DDL text, for every stage: raw JSON, slim JSON lines, tables, manifest."""

from __future__ import annotations

from pyspark.sql.types import StructType

KEYWORD = "struct<name:string,value:string,rank:bigint,major:string>"
KEYWORDS = f"array<{KEYWORD}>"
PERSON = "struct<firstname:string,lastname:string,middlename:string,qualifier:string>"
PERSONS = f"array<{PERSON}>"
COUNTS = "map<string,bigint>"
TEXTS = "array<string>"

# Integers arrive as text so that record validation can tell a bad value from a missing one.
KEYWORDS_TEXT = "array<struct<name:string,value:string,rank:string,major:string>>"
MEDIA = "array<struct<type:string>>"

CORRUPT = "_corrupt_record"

Fields = dict[str, str]

RAW_ARTICLE: Fields = {
    "_id": "string",
    "uri": "string",
    "pub_date": "string",
    "section_name": "string",
    "news_desk": "string",
    "type_of_material": "string",
    "document_type": "string",
    "word_count": "string",
    "web_url": "string",
    "headline": "struct<main:string>",
    "byline": f"struct<original:string,person:{PERSONS}>",
    "abstract": "string",
    "snippet": "string",
    "keywords": KEYWORDS_TEXT,
    "multimedia": MEDIA,
}

RAW_POPULAR: Fields = {
    "id": "string",
    "uri": "string",
    "url": "string",
    "asset_id": "string",
    "source": "string",
    "published_date": "string",
    "updated": "string",
    "section": "string",
    "subsection": "string",
    "byline": "string",
    "type": "string",
    "title": "string",
    "abstract": "string",
    "des_facet": TEXTS,
    "org_facet": TEXTS,
    "per_facet": TEXTS,
    "geo_facet": TEXTS,
    "media": MEDIA,
    "adx_keywords": "string",
}

ARCHIVE_ARTICLES: Fields = {
    "article_id": "string",
    "uri": "string",
    "pub_date": "date",
    "section_name": "string",
    "news_desk": "string",
    "type_of_material": "string",
    "document_type": "string",
    "word_count": "bigint",
    "web_url": "string",
    "headline_main": "string",
    "byline_original": "string",
    "abstract": "string",
    "snippet": "string",
    "keywords": KEYWORDS,
    "byline_person": PERSONS,
    "multimedia_count_by_type": COUNTS,
}

POPULAR_ARTICLES: Fields = {
    "snapshot_date": "date",
    "id": "bigint",
    "uri": "string",
    "url": "string",
    "asset_id": "bigint",
    "source": "string",
    "published_date": "string",
    "updated": "string",
    "section": "string",
    "subsection": "string",
    "byline": "string",
    "type": "string",
    "title": "string",
    "abstract": "string",
    "des_facet": TEXTS,
    "org_facet": TEXTS,
    "per_facet": TEXTS,
    "geo_facet": TEXTS,
    "media_count_by_type": COUNTS,
    "adx_keywords": "string",
}

LOAD_MANIFEST: Fields = {"source": "string", "path": "string", "loaded_at": "timestamp"}

# Files that were not taken, with the reason.
REFUSED_FILES: Fields = {
    "source": "string", "path": "string", "reason": "string", "refused_at": "timestamp"
}

# Slim records as read: the table columns with dates and integers still as text.
SLIM_ARCHIVE: Fields = {
    **ARCHIVE_ARTICLES, "pub_date": "string", "word_count": "string", "keywords": KEYWORDS_TEXT
}
SLIM_POPULAR: Fields = {
    name: "string" if kind == "bigint" else kind
    for name, kind in POPULAR_ARTICLES.items()
    if name != "snapshot_date"
}


def ddl(fields: Fields) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in fields.items())


def nested(fields: Fields) -> str:
    return "struct<" + ",".join(f"{name}:{kind}" for name, kind in fields.items()) + ">"


def struct_type(fields: Fields) -> StructType:
    """The schema as an object; needs a running session."""
    return StructType.fromDDL(ddl(fields))


RAW_ARCHIVE_FILE: Fields = {
    "response": f"struct<docs:array<{nested(RAW_ARTICLE)}>>", CORRUPT: "string"
}
RAW_POPULAR_FILE: Fields = {"results": f"array<{nested(RAW_POPULAR)}>", CORRUPT: "string"}
SLIM_ARCHIVE_FILE: Fields = {**SLIM_ARCHIVE, CORRUPT: "string"}
SLIM_POPULAR_FILE: Fields = {**SLIM_POPULAR, CORRUPT: "string"}
