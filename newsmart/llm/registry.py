"""Registered queries of this subpackage, over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from newsmart.llm import (
    bpe, decontam, hard_negatives, langid, licenses, line_runs, near_dup, pii, quality, resample, suffix_repeats, toxicity, warc,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_repeats.repeat_digests(_table(spark, sf_dir, "documents"))


def op2_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonyms(_table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.languages(_table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_runs.line_dedup(_table(spark, sf_dir, "documents"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licenses(_table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(_table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.decontamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(_table(spark, sf_dir, "embeddings"))


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.importance(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(_table(spark, sf_dir, "pages"))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    chosen = (
        op1_repeated_strings, op2_private_data, op3_language_id, op4_line_dedup, op5_bpe, op6_licenses, op7_toxicity, op8_quality_rules,
        op9_near_duplicates, op10_decontamination, op11_hard_negatives, op12_importance, op13_warc,
    )
    return {f.__name__: f for f in chosen}


#: Words of a text as decontamination has them, and its windows of ten words (fewer words: one window).
_ITEM_WORDS = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i : i + 9], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM item WHERE len(w) > 0)),
size AS (SELECT DISTINCT k FROM win),
place AS (
  SELECT doc_id, k, i, array_to_string(w[i : i + k - 1], ' ') AS s
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM doc, size WHERE len(w) >= k)),
hit AS (SELECT doc_id, item_id, p.i, p.k FROM place p JOIN win USING (k, s)),
word AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM hit) GROUP BY doc_id),
ids AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id)
"""


_LINE_KEYS = r"""
WITH line AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
  FROM documents),
keyed AS (
  SELECT doc_id, i, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM line),
often AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5)
"""


_NEAR = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) >= 3 THEN w[i : i + 2] ELSE w END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM doc WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (
  SELECT a, b FROM common JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT a AS doc_id, a AS root FROM edge UNION SELECT edge.b, reach.root FROM reach JOIN edge ON edge.a = reach.doc_id),
least AS (SELECT doc_id, min(root) AS root FROM reach GROUP BY doc_id)
"""


_IMPORTANCE = r"""
WITH poly AS (
  SELECT list_transform(range(0, 256), lambda i: list_reduce([CAST(i AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS tab),
doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark),
word AS (SELECT doc_id, unnest(w) AS word FROM doc),
known AS (SELECT word FROM word UNION SELECT word FROM item),
crc AS (
  SELECT word, xor(list_reduce(list_concat([4294967295], list_transform(range(0, octet_length(encode(word))),
    lambda i: CAST('0x' || substr(hex(encode(word)), 2 * i + 1, 2) AS BIGINT))),
    lambda c, b: xor(c // 256, tab[1 + xor(c % 256, b)])), 4294967295) % 10000 AS bucket FROM known, poly),
have AS (SELECT bucket, count(*) AS s FROM word JOIN crc USING (word) GROUP BY bucket),
want AS (SELECT bucket, count(*) AS t FROM item JOIN crc USING (word) GROUP BY bucket),
size AS (SELECT (SELECT count(*) FROM word) AS s_all, (SELECT count(*) FROM item) AS t_all),
gain AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * (s_all + 10000) / ((s + 1.0::DOUBLE) * (t_all + 10000)))) AS gain
  FROM have LEFT JOIN want USING (bucket), size),
weight AS (
  SELECT doc_id, count(*) AS n, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight
  FROM word JOIN crc USING (word) JOIN gain USING (bucket) GROUP BY doc_id),
scored AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) + 0.5::DOUBLE)
      / 4294967296.0::DOUBLE))) AS BIGINT) AS score
  FROM doc LEFT JOIN weight USING (doc_id)),
place AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
"""


_NEGATIVES = r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pair AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
pos AS (SELECT * FROM pair WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
neg AS (
  SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) AS rank
  FROM pos p JOIN pair n ON p.anchor_id = n.anchor_id AND NOT n.same
    AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score)
"""


_CAPTURES = r"""
WITH page AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
first AS (SELECT payload_digest, min(page_id) AS first_id FROM page WHERE payload_bytes >= 100 GROUP BY payload_digest)
"""


def llm_sql() -> dict[str, str]:
    return {
        "op11_hard_negatives": _NEGATIVES
        + """SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM neg WHERE rank <= 3""",
        "op12_importance": _IMPORTANCE
        + """SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank FROM scored LEFT JOIN place USING (doc_id)""",
        "op13_warc": _CAPTURES
        + """SELECT page_id, payload_bytes, payload_digest, CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM page LEFT JOIN first USING (payload_digest)""",
        "op9_near_duplicates": _NEAR
        + """SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, coalesce(root, doc_id) AS component_id, coalesce(root, doc_id) = doc_id AS kept
FROM doc LEFT JOIN size USING (doc_id) LEFT JOIN least USING (doc_id)""",
        "op4_line_dedup": _LINE_KEYS
        + """SELECT doc_id, count(*) AS n_lines, count(*) FILTER (keeper IS NOT NULL AND doc_id < keeper) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (keeper IS NULL OR doc_id >= keeper), '')) AS kept_sha256
FROM keyed LEFT JOIN often USING (k) GROUP BY doc_id""",
        "op10_decontamination": _ITEM_WORDS
        + """SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN word USING (doc_id) LEFT JOIN ids USING (doc_id)""",
    }
