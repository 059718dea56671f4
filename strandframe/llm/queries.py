"""The queries of this subpackage: each applies an operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, bag_search, bpe, exact_dedup, language_id, language_model, media, neighbours, packing, quality, sharding, simhash, url_filter
from .common import load

#: The URL rules of op1: host, path, action.
URL_RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]
SHARDS = [f"shard-{i:02d}" for i in range(32)]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = ", ".join(f"('{h}', '{p}', '{a}')" for h, p, a in URL_RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {values} AS t(host, path, action)")
    pages = load(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(load(spark, sf_dir, "embeddings"))


def op3_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_features(load(spark, sf_dir, "documents")).drop("pair_times", "pair_hashes")


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    dictionaries = language_id.train_dictionaries(docs.where(language_id.is_training(F.col("doc_id"))))
    found = language_id.identify(docs, dictionaries)
    return found.select("doc_id", (~language_id.is_training(F.col("doc_id"))).alias("held_out"), "lang_pred", "score", "rejected")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(load(spark, sf_dir, "documents").select("doc_id"), "doc_id", SHARDS).select("doc_id", "slot", "shard")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(load(spark, sf_dir, "documents")).drop("ids")


def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score(load(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.select_target(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))
    return found.select("doc_id", "log_weight", "n_features", "gumbel_key", "selected")


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(load(spark, sf_dir, "documents"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_texts(load(spark, sf_dir, "documents"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_tokens(load(spark, sf_dir, "documents"))


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bag_search.search(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_duplicates(load(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_url_filter, op2_nearest, op3_media, op4_language, op5_sharding, op6_packing, op7_language_model, op8_quality, op9_near_duplicates, op10_bpe,
        op11_alignment, op12_search, op13_exact_dedup,
    )
    return {f.__name__: f for f in found}


def _op1_sql() -> str:
    rules = ", ".join(f"('{h}', '{p}', '{a}')" for h, p, a in URL_RULES)
    return f"""
WITH rules(r_host, r_path, action) AS (VALUES {rules}),
rest AS (
  SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
host AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*', 0) AS host FROM rest),
parts AS (
  SELECT row_number() OVER () AS n, page_id, translate(host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(host) + 1), '^[^?#]*', 0) AS path
  FROM host),
fits AS (
  SELECT n, r_host || r_path AS rule, action,
    row_number() OVER (PARTITION BY n ORDER BY length(r_host || r_path) DESC, length(r_host) DESC) AS place
  FROM parts JOIN rules ON (host = r_host OR suffix(host, '.' || r_host)) AND starts_with(path, r_path))
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict
FROM parts LEFT JOIN (SELECT * FROM fits WHERE place = 1) USING (n)"""


def _op5_sql() -> str:
    """The table is filled by a recursive query, one claim a step."""
    n, m = len(SHARDS), sharding.SLOTS
    return f"""
WITH RECURSIVE shards AS (
  SELECT i, name, CAST('0x' || substr(md5(name || '#offset'), 1, 8) AS BIGINT) % {m} AS first, CAST('0x' || substr(md5(name || '#skip'), 1, 8) AS BIGINT) % {m - 1} + 1 AS skip
  FROM (SELECT i, 'shard-' || lpad(CAST(i AS VARCHAR), 2, '0') AS name FROM range({n}) t(i))),
fill AS (
  SELECT 0 AS k, list_transform(range({m}), lambda x: -1) AS owner
  UNION ALL
  SELECT k + 1, list_concat(owner[:slot], [CAST(i AS BIGINT)], owner[slot + 2:]) FROM (
    SELECT k, owner, i, list_filter(list_transform(range({m}), lambda j: (first + j * skip) % {m}), lambda s: owner[s + 1] = -1)[1] AS slot
    FROM fill JOIN shards ON i = k % {n} WHERE k < {m})),
claims AS (SELECT unnest(owner) AS i, generate_subscripts(owner, 1) - 1 AS slot FROM fill WHERE k = {m}),
placed AS (SELECT doc_id, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) % {m} AS slot FROM documents)
SELECT doc_id, CAST(slot AS INTEGER) AS slot, name AS shard FROM placed JOIN claims USING (slot) JOIN shards USING (i)"""


OP12_SQL = r"""
WITH words AS (
  SELECT row, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS row, doc_id, text FROM documents)),
tf AS (SELECT row, doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
sizes AS (SELECT row, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY row),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM sizes),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, totals GROUP BY term, docs),
items AS (
  SELECT DISTINCT item_id,
    unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
scores AS (
  SELECT item_id, row, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // total)))) AS BIGINT) AS score
  FROM items JOIN tf USING (term) JOIN weights USING (term) JOIN sizes USING (row), totals GROUP BY item_id, row, doc_id)
SELECT item_id, rank, doc_id, score FROM (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scores WHERE score > 0)
WHERE rank <= 50"""

OP13_SQL = r"""
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS size, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content FROM documents),
g AS (
  SELECT doc_id, size, content, count(*) OVER (PARTITION BY content) AS group_size,
    first_value(doc_id) OVER (PARTITION BY content ORDER BY size DESC, doc_id) AS keep_id
  FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(content) AS text_sha256 FROM g"""


def oracle_sql() -> dict[str, str]:
    return {"op1_url_filter": _op1_sql(), "op5_sharding": _op5_sql(), "op12_search": OP12_SQL, "op13_exact_dedup": OP13_SQL}
