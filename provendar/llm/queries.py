"""The registered queries of the corpus operators: thin digests of what the operators return."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C
from . import alignment, conversations, decontaminate, jaccard_join, language, neighbours, quality, repeats, sentencepiece_codec, sharding, token_files, toxicity, url_filters


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.filter_urls(C.table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toxicity.score_documents(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "labels"))
    return out.select("doc_id", C.held_out().alias("held_out"), "score", "predicted")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.score_documents(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "labels"))
    return out.select("doc_id", C.held_out().alias("held_out"), "score", "predicted")


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link_components(C.table(spark, sf_dir, "documents"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    return language.identify(docs, language.train(docs)).select("doc_id", C.held_out().alias("held_out"), "lang_pred", "score")


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(C.table(spark, sf_dir, "documents"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text with the public 32k model, as count and checksum, and whether decoding gives the text back."""
    return sentencepiece_codec.encode_documents(C.table(spark, sf_dir, "documents"), ids=False)


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(C.table(spark, sf_dir, "embeddings"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.interleave(C.table(spark, sf_dir, "documents"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each test item found in a document; documents without one have no row."""
    return decontaminate.find_leaks(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "benchmark"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(C.table(spark, sf_dir, "documents"))[0]


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(conversations.damage(C.table(spark, sf_dir, "conversations")))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(C.table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_url_filters, op2_toxicity, op3_quality, op4_jaccard_join, op5_language, op6_repeats, op7_sentencepiece, op8_neighbours, op9_sharding, op10_decontaminate, op11_alignment, op12_conversations, op13_token_files)
}

ORACLE: dict[str, str] = {}

ORACLE["op1_url_filters"] = r"""
WITH u AS (
  SELECT page_id, url,
         CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
h AS (
  SELECT page_id, rest,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u),
t AS (
  SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, coalesce(rest, '') AS rest FROM h),
r AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/'
  END AS rule FROM t)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
            WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow'
            WHEN regexp_matches(rest, '/ads/|/banner[./_-]|/login(?:[/.?#]|$)|/signup(?:[/.?#]|$)|[?&]sessionid=') THEN 'block'
            ELSE 'allow' END AS verdict
FROM r
"""

ORACLE["op8_neighbours"] = """
WITH e AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
  FROM e q JOIN e c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 20
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
