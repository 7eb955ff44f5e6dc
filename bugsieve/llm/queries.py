"""Registered queries of this package and the DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bugsieve.llm import (
    bpe, cotraining, divergence, html, licenses, packing, pair_index, passages, rules, sharding, simhash, topk, whitening,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op1_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.remove_repeated_passages(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.bpe_round_trip(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_main_text(table(spark, sf_dir, "pages"))


@query
def op5_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


@query
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


@query
def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query
def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotraining.quality_classifier(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLES["op9_exact_top_k"] = """
WITH v AS (
  SELECT vec_id, [floor(1024 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM s QUALIFY rank <= 10
"""


@query
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query
def op12_pair_index_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pair_index.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json")).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(pair_index.ids_text(F.col("ids")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit_sources(table(spark, sf_dir, "documents"))


ORACLES["op13_source_divergence"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), t AS (
  SELECT row_id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), kept AS (
  SELECT lang, term, count(*)::HUGEINT AS total FROM t GROUP BY ALL HAVING count(DISTINCT row_id) >= 30
), size AS (
  SELECT lang, count(*)::HUGEINT AS v, sum(total)::HUGEINT AS n FROM kept GROUP BY lang
), g AS (SELECT DISTINCT lang, source FROM d
), c AS (
  SELECT g.lang, g.source, k.term, k.total, coalesce(any_value(x.cnt), 0)::HUGEINT AS cnt
  FROM g JOIN kept k ON k.lang = g.lang
  LEFT JOIN (SELECT lang, source, term, count(*) AS cnt FROM t GROUP BY ALL) x
  ON x.lang = g.lang AND x.source = g.source AND x.term = k.term GROUP BY ALL
), p AS (
  SELECT c.*, 1 + 1000000000 * (cnt + 5) // (sum(cnt) OVER (PARTITION BY c.lang, source)::HUGEINT + 5 * v) AS p,
         1 + 1000000000 * (total + 5) // (n + 5 * v) AS q
  FROM c JOIN size USING (lang)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p WHERE cnt > 0 AND p > q
)
SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
FROM r QUALIFY part = 'pair' OR rank <= 50
"""
