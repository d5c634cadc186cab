"""Queries op1, op2, op7, op8, op9 and op10: passes over whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._spark import table
from .byte_cnn import quality_scores, train_quality
from .decontaminate import contamination
from .pii import personal_data
from .suffix_tree_lm import language_scores
from .tokens import section_tokens, token_digests


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_scores(docs, train_quality(docs, table(spark, sf_dir, "labels")))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(
        F.col("key").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


OP8_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT item_id::VARCHAR AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
bw AS (SELECT item_id, ws, least(10, len(ws)) AS k FROM b WHERE len(ws) > 0),
iw AS (SELECT DISTINCT item_id, k, array_to_string(list_slice(ws, i + 1, i + k), ' ') AS s FROM (SELECT item_id, ws, k, unnest(range(0, len(ws) - k + 1)) AS i FROM bw)),
sizes AS (SELECT DISTINCT k FROM iw),
dw AS (SELECT rid, k, i, array_to_string(list_slice(ws, i + 1, i + k), ' ') AS s FROM (SELECT rid, ws, k, unnest(range(0, len(ws) - k + 1)) AS i FROM d, sizes WHERE len(ws) >= k)),
hits AS (SELECT rid, dw.k AS k, i, item_id FROM dw JOIN iw ON dw.k = iw.k AND dw.s = iw.s),
cov AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT rid, k, i FROM hits)) GROUP BY rid),
its AS (SELECT rid, count(DISTINCT item_id) AS n, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS l FROM hits GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(cov.n, 0)::BIGINT AS n_hit, coalesce(its.n, 0)::BIGINT AS n_items,
       sha256(coalesce(its.l, '')) AS items_sha256, coalesce(cov.n, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (rid) LEFT JOIN its USING (rid)
"""


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


def op7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"))


def op10_section_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return section_tokens(table(spark, sf_dir, "documents"), ("source", "lang", "text"))


def op9_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_scores(table(spark, sf_dir, "documents"))
