"""Queries op3, op5 and op6."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._spark import table
from .chaining import passage_classes
from .simhash import simhash_components
from .suffix_dedup import remove_repeats


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash_components(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op6_chaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passage_classes(table(spark, sf_dir, "documents"))


OP3_SQL = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, encode(coalesce(text, '')) AS h FROM documents),
p AS (SELECT rid, doc_id, h, unnest(range(0, octet_length(h))) AS i FROM d),
w AS (SELECT rid, doc_id, i, array_slice(h, i + 1, i + 50) AS s FROM p WHERE i + 50 <= octet_length(h)),
f AS (SELECT s, min(doc_id) AS least FROM w GROUP BY s),
g AS (SELECT rid, i FROM w JOIN f USING (s) WHERE least < doc_id),
c AS (SELECT p.rid AS rid, p.i AS i, hex(array_slice(h, p.i + 1, p.i + 1)) AS b, coalesce(max(g.i) OVER (PARTITION BY p.rid ORDER BY p.i) >= p.i - 49, FALSE) AS gone FROM p LEFT JOIN g ON g.rid = p.rid AND g.i = p.i),
r AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY rid ORDER BY i), FALSE) AS begins FROM c),
a AS (SELECT rid, count(*) AS n_bytes, count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE begins) AS n_spans, string_agg(b, '' ORDER BY i) FILTER (WHERE NOT gone) AS kept FROM r GROUP BY rid)
SELECT doc_id, coalesce(n_bytes, 0)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN a USING (rid)
"""
