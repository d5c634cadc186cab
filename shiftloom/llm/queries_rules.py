"""Query op4 and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._spark import table
from .quality_rules import quality_rules


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules(table(spark, sf_dir, "documents"))
    digest = F.sha2("text", 256).alias("clean_sha256")
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "removed_lines", "removed_chars", digest, "kept")


OP4_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(source, chr(1)) AS host, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
             [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS ls FROM d),
win AS (SELECT rid, i, array_to_string(list_slice(ws, i + 1, i + 8), ' ') AS s FROM (SELECT rid, ws, unnest(range(0, len(ws) - 7)) AS i FROM w WHERE len(ws) >= 8)),
dup AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, s) AS c FROM win) WHERE c > 1),
rep AS (SELECT rid, count(DISTINCT i + k) AS n FROM dup, (SELECT unnest(range(0, 8)) AS k) GROUP BY rid),
ln AS (SELECT DISTINCT rid, host, trim(regexp_replace(lower(l), '[\x20\x09-\x0D]+', ' ', 'g')) AS l FROM (SELECT rid, unnest(ls) AS l FROM w) JOIN d USING (rid)),
who AS (SELECT rid, host, coalesce(doc_id::VARCHAR, '-' || t) AS w FROM d),
hd AS (SELECT host, count(DISTINCT w) AS m FROM who GROUP BY host),
bad AS (SELECT host, l FROM (SELECT ln.host AS host, l, count(DISTINCT w) AS n FROM ln JOIN who USING (rid) GROUP BY ln.host, l) JOIN hd USING (host) WHERE n >= 3 AND 1000 * n > 50 * m),
bl AS (SELECT host, list(l) AS bs FROM bad GROUP BY host),
raw AS (SELECT rid, host, x, i, regexp_matches(x, '[^\x20\x09-\x0D]') AND list_contains(coalesce(bs, []), trim(regexp_replace(lower(x), '[\x20\x09-\x0D]+', ' ', 'g'))) AS gone FROM (SELECT rid, host, unnest(string_split(t, chr(10))) AS x, generate_subscripts(string_split(t, chr(10)), 1) AS i FROM d) LEFT JOIN bl USING (host)),
cl AS (SELECT rid, count(*) FILTER (WHERE gone) AS removed_lines, sha256(coalesce(string_agg(x, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS clean_sha256 FROM raw GROUP BY rid),
tot AS (SELECT rid, sum(length(l)) AS c FROM ln GROUP BY rid),
rem AS (SELECT rid, sum(length(l)) AS c FROM ln JOIN bad USING (host, l) GROUP BY rid),
f AS (SELECT d.doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
             coalesce(rep.n, 0) AS n_repeat_words, coalesce(rem.c, 0) AS removed_chars, coalesce(tot.c, 0) AS line_chars, removed_lines, clean_sha256
      FROM d JOIN w USING (rid) JOIN cl USING (rid) LEFT JOIN rep USING (rid) LEFT JOIN rem USING (rid) LEFT JOIN tot USING (rid))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed, removed_lines::BIGINT AS removed_lines, removed_chars::BIGINT AS removed_chars, clean_sha256,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND NOT (100 * removed_chars > 70 * line_chars) AS kept
FROM f
"""
