"""Queries over the driver tables, one or more for each family of operators, with the SQL that must agree."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import queries_records, queries_sources
from .catalog import DRAW, ORACLE_SQL, QUERIES, query, t
from .functions import clean, draws, formulas, spectrum, text, transcript
from .operators import cluster, dataset, enrich, ingest, precedents
from .plans import compile as artifacts
from .plans import reward
from .streaming import replay

__all__ = ["ORACLE_SQL", "QUERIES", "queries_records", "queries_sources"]

# --- datasets --------------------------------------------------------------------------------------


@query("SELECT doc_id, source, n_chars FROM documents ORDER BY doc_id LIMIT 25")
def head_n(spark, d):
    return dataset.head(t(spark, d, "documents").select("doc_id", "source", "n_chars"), 25, ["doc_id"])


@query("WITH p AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i, count(*) OVER () AS n FROM documents), v AS (SELECT * FROM (VALUES (0, 4), (1, 0), (2, 2), (3, 2), (4, -1)) x(pos, k)) SELECT pos::BIGINT AS pos, doc_id FROM v JOIN p ON p.i = CASE WHEN k < 0 THEN n + k ELSE k END")
def select_indices(spark, d):
    rows = dataset.positions(t(spark, d, "documents").select("doc_id"), ["doc_id"])
    return dataset.select(rows, [4, 0, 2, 2, -1]).select("pos", "doc_id")


@query("SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1)::BIGINT AS row_id FROM documents")
def row_positions(spark, d):
    return dataset.positions(t(spark, d, "documents").select("doc_id"), ["doc_id"])


@query("WITH p AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM documents) SELECT doc_id, i::BIGINT AS row_id FROM p WHERE i BETWEEN 10 AND 29")
def slice_rows(spark, d):
    return dataset.slice_rows(dataset.positions(t(spark, d, "documents").select("doc_id"), ["doc_id"]), 10, 30)


@query(f"SELECT doc_id, (row_number() OVER (ORDER BY {DRAW.format(3, 'shuffle', 'doc_id')}, doc_id) - 1)::BIGINT AS place FROM documents")
def shuffled(spark, d):
    docs = t(spark, d, "documents").select("doc_id").withColumn("_h", draws.draw_bits(3, "shuffle", F.col("doc_id")))
    return dataset.positions(docs, ["_h", "doc_id"], "place").drop("_h")


@query(f"WITH h AS (SELECT doc_id, source, {DRAW.format(7, 'sample', 'doc_id')} AS h FROM documents), r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY h, doc_id) AS r FROM h) SELECT doc_id, source FROM r ORDER BY r, h, doc_id LIMIT 137")
def balanced_sample(spark, d):
    return dataset.sample(t(spark, d, "documents").select("doc_id", "source"), 137, 7, "doc_id", "source")


@query(f"WITH h AS (SELECT doc_id, {DRAW.format(7, 'sample', 'doc_id')} AS h FROM documents) SELECT doc_id FROM h ORDER BY h, doc_id LIMIT 60")
def uniform_sample(spark, d):
    labelled = t(spark, d, "documents").join(t(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left").select("doc_id", "quality")
    return dataset.sample(labelled, 60, 7, "doc_id", "quality").select("doc_id")


@query(f"WITH h AS (SELECT doc_id, lang, {DRAW.format(7, 'cut', 'doc_id')} AS h FROM documents), k AS (SELECT greatest(90 // count(DISTINCT lang), 1) AS q FROM documents), r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY h, doc_id) AS r FROM h) SELECT doc_id, lang FROM r, k ORDER BY (r > q)::INT, h, doc_id LIMIT 90")
def balanced_cut(spark, d):
    return dataset.balanced_cut(t(spark, d, "documents").select("doc_id", "lang"), 90, 7, "doc_id", "lang")


@query(f"WITH h AS (SELECT doc_id, row_number() OVER (ORDER BY {DRAW.format(7, 'split', 'doc_id')}, doc_id) - 1 AS i FROM documents) SELECT doc_id, CASE WHEN i < 100 THEN 'train' WHEN i < 130 THEN 'test' ELSE 'sft' END AS split FROM h WHERE i < 170")
def disjoint_splits(spark, d):
    return dataset.disjoint_splits(t(spark, d, "documents").select("doc_id"), {"train": 100, "test": 30, "sft": 40}, 7, "doc_id")


@query("SELECT source, count(*) AS n_rows FROM documents GROUP BY source")
def cluster_sizes(spark, d):
    return dataset.sizes(t(spark, d, "documents"), "source")


@query("SELECT quality::VARCHAR AS value, count(*) AS n FROM documents LEFT JOIN labels USING (doc_id) GROUP BY quality")
def histogram(spark, d):
    return dataset.histogram(t(spark, d, "documents").join(t(spark, d, "labels"), "doc_id", "left"), "quality")


@query("SELECT source_ord, nation, count(*) AS n_rows, count(segment) AS n_segments FROM (SELECT 0 AS source_ord, c_nationkey AS nation, c_mktsegment AS segment FROM customer UNION ALL SELECT 1, s_nationkey, NULL FROM supplier) GROUP BY source_ord, nation")
def union_sources(spark, d):
    a = t(spark, d, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"))
    b = t(spark, d, "supplier").select(F.col("s_nationkey").alias("nation"))
    return dataset.union_sources([a, b]).groupBy("source_ord", "nation").agg(F.count("*").alias("n_rows"), F.count("segment").alias("n_segments"))


# --- ingest -----------------------------------------------------------------------------------------


def _reviewed(spark, d):
    # the whole text is cleaned before the join; only whether anything is left of it is asked
    docs = t(spark, d, "documents").select("doc_id", "source", "lang", F.substring(clean.clean_str(F.col("text")), 1, 1).alias("body"))
    docs = docs.join(t(spark, d, "labels"), "doc_id", "left")
    options = ingest.IngestOptions(nmr_types=("en", "de", "fr"), quality="same_molecule")
    mark = F.when(F.col("toxic") == 1, " Wrong ").when(F.col("toxic") == 0, "right")
    return docs.withColumn("drop_reason", ingest.drop_reason(F.col("body"), F.col("lang"), F.col("quality") == 1, F.lit(None).cast("boolean"), [clean.clean_str(mark)], options))


_REASON = "CASE WHEN trim(coalesce(text, '')) = '' THEN 'empty' WHEN coalesce(lang, '') NOT IN ('en', 'de', 'fr') THEN 'type' WHEN NOT coalesce(quality = 1, TRUE) THEN 'quality' WHEN coalesce(toxic, 0) = 1 THEN 'qc' END"


@query(f"SELECT coalesce({_REASON}, 'kept') AS reason, count(*) AS n FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1")
def drop_reasons(spark, d):
    return _reviewed(spark, d).groupBy(F.coalesce("drop_reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


@query(f"WITH r AS (SELECT source, lang, {_REASON} AS reason FROM documents LEFT JOIN labels USING (doc_id)) SELECT source, lang, count(*) AS n_rows, count(*) FILTER (WHERE reason IS NULL) AS kept, count(*) FILTER (WHERE reason = 'empty') AS dropped_empty, count(*) FILTER (WHERE reason = 'type') AS dropped_type, count(*) FILTER (WHERE reason = 'quality') AS dropped_quality, count(*) FILTER (WHERE reason = 'qc') AS dropped_qc FROM r GROUP BY ROLLUP (source, lang)")
def ingest_summary(spark, d):
    return ingest.summary(_reviewed(spark, d), ["source", "lang"])


@query("SELECT source, min(doc_id) AS doc_id, count(*) AS n_members, string_agg(n_chars::VARCHAR, ',' ORDER BY doc_id) AS sizes, CASE WHEN count(*) > 1 THEN string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) END AS ids FROM documents GROUP BY source")
def merge_records(spark, d):
    merged = ingest.merge_by_key(t(spark, d, "documents"), "source", ["doc_id"], "doc_id", "n_chars")
    joined = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
    return merged.select("source", "doc_id", "n_members", joined("n_chars_list").alias("sizes"), joined("merged_sample_ids").alias("ids"))


@query("WITH g AS (SELECT count(*) AS n FROM documents GROUP BY text) SELECT count(*) FILTER (WHERE n > 1) AS merged_groups, sum(n - 1)::BIGINT AS merged_into FROM g")
def merge_counts(spark, d):
    return ingest.merge_counts(t(spark, d, "documents").groupBy(F.sha2("text", 256).alias("k")).agg(F.count("*").alias("n_members")))


_WORD = "split_part(replace(text, chr(10), ' '), ' ', 1 + (doc_id % 5)::INT)"


@query(f"""WITH w AS (SELECT doc_id, {_WORD} AS w, source, n_chars FROM documents), x AS (SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN ' ' || w || chr(9) WHEN 1 THEN 'NaN' WHEN 2 THEN ' null ' WHEN 3 THEN w || ' ' || n_chars ELSE w END AS raw, CASE WHEN doc_id % 2 = 0 THEN ' ' || n_chars ELSE n_chars || '.5' END AS num, CASE doc_id % 5 WHEN 0 THEN 'YES' WHEN 1 THEN ' no ' WHEN 2 THEN '1' ELSE w END AS flag FROM w)
SELECT doc_id AS k, CASE WHEN lower(trim(raw, ' ' || chr(9))) IN ('nan', 'none', 'null') THEN '' ELSE trim(raw, ' ' || chr(9)) END AS s, TRY_CAST(CASE WHEN num LIKE '%.%' THEN NULL ELSE trim(num) END AS BIGINT) AS i, TRY_CAST(trim(num) AS DOUBLE) AS f, CASE WHEN lower(trim(flag)) IN ('true', '1', 'yes') THEN TRUE WHEN lower(trim(flag)) IN ('false', '0', 'no') THEN FALSE END AS b FROM x""")
def clean_scalars(spark, d):
    k, w = F.col("doc_id"), F.get(F.split(F.replace("text", F.lit("\n"), F.lit(" ")), " "), (F.col("doc_id") % 5).cast("int"))
    w = F.coalesce(w, F.lit(""))
    s = F.when(k % 7 == 0, F.concat(F.lit(" "), w, F.lit("\t"))).when(k % 7 == 1, "NaN").when(k % 7 == 2, " null ").when(k % 7 == 3, F.concat_ws(" ", w, "n_chars")).otherwise(w)
    n = F.when(k % 2 == 0, F.concat(F.lit(" "), "n_chars")).otherwise(F.concat("n_chars", F.lit(".5")))
    b = F.when(k % 5 == 0, "YES").when(k % 5 == 1, " no ").when(k % 5 == 2, "1").otherwise(w)
    return t(spark, d, "documents").select(k.alias("k"), clean.clean_str(s).alias("s"), clean.clean_int(n).alias("i"), clean.clean_float(n).alias("f"), clean.clean_bool(b).alias("b"))


@query("SELECT p_partkey AS k, '[[\"d\",[' || p_size || '.5],\"' || (p_size % 4) || 'H\",7.25,null]]' AS peaks FROM part")
def parse_peaks(spark, d):
    raw = F.concat(F.lit("[('d', ["), F.col("p_size"), F.lit(".5], '"), F.col("p_size") % 4, F.lit("H', 7.25, None)]"))
    return t(spark, d, "part").select(F.col("p_partkey").alias("k"), ingest.parsed_peaks(raw).alias("peaks"))


# --- joins and look-ups -----------------------------------------------------------------------------


def _reactions(spark, d):
    one = lambda c: F.sort_array(F.collect_set(F.col(c).cast("string")))
    return t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("record"), F.col("l_returnflag").alias("source")).agg(one("l_suppkey").alias("reactants"), one("l_partkey").alias("products"))


@query("""WITH x AS (SELECT l_orderkey AS record, l_returnflag AS source, list_sort(list_distinct(list(l_suppkey::VARCHAR))) AS rs, list_distinct(list(l_partkey::VARCHAR)) AS ps FROM lineitem GROUP BY 1, 2),
e AS (SELECT record, source, CASE source WHEN 'N' THEN 0 WHEN 'R' THEN 1 ELSE 2 END AS sr, array_to_string(rs, '.') AS sig, unnest(ps) AS product FROM x),
m AS (SELECT product, source, sr, sig, min(record) AS record FROM e WHERE product IN (SELECT p_partkey::VARCHAR FROM part) GROUP BY 1, 2, 3, 4),
r AS (SELECT *, row_number() OVER (PARTITION BY product ORDER BY sr, record) AS rank FROM m)
SELECT product, record, source, rank::INT AS rank FROM r WHERE rank <= 3""")
def precedent_scan(spark, d):
    targets = t(spark, d, "part").select(F.col("p_partkey").cast("string").alias("product"))
    rank = F.when(F.col("source") == "N", 0).when(F.col("source") == "R", 1).otherwise(2)
    return precedents.scan_precedents(_reactions(spark, d), targets, 3, rank)


@query("""WITH c AS (SELECT DISTINCT l_orderkey AS record, l_partkey AS component FROM lineitem), n AS (SELECT record, count(*) AS rn FROM c GROUP BY 1),
q AS (SELECT record AS query, component FROM c WHERE record % 50 = 0), qn AS (SELECT query, count(*) AS qn FROM q GROUP BY 1),
s AS (SELECT q.query, c.record, count(*) AS k FROM q JOIN c USING (component) GROUP BY 1, 2),
f AS (SELECT s.query, s.record, o_custkey AS product, k::DOUBLE / qn AS cov, round(least(greatest(0.5::DOUBLE * k / qn + 0.3::DOUBLE * k / (qn + rn - k) + 0.12::DOUBLE * k / rn, 0), 1), 6) AS score FROM s JOIN n USING (record) JOIN qn USING (query) JOIN orders ON o_orderkey = record),
b AS (SELECT *, row_number() OVER (PARTITION BY query, product ORDER BY score DESC, cov DESC, record) AS i FROM f),
r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, cov DESC, record) AS rank FROM b WHERE i = 1)
SELECT query, rank::INT AS rank, product, record, score, round(cov, 6) AS coverage, CASE WHEN score >= 0.8 AND cov >= 0.75 THEN 'high' WHEN score >= 0.45 THEN 'medium' ELSE 'low' END AS confidence FROM r WHERE rank <= 5""")
def overlap_search(spark, d):
    parts = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("record"), F.col("l_partkey").alias("component"))
    index = precedents.inverted_index(parts.groupBy("record").agg(F.collect_set("component").alias("components")))
    queries = index.where("record % 50 = 0").select(F.col("record").alias("query"), "component")
    records = t(spark, d, "orders").select(F.col("o_orderkey").alias("record"), F.col("o_custkey").alias("product"), F.lit(0).alias("source_ord"))
    return precedents.overlap_search(index, queries, records, 5)


def _cache(spark, d):
    return t(spark, d, "events").groupBy(F.col("user_id").alias("key")).agg(F.sort_array(F.collect_set("event_type")).alias("stages"))


@query("""WITH c AS (SELECT user_id AS k, list_distinct(list(event_type)) AS s FROM events WHERE event_id % 3 = 0 GROUP BY 1), k AS (SELECT DISTINCT user_id AS k FROM events)
SELECT k::VARCHAR AS key, array_to_string([x FOR x IN ['click', 'view', 'error'] IF NOT list_contains(coalesce(s, []), x)], ',') AS missing FROM k LEFT JOIN c USING (k) WHERE len([x FOR x IN ['click', 'view', 'error'] IF NOT list_contains(coalesce(s, []), x)]) > 0""")
def pending_keys(spark, d):
    rows = t(spark, d, "events").select(F.col("user_id").cast("string").alias("key"))
    cache = t(spark, d, "events").where("event_id % 3 = 0").groupBy(F.col("user_id").cast("string").alias("key")).agg(F.collect_set("event_type").alias("stages"))
    return enrich.pending(rows, cache, ["click", "view", "error"]).select("key", F.array_join("missing", ",").alias("missing"))


@query("SELECT user_id AS key, max(event_id) AS version, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id")
def cache_latest(spark, d):
    rows = t(spark, d, "events").select(F.col("user_id").alias("key"), F.col("event_id").alias("version"), "event_type")
    return enrich.latest(rows)


@query("WITH c AS (SELECT user_id, list(DISTINCT event_type) AS s FROM events GROUP BY 1), x AS (SELECT st AS stage, list_contains(s, st) AS done FROM c, (SELECT unnest(['click', 'error', 'nothing']) AS st)) SELECT stage, count(*) FILTER (WHERE done) AS completed, count(*) AS total, round(100.0::DOUBLE * count(*) FILTER (WHERE done) / count(*), 1) AS percentage FROM x GROUP BY stage")
def cache_completion(spark, d):
    return enrich.completion(_cache(spark, d), ("click", "error", "nothing"))


@query("SELECT count(*) AS n_rows, count(DISTINCT c_custkey) AS n_keys, count(o.k) AS n_hits, count(*) - count(o.k) AS n_misses FROM customer LEFT JOIN (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'F') o ON c_custkey = o.k")
def cache_coverage(spark, d):
    cache = t(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("key")).distinct()
    return enrich.coverage(t(spark, d, "customer").select(F.col("c_custkey").alias("key")), cache)


@query("SELECT o_custkey AS k, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS i FROM orders) WHERE i = 1")
def best_per_key(spark, d):
    rows = t(spark, d, "orders").select(F.col("o_custkey").alias("k"), "o_orderkey", "o_totalprice")
    return precedents.best_per_key(rows, ["k"], [-F.col("o_totalprice"), F.col("o_orderkey")])


@query("SELECT l_orderkey, l_linenumber, round(exp(q - m) / sum(exp(q - m)) OVER (PARTITION BY l_orderkey), 9) AS probability FROM (SELECT l_orderkey, l_linenumber, coalesce(q, m - 100) AS q, m FROM (SELECT *, coalesce(max(q) OVER (PARTITION BY l_orderkey), 0) AS m FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <> 3 THEN l_quantity END AS q FROM lineitem)))")
def softmax(spark, d):
    rows = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") != 3, F.col("l_quantity")).alias("q"))
    return precedents.softmax_scores(rows, "l_orderkey", "q").select("l_orderkey", "l_linenumber", F.round("probability", 9).alias("probability"))


@query("SELECT l_orderkey, l_linenumber, round(s, 9) AS score, CASE WHEN s >= 0.5 THEN 'high' WHEN s >= 0.1 THEN 'medium' ELSE 'low' END AS band FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN greatest(b, 0.62::DOUBLE + 0.30::DOUBLE * b) WHEN l_returnflag = 'A' THEN 0.2::DOUBLE * b ELSE b END AS s FROM (SELECT *, coalesce(CASE WHEN l_linenumber < 4 THEN l_discount * 10 END, 1.0::DOUBLE / l_linenumber) AS b FROM lineitem))")
def forward_scores(spark, d):
    raw = F.when(F.col("l_linenumber") < 4, F.col("l_discount") * 10)
    same = F.when(F.col("l_returnflag") == "R", True).when(F.col("l_returnflag") == "A", False)
    s = precedents.forward_score(raw, F.col("l_linenumber").cast("double"), same)
    return t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.round(s, 9).alias("score"), precedents.forward_band(s).alias("band"))


@query("WITH a AS (SELECT l_orderkey AS k, list_distinct(list(l_partkey % 40)) AS x, list_distinct(list(l_suppkey % 40)) AS y FROM lineitem GROUP BY 1) SELECT k, len(list_intersect(x, y)) AS common, len(x) - len(list_intersect(x, y)) AS only_a, len(y) - len(list_intersect(x, y)) AS only_b, round(len(list_intersect(x, y))::DOUBLE / (len(x) + len(y) - len(list_intersect(x, y))), 9) AS jaccard FROM a")
def set_algebra(spark, d):
    rows = t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.collect_set(F.col("l_partkey") % 40).alias("x"), F.collect_set(F.col("l_suppkey") % 40).alias("y"))
    s = precedents.set_sizes(F.col("x"), F.col("y"))
    return rows.select("k", s["common"].cast("bigint").alias("common"), s["only_a"].cast("bigint").alias("only_a"), s["only_b"].cast("bigint").alias("only_b"), F.round(s["jaccard"], 9).alias("jaccard"))


# --- text and spectra -------------------------------------------------------------------------------

_PEAKS = "p_size || '.25 (d, J = ' || (p_size % 9) || '.5 Hz, 2H), ' || p_brand || ' [a, (b, c)], ' || p_partkey || '.50 (s, 3H)'"


def _peaks():
    c = F.col
    return F.concat(c("p_size"), F.lit(".25 (d, J = "), c("p_size") % 9, F.lit(".5 Hz, 2H), "), c("p_brand"), F.lit(" [a, (b, c)], "), c("p_partkey"), F.lit(".50 (s, 3H)"))


@query(f"SELECT p_partkey, array_to_string(regexp_extract_all({_PEAKS}, '\\d+\\.\\d+|\\d+'), ' ') AS digits FROM part")
def digits_only(spark, d):
    return t(spark, d, "part").select("p_partkey", spectrum.digits_only(_peaks()).alias("digits"))


@query("SELECT p_partkey, p_size || '.25 (d, J = ' || (p_size % 9) || '.5 Hz, 2H)|' || p_brand || ' [a, (b, c)]|' || p_partkey || '.50 (s, 3H)' AS peaks, 3 AS n FROM part")
def split_peaks(spark, d):
    p = spectrum.split_peaks(_peaks())
    return t(spark, d, "part").select("p_partkey", F.array_join(p, "|").alias("peaks"), F.size(p).alias("n"))


@query(f"WITH c AS (SELECT p_partkey, t, unnest(range(0, length(t))) AS i FROM (SELECT p_partkey, {_PEAKS} AS t FROM part)) SELECT p_partkey, string_agg(t[i + 1], '' ORDER BY i) AS stripped FROM c WHERE NOT (t[i + 1] IN ('(', ')', ',', '[', ']') AND (('0x' || substr(md5('5:punct' || i || ':' || p_partkey), 1, 8))::BIGINT) / 4294967296.0::DOUBLE < 0.3) GROUP BY p_partkey")
def strip_punct(spark, d):
    return t(spark, d, "part").select("p_partkey", spectrum.strip_punctuation(_peaks(), 0.3, 5, F.col("p_partkey")).alias("stripped"))


@query("""WITH p AS (SELECT p_partkey AS k, [p_size || '.25 (d, J = ' || (p_size % 9) || '.5 Hz, 2H)', p_brand || ' [a, (b, c)]', p_partkey || '.50 (s, 3H)'] AS ps FROM part),
x AS (SELECT k, ps, unnest(range(0, 3)) AS i FROM p),
s AS (SELECT k, string_agg(ps[i + 1], ', ' ORDER BY i) AS kept FROM x WHERE (('0x' || substr(md5('5:peak' || i || ':' || k), 1, 8))::BIGINT) / 4294967296.0::DOUBLE >= 0.5 GROUP BY k)
SELECT k AS p_partkey, coalesce(kept, ps[1 + (('0x' || substr(md5('5:peakpick:' || k), 1, 8))::BIGINT) % 3]) AS peaks FROM p LEFT JOIN s USING (k)""")
def drop_peaks(spark, d):
    return t(spark, d, "part").select("p_partkey", spectrum.drop_peaks(_peaks(), 0.5, 5, F.col("p_partkey")).alias("peaks"))


@query()
def perturb_values(spark, d):
    return t(spark, d, "part").select("p_partkey", spectrum.perturb_values(_peaks(), 0.5, 5, F.col("p_partkey")).alias("peaks"))


@query("SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN '' ELSE concat_ws(': ', nullif(concat_ws(' ', nullif(CASE WHEN p_size % 2 = 0 THEN '1H NMR' ELSE '' END, ''), CASE WHEN p_size % 5 = 0 THEN '(400 MHz, ' || p_brand || ')' ELSE '(' || p_brand || ')' END), ''), p_name) END AS spectrum FROM part")
def spectrum_text(spark, d):
    c = F.col
    return t(spark, d, "part").select("p_partkey", spectrum.spectrum_text(F.when(c("p_size") % 2 == 0, " 1H NMR ").otherwise(""), F.when(c("p_size") % 5 == 0, "400 MHz"), c("p_brand"), F.when(c("p_size") % 3 != 0, c("p_name"))).alias("spectrum"))


_KINDS = "[" + ", ".join(f"'{k}'" for k, _ in spectrum.KINDS) + ", 'Raman']"
_LABELS = " ".join(f"WHEN contains(upper(kind), upper('{k}')) THEN '{v}'" for k, v in spectrum.KINDS)


@query(f"WITH x AS (SELECT p_partkey, {_KINDS}[1 + p_size % 13] || CASE WHEN p_partkey % 3 = 0 THEN '-' || {_KINDS}[1 + (p_partkey % 13)::INT] || ' ' ELSE ' ' END || lower(p_brand) AS kind FROM part) SELECT p_partkey, CASE {_LABELS} ELSE kind END AS label FROM x")
def kind_labels(spark, d):
    names = F.array(*[F.lit(k) for k, _ in spectrum.KINDS], F.lit("Raman"))
    second = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("-"), F.get(names, (F.col("p_partkey") % 13).cast("int")), F.lit(" "))).otherwise(" ")
    kind = F.concat(F.get(names, F.col("p_size") % 13), second, F.lower("p_brand"))
    return t(spark, d, "part").select("p_partkey", spectrum.kind_label(kind).alias("label"))


@query(f"""WITH f AS (SELECT o_orderkey AS k, (o_orderkey % 20 + 3)::INT AS c, (o_custkey % 30 + 4)::INT AS h, {DRAW.format(9, 'formula', 'o_orderkey')} % 8 AS e FROM orders),
x AS (SELECT k, e, c + CASE e WHEN 6 THEN 1 WHEN 7 THEN -1 ELSE 0 END AS c, h + CASE e WHEN 0 THEN 2 WHEN 1 THEN -2 WHEN 6 THEN 2 WHEN 7 THEN -2 ELSE 0 END AS h, 2 + CASE e WHEN 4 THEN 1 WHEN 5 THEN -1 ELSE 0 END AS n, 2 + CASE e WHEN 2 THEN 1 WHEN 3 THEN -1 ELSE 0 END AS o FROM f)
SELECT k, 'C' || c || 'H' || h || 'N' || CASE WHEN n = 1 THEN '' ELSE n::VARCHAR END || 'O' || CASE WHEN o = 1 THEN '' ELSE o::VARCHAR END AS formula, ['hydrogen_plus_2', 'hydrogen_minus_2', 'oxygen_plus_1', 'oxygen_minus_1', 'nitrogen_plus_1', 'nitrogen_minus_1', 'homolog_plus_CH2', 'homolog_minus_CH2'][e + 1] AS operation FROM x""")
def formula_edits(spark, d):
    k = F.col("o_orderkey")
    f = F.concat(F.lit("N2C"), k % 20 + 3, F.lit("H"), F.col("o_custkey") % 30 + 4, F.lit("O2"))
    return t(spark, d, "orders").select(k.alias("k"), formulas.perturb(f, 9, k).alias("x")).select("k", "x.formula", "x.operation")


@query(f"WITH w AS (SELECT {DRAW.format(11, 'information', 'doc_id')} / 4294967296.0::DOUBLE AS u FROM documents) SELECT CASE WHEN u <= 0.3 THEN 'none' WHEN u <= 0.5 THEN 'formula' WHEN u <= 0.7 THEN 'structure' WHEN u <= 0.85 THEN 'reaction' ELSE 'fragment' END AS information, count(*) AS n FROM w GROUP BY 1")
def draw_mix(spark, d):
    mix = {"none": 0.30, "formula": 0.20, "structure": 0.20, "reaction": 0.15, "fragment": 0.15}
    return t(spark, d, "documents").select(draws.weighted(mix, draws.u(11, "information", F.col("doc_id"))).alias("information")).groupBy("information").agg(F.count("*").alias("n"))


def _listed(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


@query(f"""WITH g AS (SELECT p_partkey, p_size, {_listed(text.HEDGES_BEFORE)}[1 + {DRAW.format(4, 'hedge', 'p_partkey')} % 5] || CASE p_size % 3 WHEN 0 THEN ' ' || p_brand WHEN 1 THEN p_brand || '（中文名）' ELSE p_brand || '（英文名）' END || {_listed(text.HEDGES_AFTER)}[1 + {DRAW.format(4, 'hedged', 'p_partkey')} % 5] AS guess FROM part)
SELECT p_partkey, guess, {_listed(text.FOLLOWUP_LEADS)}[1 + {DRAW.format(4, 'more', 'p_partkey')} % 5] || guess || '。' || CASE WHEN suffix(guess, '，不太确定') OR suffix(guess, '，目前是这样') OR suffix(guess, '，基本上是这样') OR suffix(guess, '，帮我核实下') THEN '' ELSE {_listed(text.FOLLOWUP_TAILS)}[1 + {DRAW.format(4, 'later', 'p_partkey')} % 5] END AS said FROM g""")
def render_turns(spark, d):
    kind = F.element_at(F.array(*[F.lit(k) for k in text.KIND_NAMES]), F.col("p_size") % 3 + 1)
    guess = text.structure_block(F.col("p_brand"), kind, 4, F.col("p_partkey"))
    return t(spark, d, "part").select("p_partkey", guess.alias("guess"), text.followup_turn(guess, 4, F.col("p_partkey")).alias("said"))


_REACTION_TEXT = "concat_ws('；', CASE WHEN p_size % 4 <> 0 THEN concat_ws('，', '原料：' || p_brand || '、' || p_type, CASE WHEN p_size % 3 = 0 THEN '条件：' || p_name END) END, CASE WHEN p_size % 5 = 0 THEN '反应类型：' || p_type END)"


@query(f"WITH x AS (SELECT p_partkey, p_size, p_brand, p_type, {_REACTION_TEXT} AS body FROM part) SELECT p_partkey, CASE WHEN body = '' THEN '' WHEN p_size % 2 = 0 THEN '如下是化合物的大致合成路线：' || body || {_listed(text.HEDGES_AFTER)}[1 + {DRAW.format(4, 'routed', 'p_partkey')} % 5] ELSE '化合物合成信息如下：' || body END AS reaction, CASE WHEN p_size % 3 = 0 THEN '' WHEN p_size % 2 = 0 THEN {_listed(text.FRAGMENT_HEDGES)}[1 + {DRAW.format(4, 'has', 'p_partkey')} % 3] || p_brand || '、' || p_type || {_listed(text.HEDGES_AFTER)}[1 + {DRAW.format(4, 'had', 'p_partkey')} % 5] ELSE '已知结构中含有' || p_brand || '、' || p_type END AS fragments, '这批样品是做高分子的，可能涉及' || p_brand || '（' || p_type || '）' AS polymer, '分子式：' || p_brand AS formula FROM x")
def render_blocks(spark, d):
    c, key, no = F.col, F.col("p_partkey"), F.lit(None).cast("string")
    item = lambda r, cond, name: F.struct(r.alias("reactants"), cond.alias("conditions"), name.alias("name"))
    a = item(F.when(c("p_size") % 4 != 0, F.array("p_brand", "p_type")), F.when((c("p_size") % 3 == 0) & (c("p_size") % 4 != 0), c("p_name")), no)
    items = F.array(a, item(F.array().cast("array<string>"), no, F.when(c("p_size") % 5 == 0, c("p_type"))))
    names = F.when(c("p_size") % 3 == 0, F.array(F.lit(""))).otherwise(F.array("p_brand", "p_type"))
    even = c("p_size") % 2 == 0
    polymer = text.polymer_block(F.array(F.struct(c("p_brand").alias("zh"), c("p_type").alias("polymerization_zh"))))
    return t(spark, d, "part").select("p_partkey", text.reaction_block(items, even, 4, key).alias("reaction"), text.fragment_block(names, even, 4, key).alias("fragments"), polymer.alias("polymer"), text.formula_block(c("p_brand")).alias("formula"))


@query("SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'My ' || p_brand || ' it is' WHEN p_size % 3 = 1 THEN 'template' ELSE 'template' END AS said, CASE WHEN p_size % 3 = 0 THEN 'llm' WHEN p_size % 3 = 1 THEN 'rejected_information_loss' ELSE 'template' END AS status FROM part")
def accept_rewrites(spark, d):
    candidate = F.when(F.col("p_size") % 3 == 0, F.concat(F.lit(" My "), F.col("p_brand"), F.lit(" it is "))).when(F.col("p_size") % 3 == 1, "lost")
    x = text.accept(candidate, F.lit("template"), F.array("p_brand", F.lit("")))
    return t(spark, d, "part").select("p_partkey", x["text"].alias("said"), x["status"].alias("status"))


@query("SELECT page_id, regexp_replace(html, '<[^>]+>', '', 'g') AS plain FROM pages")
def tag_strip(spark, d):
    return t(spark, d, "pages").select("page_id", text.strip_tags(F.col("html")).alias("plain"))


_NAMES = "CASE doc_id % 8 WHEN 0 THEN '乙' || n_chars WHEN 1 THEN (10 + n_chars % 90)::VARCHAR || '-' || (10 + doc_id % 90) || '-' || (doc_id % 10) WHEN 2 THEN ['CID ', 'chebi:', 'DB', 'HMDB', 'InChI=1S/', 'EC ', 'Zinc'][1 + (n_chars % 7)::INT] || doc_id WHEN 3 THEN n_chars::VARCHAR ELSE left(replace(text, chr(10), ' '), 1 + (doc_id * 7 % 260)::INT) END"


@query(f"WITH x AS (SELECT doc_id, trim({_NAMES}) AS n FROM documents) SELECT doc_id, CASE WHEN regexp_matches(n, '[\\x{{4e00}}-\\x{{9fff}}]') AND length(n) BETWEEN 2 AND 160 THEN 'chinese' WHEN regexp_full_match(n, '\\d{{2,7}}-\\d{{2}}-\\d') THEN 'cas' WHEN NOT regexp_matches(n, '[\\x{{4e00}}-\\x{{9fff}}]') AND length(n) BETWEEN 2 AND 200 AND regexp_matches(n, '[A-Za-z]') AND NOT regexp_matches(lower(n), '^({'|'.join(p.lower() for p in text.ID_PREFIXES)})') THEN 'english' ELSE 'other' END AS kind FROM x")
def name_class(spark, d):
    c, k = F.col, F.col("doc_id")
    cas = F.concat_ws("-", (10 + c("n_chars") % 90).cast("string"), (10 + k % 90).cast("string"), (k % 10).cast("string"))
    known = F.concat(F.get(F.array(*[F.lit(x) for x in ("CID ", "chebi:", "DB", "HMDB", "InChI=1S/", "EC ", "Zinc")]), (c("n_chars") % 7).cast("int")), k)
    words = F.substring(F.replace("text", F.lit("\n"), F.lit(" ")), F.lit(1), (1 + k * 7 % 260).cast("int"))
    name = F.when(k % 8 == 0, F.concat(F.lit("乙"), "n_chars")).when(k % 8 == 1, cas).when(k % 8 == 2, known).when(k % 8 == 3, c("n_chars").cast("string")).otherwise(words)
    return t(spark, d, "documents").select("doc_id", text.name_class(F.trim(name)).alias("kind"))


@query("SELECT p_partkey, '[CH3]O.' || p_size AS reactants, 'A' || p_size AS agents, p_brand AS products, 'https://en.wikipedia.org/wiki/Part_' || p_size AS url FROM part")
def reaction_strings(spark, d):
    raw = F.concat(F.lit("[CH3:"), F.col("p_size"), F.lit("]O. ."), F.col("p_size"), F.lit(">A"), F.col("p_size"), F.lit(">"), F.col("p_brand"))
    p = text.reaction_parts(text.strip_atom_maps(raw))
    return t(spark, d, "part").select("p_partkey", F.array_join(p["reactants"], ".").alias("reactants"), F.array_join(p["agents"], ".").alias("agents"), F.array_join(p["products"], ".").alias("products"), text.page_url(F.concat(F.lit("Part "), F.col("p_size"))).alias("url"))


@query("SELECT doc_id, CASE WHEN length(text) > 700 THEN left(text, 700) || '...' ELSE text END AS abstract FROM documents")
def truncate_text(spark, d):
    return t(spark, d, "documents").select("doc_id", text.truncated(F.col("text"), 700, "...").alias("abstract"))


# --- transcripts and scores -------------------------------------------------------------------------


@query("SELECT conv_id, coalesce(arg_max(text, turn) FILTER (WHERE role = 'assistant'), '') AS text FROM conversations GROUP BY conv_id")
def last_assistant(spark, d):
    return transcript.last_assistant(t(spark, d, "conversations"), "conv_id", "turn", "role", "text")


@query("SELECT conv_id, count(*) AS n, string_agg(role || ':' || length(text), '|' ORDER BY turn) AS messages FROM conversations GROUP BY conv_id")
def turns_to_messages(spark, d):
    rows = t(spark, d, "conversations").groupBy("conv_id").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("m"))
    return rows.select("conv_id", "n", F.array_join(F.transform("m", lambda x: F.concat(x["role"], F.lit(":"), F.char_length(x["text"]).cast("string"))), "|").alias("messages"))


@query("SELECT event_id, json_extract(props, '$.k')::BIGINT AS k FROM events")
def props_json(spark, d):
    return t(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"))


def _transcripts(spark, d):
    c = F.col
    call = F.concat(F.lit('thinking <tool_call> {"name": "look", "arguments": {"q": "'), c("p_brand"), F.lit('"}} </tool_call>\n{"completion": "success", "status": "ok", "data": {"smiles": ["X"]}}\n'))
    answer = F.concat(F.lit('So: {"smiles": [" '), c("p_brand"), F.lit('", "'), c("p_type"), F.lit('", ""]} done'))
    twice = F.concat(F.lit('first {"smiles": ["'), c("p_name"), F.lit('"]} then '), answer)
    body = F.when(c("p_size") % 5 == 0, twice).when(c("p_size") % 5 == 1, F.concat(F.lit('note {"n": 3} '), answer)).otherwise(answer)
    return t(spark, d, "part").select("p_partkey", "p_brand", "p_type", F.when(c("p_size") % 4 == 0, F.lit("I do not know")).otherwise(F.concat(F.when(c("p_size") % 2 == 0, call).otherwise(""), body)).alias("said"), "p_size")


_SAID = """WITH x AS (SELECT *, 'So: {"smiles": [" ' || p_brand || '", "' || p_type || '", ""]} done' AS answer FROM part),
s AS (SELECT p_partkey, p_size, p_brand, p_type, CASE WHEN p_size % 4 = 0 THEN 'I do not know' ELSE CASE WHEN p_size % 2 = 0 THEN 'thinking <tool_call> {"name": "look", "arguments": {"q": "' || p_brand || '"}} </tool_call>' || chr(10) || '{"completion": "success", "status": "ok", "data": {"smiles": ["X"]}}' || chr(10) ELSE '' END || CASE p_size % 5 WHEN 0 THEN 'first {"smiles": ["' || p_name || '"]} then ' || answer WHEN 1 THEN 'note {"n": 3} ' || answer ELSE answer END END AS said FROM x),
o AS (SELECT *, list_extract(regexp_extract_all(regexp_replace(said, '(?s).*</tool_call>', ''), '\\{[^{}]*"smiles"[^\\]]*\\]\\s*\\}'), -1) AS obj FROM s)"""
_ANSWERS = "coalesce(array_to_string([trim(v) FOR v IN json_extract_string(obj, '$.smiles[*]') IF trim(v) <> ''], '|'), '')"


@query(f"{_SAID} SELECT p_partkey, {_ANSWERS} AS answers, len(regexp_extract_all(said, '<tool_call>')) AS n_calls FROM o")
def extract_answer(spark, d):
    rows = _transcripts(spark, d)
    return rows.select("p_partkey", F.array_join(transcript.answer_list(F.col("said")), "|").alias("answers"), F.size(transcript.call_bodies(F.col("said"))).cast("bigint").alias("n_calls"))


@query(f"{_SAID} SELECT p_partkey, {_ANSWERS} AS answers FROM o")
def extract_answer_full(spark, d):
    return transcript.answers(_transcripts(spark, d), "said").select("p_partkey", F.array_join("answers", "|").alias("answers"))


@query(f"""{_SAID} SELECT p_partkey, CASE WHEN contains(said, '<tool_call>') THEN concat_ws('|', 'assistant:' || length(regexp_extract(said, '(?s)<tool_call>.*</tool_call>')), 'tool:' || length(trim(left(substr(said, strpos(said, '</tool_call>') + 12), strpos(substr(said, strpos(said, '</tool_call>') + 12), obj) - 1), ' ' || chr(10))), 'assistant:' || length(trim(substr(substr(said, strpos(said, '</tool_call>') + 12), strpos(substr(said, strpos(said, '</tool_call>') + 12), obj)), ' ' || chr(10)))) ELSE 'assistant:' || length(said) END AS turns FROM o""")
def rebuild_turns(spark, d):
    said = F.transform("turns", lambda x: F.concat_ws(":", x["role"], F.char_length(x["content"]).cast("string")))
    return transcript.turns(_transcripts(spark, d), "said").select("p_partkey", F.array_join(said, "|").alias("turns"))


@query("""WITH c AS (SELECT l_orderkey AS k, list(l_partkey ORDER BY l_linenumber, l_partkey) AS cs, max(l_partkey) AS truth, count(*) FILTER (WHERE l_returnflag = 'R') AS bad, bool_or(l_linestatus = 'O') AS wrong, (count(*) * 3)::INT AS calls FROM lineitem GROUP BY 1),
o AS (SELECT k, truth, bad, wrong, calls, [cs[i] FOR i IN range(1, len(cs) + 1) IF list_position(cs, cs[i]) = i] AS cs FROM c),
r AS (SELECT *, list_position(cs, truth) AS rank FROM o)
SELECT k, rank::INT AS rank, round(0.7::DOUBLE * coalesce(pow(0.8::DOUBLE, rank - 1), 0) - 0.1::DOUBLE * bad - 0.1::DOUBLE * CASE WHEN wrong THEN 1 ELSE 0 END - 0.01::DOUBLE * greatest(calls - 8, 0), 9) + 0.0 AS score FROM r""")
def reward_score(spark, d):
    rows = t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))), lambda x: x["l_partkey"]).alias("cs"), F.max("l_partkey").alias("truth"), F.count_if(F.col("l_returnflag") == "R").alias("bad"), F.bool_or(F.col("l_linestatus") == "O").alias("wrong"), (F.count("*") * 3).cast("int").alias("calls")
    )
    rank = reward.rank_of(F.col("cs"), F.col("truth"))
    return rows.select("k", rank.cast("int").alias("rank"), (F.round(reward.score_columns(rank, F.col("bad"), F.col("wrong"), F.col("calls"))["score"], 9) + 0.0).alias("score"))


@query(f"""{_SAID}, r AS (SELECT p_partkey, list_position([trim(v) FOR v IN json_extract_string(obj, '$.smiles[*]') IF trim(v) <> ''], p_type) AS rank, len(regexp_extract_all(said, '<tool_call>')) AS n, contains(said, '<tool_call>') AND p_size % 3 = 0 AS bad FROM o)
SELECT p_partkey, rank::INT AS rank, round(0.7::DOUBLE * coalesce(pow(0.8::DOUBLE, rank - 1), 0) - 0.1::DOUBLE * bad::INT, 9) + 0.0 AS score, n::INT AS n_calls, bad::INT AS bad_calls FROM r""")
def score_rollouts(spark, d):
    schema = {"name": "look", "parameters": {"type": "object", "properties": {"q": {"type": "string"}}, "required": ["q"], "additionalProperties": False}}
    rows = _transcripts(spark, d).withColumn("said", F.when(F.col("p_size") % 3 == 0, F.replace("said", F.lit('{"q"'), F.lit('{"p"'))).otherwise(F.col("said")))
    return reward.score_rollouts(rows, "said", "p_type", "p_partkey", [schema]).select("p_partkey", "rank", (F.round("score", 9) + 0.0).alias("score"), "n_calls", "bad_calls")


def _samples(spark, d):
    rows = t(spark, d, "conversations").groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))), lambda x: F.struct(x["role"].alias("role"), x["text"].alias("content"))).alias("turns"))
    return rows.select(F.col("conv_id").alias("sample_id"), F.col("conv_id").alias("source_sample_id"), F.concat(F.lit(" C"), F.col("conv_id")).alias("gt_smiles"), "turns")


@query("""WITH u AS (SELECT conv_id, list(text ORDER BY turn) FILTER (WHERE role = 'user') AS us FROM conversations GROUP BY conv_id), i AS (SELECT *, row_number() OVER (ORDER BY conv_id) - 1 AS idx FROM u)
SELECT conv_id AS sample_id, idx::BIGINT AS index, 'C' || conv_id AS ground_truth, (len(us) + 1)::INT AS n_prompt, us[1] AS first_user, array_to_string(us[2:], '|') AS followups FROM i WHERE len(us) > 0""")
def compile_artifacts(spark, d):
    rows = artifacts.compile_samples(_samples(spark, d), "train", on_error="drop")
    return rows.select("extra_info.sample_id", "extra_info.index", "reward_model.ground_truth", F.size("prompt").alias("n_prompt"), F.element_at("raw_prompt", 2)["content"].alias("first_user"), F.array_join("extra_info.interaction_kwargs.followup_turns", "|").alias("followups"))


@query("""WITH u AS (SELECT conv_id, turn, text FROM conversations WHERE role = 'user' AND trim(text) <> ''), s AS (SELECT conv_id, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1)::INT AS step, text AS content, FALSE AS done FROM u),
e AS (SELECT conv_id, count(*) FILTER (WHERE role = 'user' AND trim(text) <> '')::INT AS step, '' AS content, TRUE AS done FROM conversations GROUP BY conv_id) SELECT * FROM s UNION ALL SELECT * FROM e""")
def followup_replay(spark, d):
    said = F.transform(F.filter("turns", lambda x: x["role"] == "user"), lambda x: x["content"])
    return replay.replay(_samples(spark, d).select(F.col("sample_id").alias("conv_id"), said.alias("followups")), "conv_id", "followups")


@query("""WITH e AS (SELECT user_id, event_id, event_type = 'error' AS failed FROM events), i AS (SELECT *, sum(CASE WHEN failed THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY event_id) AS isl FROM e),
s AS (SELECT *, sum(failed::INT) OVER (PARTITION BY user_id, isl ORDER BY event_id) AS streak FROM i)
SELECT user_id, event_id, streak::BIGINT AS streak, streak > 0 AND streak % 3 = 0 AS warn, NOT failed AND coalesce(lag(streak) OVER (PARTITION BY user_id ORDER BY event_id), 0) > 0 AS recovered FROM s""")
def failure_streaks(spark, d):
    rows = t(spark, d, "events").select("user_id", "event_id", (F.col("event_type") == "error").alias("failed"))
    return replay.failure_streaks(rows, "user_id", ["event_id"], "failed").select("user_id", "event_id", "streak", "warn", "recovered")


@query("SELECT event_id AS index, value AS score FROM events WHERE value BETWEEN 20 AND 60")
def trajectory_filter(spark, d):
    return artifacts.select_trajectories(t(spark, d, "events").select(F.col("event_id").alias("index"), F.col("value").alias("score")), 20, 60, "-score")[0]


@query("SELECT count(*) AS total, count(*) FILTER (WHERE value BETWEEN 20 AND 60) AS shown FROM events")
def trajectory_counts(spark, d):
    return artifacts.select_trajectories(t(spark, d, "events").select(F.col("event_id").alias("index"), F.col("value").alias("score")), 20, 60)[1]


# --- vectors ----------------------------------------------------------------------------------------


@query("WITH x AS (SELECT vec_id, i - 1 AS dim, embedding[i]::DOUBLE AS v FROM embeddings, (SELECT unnest(range(1, 65)) AS i)), s AS (SELECT dim, avg(v) AS m, stddev_pop(v) AS s FROM x GROUP BY dim) SELECT vec_id, dim::INT AS dim, round(CASE WHEN s > 0 THEN (v - m) / s ELSE 0 END, 6) AS value FROM x JOIN s USING (dim)")
def standardize(spark, d):
    rows = t(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    return cluster.standardize(rows, "vec_id", "v").select("vec_id", "dim", F.round("value", 6).alias("value"))


@query("""WITH x AS (SELECT vec_id, label, i, embedding[i]::DOUBLE AS v FROM embeddings, (SELECT unnest(range(1, 65)) AS i)), c AS (SELECT label, i, avg(v) AS m FROM x GROUP BY 1, 2),
s AS (SELECT label, vec_id, round(sqrt(sum((v - m) * (v - m))), 9) AS dd FROM x JOIN c USING (label, i) GROUP BY 1, 2)
SELECT label, (array_agg(vec_id ORDER BY dd, vec_id))[1] AS vec_id, round(min(dd), 6) AS distance FROM s GROUP BY label""")
def centroid_representative(spark, d):
    rows = t(spark, d, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))
    return cluster.representatives(rows, "label", "vec_id", "v").select("label", "vec_id", F.round("distance", 6).alias("distance"))


@query()
def kmeans_assign(spark, d):
    return cluster.kmeans(t(spark, d, "embeddings"), "vec_id", "embedding", 10)


@query()
def svd_projection(spark, d):
    return cluster.svd_projection(t(spark, d, "embeddings"), "vec_id", "embedding").select("vec_id", F.round(F.col("point")[0], 6).alias("x"), F.round(F.col("point")[1], 6).alias("y"))
