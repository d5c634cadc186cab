"""Queries of sources and sinks: tables written in a format to the shared folder and read back by the operator."""

from __future__ import annotations

from pyspark.sql import functions as F

from .catalog import query, t
from .functions.clean import CSV_MISSING
from .operators import dataset
from .plans import compile as artifacts
from .plans.shared import place
from .sources import remote, sinks, tables

_GONE = ", ".join(f"'{m}'" for m in CSV_MISSING)


@query("SELECT p_partkey, p_name, (row_number() OVER (ORDER BY p_partkey) - 1)::BIGINT AS row_index FROM part")
def scan_parquet(spark, d):
    return tables.export(spark, f"{d}/part.parquet").select("p_partkey", "p_name", "row_index")


@query(f"SELECT doc_id::VARCHAR AS doc_id, CASE WHEN text NOT IN ({_GONE}) THEN text END AS text, CASE WHEN lang NOT IN ({_GONE}) THEN lang END AS lang, (row_number() OVER (ORDER BY doc_id) - 1)::BIGINT AS row_index FROM documents")
def scan_csv(spark, d):
    path = place(spark, "export") + ".csv"
    rows = t(spark, d, "documents").select("doc_id", "text", "lang").orderBy("doc_id").coalesce(1)
    rows.write.option("header", True).option("escape", '"').csv(path)
    return tables.export(spark, path)


@query("SELECT c_custkey::VARCHAR AS c_custkey, '客户' || c_name AS name, (row_number() OVER (ORDER BY c_custkey) - 1)::BIGINT AS row_index FROM customer")
def scan_csv_gb18030(spark, d):
    path = place(spark, "export") + ".csv"
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    rows = t(spark, d, "customer").select("c_custkey", F.concat(F.lit("客户"), "c_name").alias("name")).orderBy("c_custkey").coalesce(1)
    rows.write.option("header", True).option("encoding", "GB18030").csv(path)
    return tables.export(spark, path)


@query("SELECT conv_id, turn, role, text FROM conversations")
def scan_jsonl(spark, d):
    path = place(spark, "records") + ".jsonl"
    sinks.write_jsonl(t(spark, d, "conversations"), path)
    return tables.jsonl(spark, path, "conv_id bigint, turn bigint, role string, text string")


@query("SELECT count(*) AS written FROM conversations")
def write_counts(spark, d):
    path = place(spark, "records")
    n = sinks.write_as(t(spark, d, "conversations"), path + ".jsonl")
    return tables.jsonl(spark, path + ".jsonl", "conv_id bigint").agg(F.count("*").alias("read")).where(F.col("read") == n).select(F.col("read").alias("written"))


@query("WITH p AS (SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id, turn) - 1 AS i FROM conversations) SELECT i::BIGINT AS row_id, conv_id, turn FROM p WHERE i IN (0, 7, 19)")
def jsonl_positions(spark, d):
    path = place(spark, "records") + ".jsonl"
    sinks.write_jsonl(t(spark, d, "conversations").orderBy("conv_id", "turn").coalesce(1), path)
    return tables.at_positions(spark, path, "conv_id bigint, turn bigint", [0, 7, 19])


@query("SELECT event_id, user_id, event_type FROM events")
def strict_jsonl(spark, d):
    path = place(spark, "strict") + ".jsonl"
    sinks.write_jsonl(t(spark, d, "events").select("event_id", "user_id", "event_type"), path)
    return tables.strict_jsonl(spark, path, "event_id bigint, user_id bigint, event_type string")


@query("WITH e AS (SELECT user_id, event_id, event_type FROM events WHERE event_id % 3 <> 0) SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM e GROUP BY user_id")
def tolerant_cache(spark, d):
    path = place(spark, "cache") + ".jsonl"
    c = F.col
    line = F.when(c("event_id") % 3 == 0, F.concat(F.lit('{"user_id": '), c("user_id"), F.lit(', "event_'))).otherwise(F.to_json(F.struct("user_id", "event_id", "event_type")))
    t(spark, d, "events").orderBy("event_id").coalesce(1).select(line.alias("value")).write.text(path)
    return tables.tolerant_cache(spark, path, "user_id bigint, event_id bigint, event_type string", "user_id")


@query("SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS record, p_brand || '|' || p_type AS reactants, p_name AS products FROM part")
def scan_reactions_csv(spark, d):
    path = place(spark, "reactions") + ".csv"
    rows = t(spark, d, "part").orderBy("p_partkey").coalesce(1).select(F.concat("p_brand", F.lit(". ."), "p_type").alias("reactant"), F.col("p_name").alias("product"))
    rows.write.option("header", True).csv(path)
    return tables.reactions_csv(spark, path).select("record", F.array_join("reactants", "|").alias("reactants"), F.array_join("products", "|").alias("products"))


@query("WITH p AS (SELECT *, row_number() OVER (ORDER BY p_partkey) - 1 AS record FROM part) SELECT record, '[CH3]' || p_size || '|' || 'O' AS reactants, 'A' || p_size AS agents, replace(p_brand, '#', '') AS products, p_name AS reference, p_type AS class_name FROM p WHERE p_size % 4 <> 0 AND record < 500")
def scan_reactions_text(spark, d):
    path = place(spark, "reactions")
    c = F.col
    reaction = F.concat(F.lit("[CH3:"), c("p_partkey"), F.lit("]"), c("p_size"), F.lit(".O>A"), c("p_size"), F.lit(">"), F.replace("p_brand", F.lit("#"), F.lit("")), F.lit(" |f:0|"))
    line = F.when(c("p_size") % 4 == 0, F.lit("broken line")).otherwise(F.concat_ws("\t", reaction, "p_name", F.lit("-"), F.lit("1.1"), "p_type"))
    t(spark, d, "part").orderBy("p_partkey").coalesce(1).select(line.alias("value")).write.text(path)
    rows = tables.first_records(tables.reactions_text(spark, path), 500)
    return rows.select("record", F.array_join("reactants", "|").alias("reactants"), F.array_join("agents", "|").alias("agents"), F.array_join("products", "|").alias("products"), "reference", "class_name")


@query("SELECT record, 'C' || p_size || '|' || 'O' AS reactants, 'N' || p_partkey AS products FROM (SELECT *, row_number() OVER (ORDER BY p_partkey) - 1 AS record FROM part) WHERE p_size % 3 <> 0")
def scan_reactions_embedded(spark, d):
    path = place(spark, "reactions")
    c = F.col
    text = F.when(c("p_size") % 3 == 0, "nothing here").otherwise(F.concat(c("p_name"), F.lit(" see C"), c("p_size"), F.lit(".O>>N"), c("p_partkey"), F.lit(", and "), c("p_type")))
    t(spark, d, "part").orderBy("p_partkey").coalesce(1).select(text.alias("text"), "p_name").write.parquet(path)
    return tables.reactions_embedded(spark, path).select("record", F.array_join("reactants", "|").alias("reactants"), F.array_join("products", "|").alias("products"))


@query("SELECT 'run' || (event_id % 3) AS run, count(*) AS n, sum(event_id)::BIGINT AS steps FROM events WHERE event_id % 4 <> 0 GROUP BY 1")
def scan_trajectories(spark, d):
    root = place(spark, "logs")
    for k in range(3):
        line = F.when(F.col("event_id") % 4 == 0, F.lit("not json")).otherwise(F.to_json(F.struct(F.col("event_type").alias("input"), F.col("value").alias("score"), F.col("event_id").alias("step"))))
        path = f"{root}/deep/run{k}"
        t(spark, d, "events").where(F.col("event_id") % 3 == k).coalesce(1).select(line.alias("value")).write.text(f"{path}.text")
        make = spark._jvm.org.apache.hadoop.fs.Path
        fs = make(path).getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(make(path))
        for i, f in enumerate(x for x in fs.listStatus(make(f"{path}.text")) if x.getPath().getName().startswith("part-")):
            fs.rename(f.getPath(), make(f"{path}/log{i}.jsonl"))
    return tables.trajectories(spark, root, artifacts.TRAJECTORY).groupBy("run").agg(F.count("*").alias("n"), F.sum("step").alias("steps"))


@query("SELECT (i * 3)::BIGINT AS row_id, i::BIGINT AS id, 'v' || i AS name FROM range(0, 1) r(i) UNION ALL SELECT 1, 4, NULL UNION ALL SELECT 2, NULL, 'z'")
def in_memory(spark, d):
    return dataset.in_memory(spark, [{"id": 0, "name": "v0", "other": 1}, {"id": 4}, {"name": "z"}], "id bigint, name string")


@query("SELECT c_custkey, c_name, 2 AS built FROM customer")
def load_or_build(spark, d):
    path, calls = place(spark, "truth"), []
    build = lambda: calls.append(1) or t(spark, d, "customer").select("c_custkey", "c_name")
    for force in (False, False, True):
        rows = tables.load_or_build(spark, path, build, force)
    return rows.withColumn("built", F.lit(len(calls)))


@query("SELECT s_suppkey, s_name, s_acctbal * 2 AS s_acctbal FROM supplier")
def publish_over_itself(spark, d):
    path = place(spark, "table")
    sinks.publish(t(spark, d, "supplier"), path)
    sinks.publish(spark.read.parquet(path).withColumn("s_acctbal", F.col("s_acctbal") * 2), path)
    return spark.read.parquet(path).select("s_suppkey", "s_name", "s_acctbal")


@query("SELECT o_custkey AS key, max(o_orderkey) AS version, arg_max(o_orderstatus, o_orderkey) AS status FROM orders GROUP BY o_custkey")
def append_cache(spark, d):
    from .operators import enrich

    path = place(spark, "cache")
    for k in range(3):
        sinks.append_cache(t(spark, d, "orders").where(F.col("o_orderkey") % 3 == k).select(F.col("o_custkey").alias("key"), F.col("o_orderkey").alias("version"), F.col("o_orderstatus").alias("status")), path)
    return enrich.latest(spark.read.parquet(path))


@query("SELECT conv_id, count(*) FILTER (WHERE role = 'user') AS n_user, string_agg(text, '|' ORDER BY turn) FILTER (WHERE role = 'user') AS said FROM conversations GROUP BY conv_id HAVING count(*) FILTER (WHERE role = 'user') > 0")
def artifact_files(spark, d):
    rows = t(spark, d, "conversations").groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))), lambda x: F.struct(x["role"].alias("role"), x["text"].alias("content"))).alias("turns"))
    made = artifacts.compile_samples(rows.select(F.col("conv_id").alias("sample_id"), F.col("conv_id").alias("source_sample_id"), F.lit("C").alias("gt_smiles"), "turns"), "train", on_error="drop")
    nested, lines = place(spark, "artifacts") + ".parquet", place(spark, "artifacts") + ".jsonl"
    sinks.write_as(made, nested)
    sinks.write_as(made, lines)
    a = spark.read.parquet(nested)
    b = spark.read.schema(a.schema).json(lines)
    both = a.select("extra_info.sample_id", F.slice("prompt", 2, 1000).alias("u")).join(b.select("extra_info.sample_id", F.slice("prompt", 2, 1000).alias("v")), "sample_id").where("u = v")
    return both.select(F.col("sample_id").alias("conv_id"), F.size("u").cast("bigint").alias("n_user"), F.array_join(F.transform("u", lambda x: x["content"]), "|").alias("said"))


@query("SELECT n_regionkey, count(*) AS n, '{\"rows\": ' || count(*) || '}' AS manifest, 'rows: ' || count(*) || chr(10) AS yaml FROM nation GROUP BY n_regionkey")
def emitters(spark, d):
    import json

    rows = t(spark, d, "nation").groupBy("n_regionkey").agg(F.count("*").alias("n")).collect()  # five regions
    made = [(r["n_regionkey"], r["n"], json.dumps({"rows": json.loads(sinks.manifest({"train": r["n"]}, {}))["rows"]}), sinks.yaml_text({"rows": r["n"]})) for r in rows]
    return spark.createDataFrame(made, "n_regionkey int, n bigint, manifest string, yaml string")


@query("SELECT event_id, 'ok' AS status, (value * 2)::DOUBLE AS doubled FROM events WHERE event_id % 5 <> 0 UNION ALL SELECT event_id, 'error', NULL FROM events WHERE event_id % 5 = 0")
def remote_fan_out(spark, d):
    def service(row):
        return {"status": "error", "data": None} if row["event_id"] % 5 == 0 else {"status": "ok", "data": {"x": row["value"] * 2}}

    rows = remote.fan_out(t(spark, d, "events").select("event_id", "value"), service, ["event_id", "value"])
    return rows.select("event_id", F.get_json_object("answer", "$.status").alias("status"), F.get_json_object("answer", "$.data.x").cast("double").alias("doubled"))
