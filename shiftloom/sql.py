"""Every table and the scalar operators from plain SQL: temporary views, SQL functions that Catalyst inlines, and table functions."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .functions import transcript
from .tools.registry import Registry, register_udtf

#: Name, parameters, result and body of each SQL function; bodies are expressions, so plans stay as if written out.
FUNCTIONS = (
    ("draw_bits", "seed STRING, slot STRING, id STRING", "BIGINT", "CAST(conv(substr(md5(concat_ws(':', seed, slot, id)), 1, 8), 16, 10) AS BIGINT)"),
    ("draw", "seed STRING, slot STRING, id STRING", "DOUBLE", "CAST(conv(substr(md5(concat_ws(':', seed, slot, id)), 1, 8), 16, 10) AS BIGINT) / 4294967296.0D"),
    ("clean_text", "s STRING", "STRING", r"CASE WHEN s IS NULL OR lower(regexp_replace(s, '(?U)^\\s+|\\s+$', '')) IN ('nan', 'none', 'null') THEN '' ELSE regexp_replace(s, '(?U)^\\s+|\\s+$', '') END"),
    ("strip_tags", "s STRING", "STRING", "regexp_replace(s, '<[^>]+>', '')"),
    ("strip_atom_maps", "s STRING", "STRING", r"regexp_replace(s, ':\\d+(?=\\])', '')"),
    ("mixture", "s STRING", "ARRAY<STRING>", r"filter(split(coalesce(s, ''), '\\.'), x -> trim(x) <> '')"),
    ("call_bodies", "s STRING", "ARRAY<STRING>", r"regexp_extract_all(coalesce(s, ''), '(?is)<tool_call>\\s*(.*?)\\s*</tool_call>', 1)"),
    ("answer_rank", "candidates ARRAY<STRING>, truth STRING", "BIGINT", "nullif(array_position(array_distinct(candidates), truth), 0)"),
    ("match_reward", "rank BIGINT, discount DOUBLE", "DOUBLE", "coalesce(pow(discount, rank - 1), 0.0D)"),
    ("overlap_score", "shared DOUBLE, query_size DOUBLE, record_size DOUBLE", "DOUBLE", "0.5D * shared / query_size + 0.3D * shared / (query_size + record_size - shared) + 0.12D * shared / record_size"),
)


def register(spark: SparkSession, sf_dir: str | None = None, tables: tuple[str, ...] = (), registry: Registry | None = None) -> list[str]:
    """Registers the functions, ``split_turns`` and ``log_segments`` (and ``call_tool``), and a view for each table; returns the names."""
    from pyspark.sql.functions import udtf

    for name, parameters, kind, body in FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kind} RETURN {body}")

    class SplitTurns:
        def eval(self, text: str):
            for i, t in enumerate(transcript.split_turns(text)):
                yield i, t["role"], t["content"]

    class LogSegments:
        def eval(self, text: str):
            for i, t in enumerate(transcript.segments(text)):
                yield i, t["kind"], t["content"]

    spark.udtf.register("split_turns", udtf(SplitTurns, returnType="position int, role string, content string"))
    spark.udtf.register("log_segments", udtf(LogSegments, returnType="position int, kind string, content string"))
    names = [f[0] for f in FUNCTIONS] + ["split_turns", "log_segments"]
    if registry is not None:
        register_udtf(spark, registry)
        names.append("call_tool")
    for t in tables:
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)
        names.append(t)
    return names
