"""Writing: record files, caches and artifacts."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def write_jsonl(df: DataFrame, path: str, ignore_nulls: bool = True) -> int:
    """JSON lines (UTF-8, other scripts kept); returns the number of rows, counted while writing."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").option("ignoreNullFields", str(ignore_nulls).lower()).json(path)
    return int(seen.get["n"])


def write_parquet(df: DataFrame, path: str) -> int:
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
    return int(seen.get["n"])


def write_as(df: DataFrame, path: str) -> int:
    """By suffix: parquet or pq, jsonl or json."""
    kind = path.rsplit(".", 1)[-1].lower()
    if kind in ("parquet", "pq"):
        return write_parquet(df, path)
    if kind in ("jsonl", "json"):
        return write_jsonl(df, path)
    raise ValueError(f"unsupported output format: {path}")


def publish(df: DataFrame, path: str) -> None:
    """Written beside the target, then put in its place; a table may replace itself.

    The old table is moved aside first and goes only when the new one stands; a failed move brings it back, so
    no failure loses a table.
    """
    spark, mark = df.sparkSession, uuid.uuid4().hex
    beside, aside = f"{path}.{mark}.new", f"{path}.{mark}.old"
    df.write.parquet(beside)
    make = spark._jvm.org.apache.hadoop.fs.Path
    fs = make(path).getFileSystem(spark._jsc.hadoopConfiguration())
    had = fs.exists(make(path))
    if had and not fs.rename(make(path), make(aside)):
        raise OSError(f"could not move {path} aside")
    if not fs.rename(make(beside), make(path)):
        if had:
            fs.rename(make(aside), make(path))
        raise OSError(f"could not publish {path}")
    if had:
        fs.delete(make(aside), True)


def append_cache(df: DataFrame, path: str) -> None:
    """New cache entries, each with its version column."""
    df.write.mode("append").parquet(path)


def manifest(parts: dict[str, int], options: dict) -> str:
    return json.dumps({"splits": parts, "rows": sum(parts.values()), "options": options}, indent=2, sort_keys=True, ensure_ascii=False)


def yaml_text(value, indent: int = 0) -> str:
    """Plain YAML of nested dicts, lists and scalars."""
    pad = "  " * indent
    if isinstance(value, dict):
        return "".join(f"{pad}{k}: {'{}' if v == {} else '[]' if v == [] else json.dumps(v, ensure_ascii=False)}\n" if not isinstance(v, (dict, list)) or not v else f"{pad}{k}:\n{yaml_text(v, indent + 1)}" for k, v in value.items())
    if isinstance(value, list):
        return "".join(f"{pad}- {json.dumps(v, ensure_ascii=False)}\n" if not isinstance(v, (dict, list)) else f"{pad}-\n{yaml_text(v, indent + 1)}" for v in value)
    return f"{pad}{json.dumps(value, ensure_ascii=False)}\n"
