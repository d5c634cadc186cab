"""The queries over the driver tables and their SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with the SQL that must agree with it."""

    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE_SQL[fn.__name__] = sql
        return fn

    return add


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The draw of a row in DuckDB: DRAW.format("seed", "slot", "id").
DRAW = "(('0x' || substr(md5('{}:{}:' || ({})::VARCHAR), 1, 8))::BIGINT)"
