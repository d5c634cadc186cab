"""Facts by molecule: cached stages, what is pending, and coverage summaries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STAGES = ("properties", "names", "fragments", "reactions")


def latest(cache: DataFrame, key: str = "key", version: str = "version") -> DataFrame:
    """The last entry of each key (a partial aggregate)."""
    return cache.groupBy(key).agg(F.max_by(F.struct(*cache.columns), version).alias("__r")).select("__r.*")


def pending(rows: DataFrame, cache: DataFrame, needed: list[str], key: str = "key") -> DataFrame:
    """(key, missing): distinct non-empty keys whose cached stages do not cover the needed ones."""
    need = F.array(*[F.lit(s) for s in needed])
    keys = rows.where(F.coalesce(F.col(key).cast("string"), F.lit("")) != "").select(key).distinct()
    have = F.coalesce(F.col("stages"), F.array().cast("array<string>"))
    return keys.join(cache.select(key, "stages"), key, "left").withColumn("missing", F.array_except(need, have)).where(F.size("missing") > 0).select(key, "missing")


def apply_cache(rows: DataFrame, cache: DataFrame, payloads: list[str], key: str = "key") -> DataFrame:
    """Left join of the payload columns; misses get empty stages."""
    return rows.join(cache.select(key, "stages", *payloads), key, "left").withColumn("stages", F.coalesce("stages", F.array().cast("array<string>")))


def refresh(cache: DataFrame, computed: DataFrame, payloads: list[str], key: str = "key") -> DataFrame:
    """New cache entries: stages united, non-null new values over the old ones; failed look-ups count as covered."""
    old = cache.select(key, F.col("stages").alias("_s"), F.col("version").alias("_v"), *(F.col(p).alias(f"_{p}") for p in payloads))
    j = computed.join(old, key, "left")
    return j.select(key, F.array_sort(F.array_union(F.coalesce("_s", F.array().cast("array<string>")), "stages")).alias("stages"), (F.coalesce("_v", F.lit(0)) + 1).alias("version"), *(F.coalesce(p, f"_{p}").alias(p) for p in payloads))


def completion(cache: DataFrame, stages: tuple[str, ...] = STAGES) -> DataFrame:
    """(stage, completed, total, percentage): one decimal, 0 for an empty cache."""
    one = cache.select(F.explode(F.array(*[F.struct(F.lit(s).alias("stage"), F.array_contains(F.col("stages"), s).alias("done")) for s in stages])).alias("x")).select("x.*")
    counted = one.groupBy("stage").agg(F.count_if("done").alias("completed"), F.count("*").alias("total"))
    names = cache.sparkSession.createDataFrame([(s,) for s in stages], "stage string")
    out = names.join(counted, "stage", "left").select("stage", F.coalesce("completed", F.lit(0)).alias("completed"), F.coalesce("total", F.lit(0)).alias("total"))
    return out.withColumn("percentage", F.when(F.col("total") == 0, 0.0).otherwise(F.round(100.0 * F.col("completed") / F.greatest("total", F.lit(1)), 1)))


def coverage(rows: DataFrame, cache: DataFrame, key: str = "key") -> DataFrame:
    """Rows, distinct keys, hits and misses against the cache."""
    j = rows.select(key).join(cache.select(key, F.lit(True).alias("_hit")), key, "left")
    return j.agg(F.count("*").alias("n_rows"), F.countDistinct(key).alias("n_keys"), F.count_if("_hit").alias("n_hits"), F.count_if(F.col("_hit").isNull()).alias("n_misses"))


def recompute(rows: DataFrame, cache: DataFrame, needed: list[str], compute: Callable[[DataFrame], DataFrame], payloads: list[str], key: str = "key") -> tuple[DataFrame, DataFrame]:
    """(rows with payloads, new cache entries): only keys that lack a needed stage are computed, each once.

    ``compute`` takes (key, missing) and returns the key and payload columns; a key that it leaves out counts as looked up.
    """
    todo = pending(rows, cache, needed, key)
    got = todo.join(compute(todo), key, "left").withColumn("stages", F.array(*[F.lit(s) for s in needed]))
    new = refresh(cache, got, payloads, key)
    whole = cache.join(new.select(key), key, "left_anti").unionByName(new)
    return apply_cache(rows, whole, payloads, key), new
