"""Record datasets: views by position, keyed sampling and splits. Rows carry a unique total order column.

Random operations order rows by a keyed hash, so they need no driver state and give the same rows
under any partitioning. A cut after a total order is a top-k; positions come from row_number only
where the position itself is asked for.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from ..functions.draws import draw_bits
from ..plans.shared import checkpointed


def in_memory(spark, records: Sequence[dict], schema: str) -> DataFrame:
    """Records as a dataset; ``row_id`` is their position."""
    fields = T._parse_datatype_string(schema).fields
    rows = [(i, *(r.get(f.name) for f in fields)) for i, r in enumerate(records)]
    return spark.createDataFrame(rows, T.StructType([T.StructField("row_id", T.LongType(), False), *fields]))


def positions(df: DataFrame, order: Sequence[str], name: str = "row_id") -> DataFrame:
    """Adds 0-based positions in a total order without gathering rows in one task.

    Rows are range-partitioned, sorted and stored with their partition and place once; the counts of
    partitions (a row each) give the offsets. Bounds of a range partitioning are sampled, so rows that were
    partitioned anew for the count and for the numbering would not agree; stored rows do.
    """
    spark = df.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id())
    ranged = checkpointed(ranged.withColumn("__within", F.monotonically_increasing_id() - F.shiftleft(F.col("__part").cast("bigint"), 33)))
    sizes, offsets, total = ranged.groupBy("__part").agg(F.count("*").alias("n")).collect(), [], 0
    for r in sorted(sizes, key=lambda r: r["__part"]):
        offsets.append((r["__part"], total))
        total += r["n"]
    lookup = spark.createDataFrame(offsets, "__part int, __before bigint")  # a row a partition
    return ranged.join(F.broadcast(lookup), "__part").withColumn(name, (F.col("__before") + F.col("__within")).cast("bigint")).drop("__part", "__within", "__before")


#: Cuts up to this many rows are a distributed top-k; larger ones are numbered, so no task holds the cut.
TOP_K = 20_000


def first_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The first n rows of a total order, whatever n."""
    if n <= TOP_K:
        return df.orderBy(*order).limit(n)
    return positions(df, order, "__place").where(F.col("__place") < n).drop("__place")


def head(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The first n rows of a total order (a distributed top-k); n beyond the size gives all."""
    if n < 0:
        raise ValueError("n must not be negative")
    return first_rows(df, n, order)


take = head


def select(df: DataFrame, indices: Sequence[int], position: str = "row_id") -> DataFrame:
    """Rows by position in the order of ``indices``, repeats allowed; negative ones count from the end.

    An index out of range raises. The index list is the caller's own, so it is broadcast.
    """
    size = df.agg(F.coalesce(F.max(position) + 1, F.lit(0)).alias("n")).first()["n"] if any(i < 0 for i in indices) or indices else 0
    wanted = [i + size if i < 0 else i for i in indices]
    if any(not 0 <= i < size for i in wanted):
        raise IndexError("dataset index out of range")
    if not wanted:
        return df.limit(0).withColumn("pos", F.lit(0).cast("bigint"))
    view = df.sparkSession.createDataFrame(list(enumerate(wanted)), "pos bigint, _at bigint")
    return df.where(F.col(position).isin(sorted(set(wanted)))).join(F.broadcast(view), F.col(position) == F.col("_at")).drop("_at").orderBy("pos")


def item(df: DataFrame, index: int, position: str = "row_id") -> DataFrame:
    return select(df, [index], position).drop("pos")


def slice_rows(df: DataFrame, start: int, stop: int, position: str = "row_id") -> DataFrame:
    return df.where(F.col(position).between(start, stop - 1))


def shuffle(df: DataFrame, seed: int | str, key: str) -> DataFrame:
    """A permutation by keyed hash."""
    return df.orderBy(draw_bits(seed, "shuffle", F.col(key)), key)


def sample(df: DataFrame, num: int, seed: int | str, key: str, cluster: str | None = None) -> DataFrame:
    """``num`` rows, balanced over clusters: equal quotas, spare capacity dealt to the larger clusters.

    Rows rank within their cluster by a keyed hash; a cut of (rank, hash) over all rows is exactly
    the equal-quota rule, and each cluster only ever keeps its first ``num``. One missing label anywhere
    makes the sample uniform; a negative size raises.
    """
    if num < 0:
        raise ValueError("sample size must not be negative")
    drawn = df.withColumn("__h", draw_bits(seed, "sample", F.col(key)))
    if cluster is None or not df.where(F.col(cluster).isNull()).isEmpty():
        return first_rows(drawn, num, ["__h", key]).drop("__h")
    ranked = drawn.withColumn("__r", F.row_number().over(W.partitionBy(cluster).orderBy("__h", key))).where(F.col("__r") <= num)
    return first_rows(ranked, num, ["__r", "__h", key]).drop("__h", "__r")


def balanced_cut(df: DataFrame, most: int, seed: int | str, key: str, cluster: str) -> DataFrame:
    """At most ``most`` rows for a plot: max(most // k, 1) a cluster first, the rest at random."""
    k = df.select(cluster).distinct().count()
    quota = max(most // max(k, 1), 1)
    drawn = df.withColumn("__h", draw_bits(seed, "cut", F.col(key)))
    ranked = drawn.withColumn("__r", F.row_number().over(W.partitionBy(cluster).orderBy("__h", key))).where(F.col("__r") <= max(most, quota))
    later = ranked.withColumn("__later", (F.col("__r") > quota).cast("int"))
    return first_rows(later, most, ["__later", "__h", key]).drop("__h", "__r", "__later")


def disjoint_splits(df: DataFrame, sizes: dict[str, int], seed: int | str, key: str) -> DataFrame:
    """Adds ``split``: contiguous windows of one keyed shuffle; rows beyond the last window go.

    A pool smaller than the windows raises. Only rows below a draw that surely holds the windows are
    sorted: the draw is uniform, so the bound is the windows' share of the pool and a margin, raised until
    enough rows are below it.
    """
    need, total = sum(sizes.values()), df.count()
    if total < need:
        raise ValueError(f"the pool holds fewer than the {need} rows that the splits need")
    drawn, bound = df.withColumn("__h", draw_bits(seed, "split", F.col(key))), 1.0
    if need * 4 < total:
        bound = 1.1 * need / total + 1000 / total
        while bound < 1 and drawn.where(F.col("__h") < int(bound * 2**32)).count() < need:
            bound *= 2
    cut = drawn.where(F.col("__h") < int(bound * 2**32)) if bound < 1 else drawn
    cut = positions(cut, ["__h", key], "__i").where(F.col("__i") < need)
    name, at = None, 0
    for split, size in sizes.items():
        at += size
        name = F.when(F.col("__i") < at, split) if name is None else name.when(F.col("__i") < at, split)
    return cut.withColumn("split", name).drop("__h", "__i")


def where(df: DataFrame, predicate: Column | Callable[[dict], bool]) -> DataFrame:
    """A Column stays in the engine; a Python predicate runs on Arrow batches."""
    if isinstance(predicate, Column):
        return df.where(predicate)

    def run(batches):
        for pdf in batches:
            yield pdf[[bool(predicate(r)) for r in pdf.to_dict("records")]]

    return df.mapInPandas(run, df.schema)


def map_rows(df: DataFrame, fn: Callable[[dict], dict], schema: str) -> DataFrame:
    """A Python function of records, batch by batch."""
    import pandas as pd

    names = T._parse_datatype_string(schema).names

    def run(batches):
        for pdf in batches:
            yield pd.DataFrame([fn(r) for r in pdf.to_dict("records")], columns=names)

    return df.mapInPandas(run, schema)


def sizes(df: DataFrame, cluster: str) -> DataFrame:
    return df.groupBy(cluster).agg(F.count("*").alias("n_rows"))


def union_sources(parts: Sequence[DataFrame]) -> DataFrame:
    """All sources under one another with their order number; columns missing in one are null."""
    out = None
    for i, p in enumerate(parts):
        p = p.withColumn("source_ord", F.lit(i))
        out = p if out is None else out.unionByName(p, allowMissingColumns=True)
    return out


def histogram(df: DataFrame, value: Column | str) -> DataFrame:
    """(value as text, n), by value."""
    v = F.col(value) if isinstance(value, str) else value
    return df.groupBy(v.cast("string").alias("value")).agg(F.count("*").alias("n"))


def check_labels(df: DataFrame, cluster: str) -> bool:
    """Whether every row has a cluster."""
    return bool(df.agg(F.coalesce(F.bool_and(F.col(cluster).isNotNull()), F.lit(True)).alias("ok")).first()["ok"])
