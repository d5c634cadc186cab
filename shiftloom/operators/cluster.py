"""Clustering of feature vectors: standardisation, k-means, representatives and projections."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def moments(df: DataFrame, vector: str) -> tuple[list[float], list[float]]:
    """Means and population deviations of the dimensions: one row of aggregates."""
    width = df.agg(F.max(F.size(vector)).alias("n")).first()["n"] or 0
    x = [F.get(F.col(vector), F.lit(i)).cast("double") for i in range(width)]
    row = df.agg(*[F.avg(c) for c in x], *[F.stddev_pop(c) for c in x]).first() if width else ()
    return [float(v or 0.0) for v in row[:width]], [float(v or 0.0) for v in row[width:]]


def standardized(vector: Column, means: list[float], deviations: list[float]) -> Column:
    """(x - mean) / deviation for each dimension; constant dimensions give 0."""
    m, s = (F.array(*[F.lit(v) for v in values]) for values in (means, deviations))
    return F.transform(vector, lambda x, i: F.when(F.get(s, i) > 0, (x - F.get(m, i)) / F.get(s, i)).otherwise(0.0))


def standardize(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, dim, value): standardised with fitted means and population deviations, no shuffle of the vectors."""
    return df.select(key, F.posexplode(standardized(F.col(vector), *moments(df, vector))).alias("dim", "value"))


def l2_normalized(v: Column) -> Column:
    """Divided by its norm, which counts as 1 at least."""
    n = F.greatest(F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x)), F.lit(1.0))
    return F.transform(v, lambda x: x / n)


def joined_features(bits: Column, properties: Column, weight: float = 0.35) -> Column:
    """Normalised fingerprint followed by weighted properties."""
    return F.concat(l2_normalized(bits), F.transform(properties, lambda x: x * weight))


def packed_bits(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits.astype(bool), axis=1)


def unpacked_bits(packed: np.ndarray, width: int) -> np.ndarray:
    return np.unpackbits(packed, axis=1)[:, :width]


def centroids(df: DataFrame, group: str, vector: str) -> DataFrame:
    """(group, centroid): means of all dimensions in one partial aggregate a group; null vectors are left out."""
    valid = df.where(F.col(vector).isNotNull())
    width = valid.agg(F.max(F.size(vector)).alias("n")).first()["n"] or 0
    means = [F.avg(F.get(F.col(vector), F.lit(i))) for i in range(width)]
    return valid.groupBy(group).agg(F.array(*means).cast("array<double>").alias("centroid"))


def distance(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))


def representatives(df: DataFrame, group: str, key: str, vector: str) -> DataFrame:
    """(group, key, distance): the row nearest its centroid; the first on ties (distances to nine digits)."""
    from ..plans.sizes import small_side

    near = df.join(small_side(centroids(df, group, vector)), group).withColumn("d", F.round(distance(F.col(vector), F.col("centroid")), 9))
    return near.groupBy(group).agg(F.min_by(key, F.struct("d", key)).alias(key), F.min("d").alias("distance"))


def kmeans(df: DataFrame, key: str, vector: str, k: int, seed: int = 7, steps: int = 20) -> DataFrame:
    """(key, cluster): k is at most the number of valid rows; rows without a vector get -1; no valid row raises."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    valid = df.where(F.col(vector).isNotNull())
    n = valid.count()
    if not n:
        raise ValueError("no row has a valid vector")
    points = valid.select(key, array_to_vector(F.col(vector).cast("array<double>")).alias("features"))
    model = KMeans(k=min(k, n), seed=seed, maxIter=steps).fit(points) if min(k, n) > 1 else None
    labels = model.transform(points).select(key, F.col("prediction").alias("_c")) if model else valid.select(key, F.lit(0).alias("_c"))
    return df.select(key).join(labels, key, "left").select(key, F.coalesce("_c", F.lit(-1)).alias("cluster"))


def svd_projection(df: DataFrame, key: str, vector: str, dims: int = 2) -> DataFrame:
    """(key, point): truncated, uncentred SVD; the sign of each axis makes its largest component positive."""
    if dims not in (2, 3):
        raise ValueError("dims must be 2 or 3")
    # the small side of the matrix, X'X: each batch gives its cells, which are summed by cell
    valid = df.where(F.col(vector).isNotNull())

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0.0
        for b in batches:
            lists = b.column("v")
            if len(lists):
                x = np.asarray(lists.flatten(), dtype=np.float64).reshape(len(lists), -1)
                total = total + x.T @ x
        if not np.isscalar(total):
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["cell", "value"])

    found = valid.select(F.col(vector).cast("array<double>").alias("v")).mapInArrow(cells, "cell bigint, value double").groupBy("cell").agg(F.sum("value").alias("value")).toArrow()
    width = math.isqrt(found.num_rows)
    gram = np.zeros(width * width)
    gram[np.asarray(found.column("cell"))] = np.asarray(found.column("value"))
    gram = gram.reshape(width, width)
    v = np.linalg.eigh(gram)[1][:, ::-1][:, :dims]
    v = v * np.sign(v[np.abs(v).argmax(axis=0), np.arange(v.shape[1])])
    axes = [F.array(*[F.lit(float(a)) for a in v[:, j]]) for j in range(v.shape[1])]
    dot = lambda a: F.aggregate(F.zip_with(F.col(vector).cast("array<double>"), a, lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)
    return valid.select(key, F.array(*[dot(a) for a in axes]).alias("point"))
