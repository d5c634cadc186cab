"""Small helpers that the operators share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.shared import checkpointed, shared_folder

__all__ = ["checkpointed", "forget", "partitions", "shared_folder", "stored", "table", "texts"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stored(df: DataFrame) -> tuple[DataFrame, str]:
    """The rows written as Parquet in the shared folder and read again, and where they are."""
    path = f"{shared_folder(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path), path


def forget(spark: SparkSession, path: str) -> None:
    """Removes what ``stored`` wrote."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The two columns that text operators read; extra columns go."""
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
