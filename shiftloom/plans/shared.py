"""The shared folder of a session: where rows are cut from their lineage and stored between steps."""

from __future__ import annotations

import os
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder that all executors share; one is made only where none is named and all runs on one machine."""
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
        if not named and not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the cluster shares")
        sc.setCheckpointDir(named or os.path.join(tempfile.gettempdir(), "shiftloom-checkpoints"))
    return sc._jsc.sc().getCheckpointDir().get()


_SWEPT = [0.0]


def swept(spark: SparkSession, every: float = 2.0) -> bool:
    """Has the driver collect its garbage, at most once in ``every`` seconds; whether it did.

    Plans and task results of finished steps fill the driver's heap until it is full; a job of many short steps would hold the whole heap.
    """
    if time.monotonic() - _SWEPT[0] < every:
        return False
    spark.sparkContext._jvm.System.gc()
    _SWEPT[0] = time.monotonic()
    return True


def checkpointed(df: DataFrame) -> DataFrame:
    """Rows and their partitions as they are now, kept reliably in the shared folder; the driver collects what earlier steps left in its heap."""
    spark = df.sparkSession
    shared_folder(spark)
    out = df.checkpoint(eager=True)
    del df  # its plan is garbage from here on
    swept(spark)
    return out


def place(spark: SparkSession, name: str = "stored") -> str:
    """A path of its own in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The rows written as Parquet in the shared folder and read again."""
    path = place(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
