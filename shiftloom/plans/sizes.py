"""Broadcast only what was measured: the optimizer's own estimate decides, with a bound of ours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT_BYTES = 32 << 20


def small_side(df: DataFrame, limit: int = LIMIT_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if Spark's size estimate of its plan is within ``limit``, else as it is.

    The estimate is an upper bound for scans and projections; beyond it the join shuffles (and AQE
    may still broadcast from run-time sizes).
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(df) if size <= limit else df
