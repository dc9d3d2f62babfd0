"""Small extra inputs that every task may see whole."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_BROADCAST_BYTES = 64 << 20


def bounded_broadcast(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if the statistics of its plan give it at most
    ``max_bytes``; otherwise ``df`` as it is, to be joined by shuffle. Nothing is run."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return F.broadcast(df) if int(str(size)) <= max_bytes else df


def side_list(spark: SparkSession, values: Sequence[Any], schema: str) -> DataFrame:
    """A list of the program as a one-column frame."""
    return spark.createDataFrame([(v,) for v in values], schema)
