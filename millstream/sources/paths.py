"""What the file sources share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def load_or_none(load: Callable[[], DataFrame], validate: bool) -> DataFrame | None:
    """Run ``load``; with ``validate=False`` a missing path gives None."""
    try:
        return load()
    except AnalysisException as error:
        if validate or error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def load_or_empty(
    spark: SparkSession,
    load: Callable[[], DataFrame],
    validate: bool,
    empty_schema: StructType | str,
) -> DataFrame:
    """Run ``load``; with ``validate=False`` a missing path gives an empty frame."""
    df = load_or_none(load, validate)
    return spark.createDataFrame([], empty_schema) if df is None else df
