"""Frames from values in the program: side lists, parameters, test rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def create(spark: SparkSession, values: Sequence[Any], schema: str) -> DataFrame:
    """One row per value, repeats kept; scalars become a one-column row."""
    rows = [v if isinstance(v, (tuple, list)) else (v,) for v in values]
    return spark.createDataFrame(rows, schema)


def create_from_map(spark: SparkSession, mapping: Mapping[Any, Any], schema: str) -> DataFrame:
    """One row (key, value) per entry of a dict; a list value stays one array."""
    return spark.createDataFrame(list(mapping.items()), schema)
