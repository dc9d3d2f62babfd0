"""Type assertions at the border between two steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, DataType, MapType, StructField, StructType


def typed(schema: str | StructType):
    """A step that checks names and types when the plan is built and fails then,
    not when rows flow. Nullability is not compared."""

    def check(df: DataFrame) -> DataFrame:
        expected = (
            schema if isinstance(schema, StructType)
            else df.sparkSession.createDataFrame([], schema).schema
        )
        if _nullable(df.schema) != _nullable(expected):
            raise TypeError(
                f"expected {expected.simpleString()}, got {df.schema.simpleString()}"
            )
        return df

    return check


def _nullable(t: DataType) -> DataType:
    if isinstance(t, StructType):
        return StructType([StructField(f.name, _nullable(f.dataType)) for f in t.fields])
    if isinstance(t, ArrayType):
        return ArrayType(_nullable(t.elementType))
    if isinstance(t, MapType):
        return MapType(_nullable(t.keyType), _nullable(t.valueType))
    return t
