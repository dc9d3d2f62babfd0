"""Parquet and Avro."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from .paths import load_or_empty


def read_parquet(
    spark: SparkSession,
    path: str | list[str],
    *,
    columns: list[str] | None = None,
    validate: bool = True,
    schema: str | None = None,
) -> DataFrame:
    """Parquet files, restricted to ``columns`` so that only these are read."""
    paths = [path] if isinstance(path, str) else path
    reader = spark.read.schema(schema) if schema else spark.read
    if not validate and not schema:
        raise ValueError("validate=False needs a schema for the empty frame")
    df = load_or_empty(spark, lambda: reader.parquet(*paths), validate, schema or "")
    return df.select(*columns) if columns else df


def avro_module(error: AnalysisException) -> Exception:
    """What to raise for ``error``: a missing Avro module is named."""
    text = str(error)
    if "data source: avro" in text or error.getCondition() == "DATA_SOURCE_NOT_FOUND":
        return RuntimeError(
            "Avro needs Spark's module org.apache.spark:spark-avro on the class path "
            "(spark.jars.packages)")
    return error


def read_avro(
    spark: SparkSession,
    path: str,
    *,
    validate: bool = True,
    schema: str | None = None,
) -> DataFrame:
    """Avro container files, with Spark's Avro module."""
    try:
        return load_or_empty(
            spark, lambda: spark.read.format("avro").load(path), validate, schema or "")
    except AnalysisException as error:
        raise avro_module(error) from error
