"""Relational databases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str,
    table: str,
    *,
    driver: str | None = None,
    partition_column: str | None = None,
    lower_bound: int | str | None = None,
    upper_bound: int | str | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
    properties: dict[str, str] | None = None,
) -> dict[str, str]:
    """Reader options. The four partitioning values go together: with them the
    table is read by ``num_partitions`` range queries, without them by one task."""
    split = (partition_column, lower_bound, upper_bound, num_partitions)
    given = [v is not None for v in split]
    if any(given) and not all(given):
        raise ValueError("partition_column, bounds and num_partitions go together")
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if driver:
        options["driver"] = driver
    if all(given):
        names = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")
        options.update({k: str(v) for k, v in zip(names, split, strict=True)})
    return options | (properties or {})


def read_jdbc(spark: SparkSession, url: str, table: str, **kwargs) -> DataFrame:
    """A database table; filters and column choice are pushed into its queries."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **kwargs)).load()
