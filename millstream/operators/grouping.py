"""Grouping and aggregation per key."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sum_per_key(
    df: DataFrame, keys: Sequence[str], value: Column | str, name: str = "total"
) -> DataFrame:
    """Sum per key. Each task adds up its own rows first, so a hot key costs the
    shuffle one row per task."""
    value = F.col(value) if isinstance(value, str) else value
    return df.groupBy(*keys).agg(F.sum(value).alias(name))


def count_per_key(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def having(condition: Column) -> Callable[[DataFrame], DataFrame]:
    """Keep the groups that meet a condition on their aggregates."""
    return lambda df: df.where(condition)


def count_values(
    df: DataFrame, keys: Sequence[str], value: Column | str, name: str = "value"
) -> DataFrame:
    """The groups as rows: keys, value and ``times``, how often the key has the value.
    Equal values are counted next to the data, so neither a hot key nor a value that it
    repeats meets in one task, and the rows are the same for any size and layout."""
    value = F.col(value) if isinstance(value, str) else value
    rows = df.select(*keys, value.alias(name))
    return rows.groupBy(*keys, name).agg(F.count(F.lit(1)).alias("times"))


def piece_of(value: Column, chunks: int) -> Column:
    """The piece of a value: it follows from the value alone."""
    return F.pmod(F.xxhash64(value), F.lit(chunks)).cast("int")


def group_by_key(
    df: DataFrame,
    keys: Sequence[str],
    value: Column | str,
    name: str = "values",
    chunks: int = 1,
    chunk: Column | None = None,
) -> DataFrame:
    """The values of a key as a list of structs ``value`` and ``times``, in no particular
    order, with ``chunk``.

    A list holds each value once. Where a key may have more different values than fit one
    row, ``chunks`` cuts the lists of all keys into that many pieces (of which a small key
    fills only some), or ``chunk`` gives the piece as a column of the value. Which piece
    a value is in depends on nothing else. The base form is ``count_values``, whose rows
    need no bound.
    """
    keys = list(keys)
    counted = count_values(df, keys, value)
    piece = piece_of(F.col("value"), chunks) if chunk is None else chunk
    kept = F.collect_list(F.struct("value", "times")).alias(name)
    return counted.withColumn("chunk", piece).groupBy(*keys, "chunk").agg(kept)


def fold_groups(
    grouped: DataFrame,
    keys: Sequence[str],
    fold: Callable[[Column], Column],
    merge: Callable[[Column], Column] = F.sum,
    values: str = "values",
    name: str = "total",
) -> DataFrame:
    """Reduce every list of a grouped frame, then merge the pieces of a key."""
    folded = grouped.select(*keys, fold(F.col(values)).alias(name))
    return folded.groupBy(*keys).agg(merge(F.col(name)).alias(name))


def sum_list(values: Column) -> Column:
    """Sum of the values of a list of ``value`` and ``times``."""
    return F.aggregate(values, F.lit(0).cast("bigint"),
                       lambda acc, v: acc + v["value"] * v["times"])
