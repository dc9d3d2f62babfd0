"""Element-wise operators: each returns a ``DataFrame -> DataFrame`` step for
``df.transform``, built from column expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Step = Callable[[DataFrame], DataFrame]


def map_columns(**columns: Column) -> Step:
    """One row to one row: the named columns only."""
    return lambda df: df.select(*[c.alias(name) for name, c in columns.items()])


def flat_map(array: Column, name: str = "value", keep: Sequence[str] = ()) -> Step:
    """One row to as many rows as ``array`` has entries."""
    return lambda df: df.select(*keep, F.explode(array).alias(name))


def filter_equals(column: str, value: Any) -> Step:
    return lambda df: df.where(F.col(column) == F.lit(value))


def filter_in(column: str, values: Sequence[Any]) -> Step:
    """Any of a few values of one field."""
    return lambda df: df.where(F.col(column).isin(*values))


def key_value(keys: Sequence[str], value: Column, name: str = "value") -> Step:
    """Keep the key columns and one value column."""
    return lambda df: df.select(*keys, value.alias(name))


def tag_constant(name: str, value: Any) -> Step:
    """Append the same value to every row."""
    return lambda df: df.withColumn(name, F.lit(value))


def struct_key(name: str, *columns: str) -> Step:
    """A record of several fields as one grouping key."""
    return lambda df: df.withColumn(name, F.struct(*columns))


def chain(*steps: Step) -> Step:
    """Several steps as one composite step."""
    return lambda df: reduce(lambda frame, step: frame.transform(step), steps, df)


def labelled(label: str, step: Step) -> Step:
    """``step`` under a name that shows in the plan; rows are unchanged."""
    return lambda df: df.transform(step).alias(label)
