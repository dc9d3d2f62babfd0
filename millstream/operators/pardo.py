"""Functions of the caller over single elements: 0, 1 or many results each.

Rows travel to the Python workers in Arrow batches. Whatever column expressions
can say should be said with them; this surface is for everything else.
"""

from __future__ import annotations

from collections import namedtuple
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructField, StructType

ROWS_PER_BATCH = 10_000


class DoFn:
    """A per-element function with an optional set-up once per task."""

    def setup(self) -> None:
        pass

    def process(self, element: Any, *args: Any, **kwargs: Any) -> Iterable[Any] | None:
        raise NotImplementedError


@dataclass(frozen=True)
class Tagged:
    """A result for a named output."""

    tag: str
    value: Any


Process = Callable[..., Iterable[Any] | None]


def par_do(
    df: DataFrame, fn: DoFn | Process, schema: str, *args: Any, **kwargs: Any
) -> DataFrame:
    """``fn(element, *args, **kwargs)`` per row. An element is a named tuple of the
    columns; every result is a tuple of the fields of ``schema`` or, with a single
    field, its value. ``None`` and empty results drop the element. Extra arguments
    are sent along with the function, so they must be small."""
    result = df.sparkSession.createDataFrame([], schema).schema
    return df.mapInArrow(_runner(fn, list(df.columns), result, args, kwargs, None), result)


def map_rows(df: DataFrame, fn: Callable[..., Any], schema: str, *args: Any) -> DataFrame:
    """One result per row."""
    return par_do(df, lambda element, *extra: [fn(element, *extra)], schema, *args)


def flat_map_rows(
    df: DataFrame, fn: Callable[..., Iterable[Any]], schema: str, *args: Any
) -> DataFrame:
    """All results of every row."""
    return par_do(df, fn, schema, *args)


def filter_rows(df: DataFrame, predicate: Callable[..., bool], *args: Any) -> DataFrame:
    """The rows for which a function of the caller holds."""
    schema = df.schema

    def keep(element: Any, *extra: Any) -> list[Any]:
        return [element] if predicate(element, *extra) else []

    return df.mapInArrow(_runner(keep, list(df.columns), schema, args, {}, None), schema)


def par_do_tagged(
    df: DataFrame,
    fn: DoFn | Process,
    schemas: Mapping[str, str],
    main: str,
    *args: Any,
    **kwargs: Any,
) -> DataFrame:
    """As ``par_do`` with several outputs. ``schemas`` names them all; a plain
    result goes to ``main``, a ``Tagged`` one to its tag. The frame has ``tag`` and
    one struct column per output; ``tagged_output`` picks one."""
    if main not in schemas:
        raise ValueError(f"main output {main!r} has no schema")
    spark = df.sparkSession
    fields = [
        StructField(tag, spark.createDataFrame([], schema).schema)
        for tag, schema in schemas.items()
    ]
    result = StructType([StructField("tag", StringType()), *fields])
    return df.mapInArrow(_runner(fn, list(df.columns), result, args, kwargs, main), result)


def tagged_output(df: DataFrame, tag: str) -> DataFrame:
    return df.where(F.col("tag") == tag).select(f"`{tag}`.*")


def _runner(
    fn: DoFn | Process,
    columns: list[str],
    schema: StructType,
    args: tuple,
    kwargs: dict,
    main: str | None,
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    arrow = to_arrow_schema(schema)
    single = len(schema) == 1

    def as_row(value: Any) -> tuple:
        if main is None:
            return (value,) if single and not isinstance(value, tuple) else tuple(value)
        tag, value = (value.tag, value.value) if isinstance(value, Tagged) else (main, value)
        row: list[Any] = [tag] + [None] * (len(schema) - 1)
        place = schema.names.index(tag, 1)
        names = schema[place].dataType.names
        value = value if isinstance(value, tuple) else (value,)
        row[place] = dict(zip(names, value, strict=True))
        return tuple(row)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        element = namedtuple("Element", columns, rename=True)
        process = fn
        if isinstance(fn, DoFn):
            fn.setup()
            process = fn.process
        rows: list[tuple] = []
        for batch in batches:
            for values in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                for value in process(element._make(values), *args, **kwargs) or ():
                    rows.append(as_row(value))
                    if len(rows) >= ROWS_PER_BATCH:  # also within one element
                        yield _batch(rows, arrow)
                        rows = []
        if rows:
            yield _batch(rows, arrow)

    return run


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
