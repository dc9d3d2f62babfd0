"""Functions of the caller over whole tables, batch by batch in Arrow.

A table function gets the rows of a partition in batches, in the order asked for, and gives any
number of rows back after each batch and at the end. Which columns it gives may depend on the
columns it gets and on its arguments.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

Batch = pa.RecordBatch | pa.Table


class TableFn:
    """One object per partition: per value of ``partition_by``, or per task without it."""

    @classmethod
    def analyze(cls, schema: StructType, *args: Any) -> StructType | str:
        """The columns of the result, for a table of these columns."""
        raise NotImplementedError

    def process(self, batch: pa.RecordBatch, *args: Any) -> Iterable[Batch]:
        raise NotImplementedError

    def finish(self, *args: Any) -> Iterable[Batch]:
        """What is left to give after the last batch of the partition."""
        return ()


def _bound(fn: type[TableFn], schema: StructType, args: tuple):
    """The function for tables of one schema, with its arguments, as Spark runs it."""
    result = fn.analyze(schema, *args)
    if isinstance(result, str):
        result = StructType.fromDDL(result)
    arrow = to_arrow_schema(result)

    def fitted(found: Iterable[Batch] | None):
        for part in found or ():
            table = part if isinstance(part, pa.Table) else pa.Table.from_batches([part])
            yield table.select(arrow.names).cast(arrow)

    class Bound:
        def __init__(self):
            self.fn = fn()

        def eval(self, batch: pa.RecordBatch):
            yield from fitted(self.fn.process(batch, *args))

        def terminate(self):
            yield from fitted(self.fn.finish(*args))

    return F.arrow_udtf(Bound, returnType=result)


def apply_table(
    df: DataFrame, fn: type[TableFn], *args: Any, partition_by: Sequence[str] = (),
    order_by: Sequence[str | Column] = (),
) -> DataFrame:
    """The rows that ``fn`` gives for ``df``. With ``partition_by`` all rows of a key meet in one
    task, sorted by ``order_by`` without being held; without it rows stay where they are."""
    if order_by and not partition_by:
        raise ValueError("an order needs partition_by")
    table = df.asTable()
    if partition_by:
        table = table.partitionBy(*partition_by)
        table = table.orderBy(*order_by) if order_by else table
    return _bound(fn, df.schema, args)(table)


def register_table_function(
    spark: SparkSession, name: str, fn: type[TableFn], schema: StructType, *args: Any
) -> None:
    """Make ``fn`` for tables of ``schema`` known to SQL:
    ``SELECT * FROM name(TABLE(t) PARTITION BY k ORDER BY o)``."""
    spark.udtf.register(name, _bound(fn, schema, args))
