"""Combiners written by the caller, in two phases.

Phase one runs next to the data: every task builds one accumulator per key it
sees and forwards only those. Phase two sorts the accumulators by key and merges
them as they stream by, so that a task never holds more than one key's merge
buffer. Plain sums, counts, extremes and means should use Spark's own
aggregates; this is for the functions that Spark does not have.
"""

from __future__ import annotations

import pickle
from abc import ABC, abstractmethod
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, IntegerType, MapType, StructField, StructType

MAX_KEYS_PER_TASK = 100_000
MERGE_BATCH = 256
ROWS_PER_BATCH = 10_000


class CombineFn(ABC):
    """An aggregate function: the order of inputs and merges must not matter."""

    @abstractmethod
    def create_accumulator(self) -> Any:
        """The accumulator of no input at all."""

    @abstractmethod
    def add_input(self, accumulator: Any, element: Any) -> Any:
        """The accumulator with one more element in it."""

    @abstractmethod
    def merge_accumulators(self, accumulators: Sequence[Any]) -> Any:
        """All inputs of several accumulators in one."""

    @abstractmethod
    def extract_output(self, accumulator: Any) -> Any:
        """The result of an accumulator."""

    def add_inputs(self, accumulator: Any, elements: Sequence[Any]) -> Any:
        """Add a batch; override it where the batch can be handled at once."""
        for element in elements:
            accumulator = self.add_input(accumulator, element)
        return accumulator


def combine_per_key(
    df: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    fn: CombineFn,
    output: str,
    *,
    max_keys_per_task: int = MAX_KEYS_PER_TASK,
    fanout: int = 0,
) -> DataFrame:
    """``fn`` per key. ``output`` is the result's type, as ``"name type"``.

    An element is the value itself, or a tuple with several ``values``. A task
    that sees more than ``max_keys_per_task`` keys forwards what it has and starts
    anew. With ``fanout`` the accumulators of a key are merged by that many tasks
    before the last one: for accumulators too large to meet in a single task first.
    """
    keys, values = list(keys), list(values)
    key_fields = df.select(*keys).schema.fields
    if any(isinstance(f.dataType, MapType) for f in key_fields):
        raise TypeError("a map has no fixed order and cannot be a key")
    partials = df.select(*keys, *values).mapInArrow(
        _build(fn, len(keys), len(values), _partial_schema(key_fields, False),
               max_keys_per_task),
        _partial_schema(key_fields, False),
    )
    if fanout:
        salted = partials.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(fanout)))
        schema = _partial_schema(key_fields, True)
        partials = (
            salted.repartition(*keys, "_salt").sortWithinPartitions(*keys, "_salt")
            .select(*keys, "_salt", "_acc")
            .mapInArrow(_merge(fn, len(keys) + 1, schema, pickle.dumps), schema)
            .drop("_salt")
        )
    result = StructType(key_fields + _output_field(df, output).fields)
    return (
        partials.repartition(*keys).sortWithinPartitions(*keys)
        .mapInArrow(_merge(fn, len(keys), result, fn.extract_output), result)
    )


def combine_globally(
    df: DataFrame,
    values: Sequence[str],
    fn: CombineFn,
    output: str,
    *,
    fanout: int = 64,
) -> DataFrame:
    """``fn`` over all rows: a frame of exactly one row, also for an empty input.

    The tasks' accumulators are merged by ``fanout`` tasks and then by one. The
    accumulator must stay small whatever the number of rows; a result that grows
    with the data belongs under a key.
    """
    spark = df.sparkSession
    values = list(values)
    schema = _partial_schema([], False)
    partials = df.select(*values).mapInArrow(_build(fn, 0, len(values), schema, 1), schema)
    salted_schema = _partial_schema([], True)
    merged = (
        partials.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(fanout)))
        .select("_salt", "_acc").repartition("_salt").sortWithinPartitions("_salt")
        .mapInArrow(_merge(fn, 1, salted_schema, pickle.dumps), salted_schema)
        .select("_acc")
    )
    identity = spark.createDataFrame([(pickle.dumps(fn.create_accumulator()),)], schema)
    result = _output_field(df, output)
    # a shuffle and not a coalesce, which would draw the merging tasks into one as well
    return (
        merged.unionAll(identity).repartition(1)
        .mapInArrow(_merge(fn, 0, result, fn.extract_output), result)
    )


def _output_field(df: DataFrame, output: str) -> StructType:
    return df.sparkSession.createDataFrame([], output).schema


def _partial_schema(keys: list[StructField], salted: bool) -> StructType:
    salt = [StructField("_salt", IntegerType())] if salted else []
    return StructType([*keys, *salt, StructField("_acc", BinaryType())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _build(
    fn: CombineFn, n_keys: int, n_values: int, schema: StructType, max_keys: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    arrow = to_arrow_schema(schema)

    def flush(accumulators: dict) -> Iterator[pa.RecordBatch]:
        rows = [(*key, pickle.dumps(acc)) for key, acc in accumulators.values()]
        for i in range(0, len(rows), ROWS_PER_BATCH):
            yield _batch(rows[i:i + ROWS_PER_BATCH], arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        accumulators: dict[Any, tuple[tuple, Any]] = {}
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            groups = _elements_by_key(columns, n_keys, n_values, batch.num_rows)
            for ident, (key, elements) in groups.items():
                kept = accumulators.get(ident)
                start = fn.create_accumulator() if kept is None else kept[1]
                accumulators[ident] = (key, fn.add_inputs(start, elements))
            if len(accumulators) > max_keys:
                yield from flush(accumulators)
                accumulators = {}
        yield from flush(accumulators)

    return run


def _elements_by_key(
    columns: list[list], n_keys: int, n_values: int, n_rows: int
) -> dict[Any, tuple[tuple, list]]:
    values = columns[n_keys:]
    elements = values[0] if n_values == 1 else list(zip(*values, strict=True))
    if not n_keys:
        return {(): ((), elements)} if n_rows else {}
    groups: dict[Any, tuple[tuple, list]] = {}
    for key, element in zip(zip(*columns[:n_keys], strict=True), elements, strict=True):
        ident = _identity(key)
        group = groups.get(ident)
        if group is None:
            groups[ident] = (key, [element])
        else:
            group[1].append(element)
    return groups


def _identity(key: tuple) -> Any:
    """Something hashable that is equal for equal keys, with NaN equal to NaN."""
    try:
        hash(key)
    except TypeError:
        return repr(key)
    return key if all(k == k for k in key) else repr(key)


def _merge(
    fn: CombineFn, n_keys: int, schema: StructType, finish: Callable[[Any], Any]
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Merge the runs of equal keys in sorted accumulators."""
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ident: Any = None
        key: tuple = ()
        waiting: list[Any] = []
        rows: list[tuple] = []

        def merged() -> Any:
            return waiting[0] if len(waiting) == 1 else fn.merge_accumulators(waiting)

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            keys = zip(*columns[:n_keys], strict=True) if n_keys else [()] * batch.num_rows
            for next_key, acc in zip(keys, columns[n_keys], strict=True):
                next_ident = _identity(next_key)
                if waiting and next_ident != ident:
                    rows.append((*key, finish(merged())))
                    waiting = []
                    if len(rows) >= ROWS_PER_BATCH:
                        yield _batch(rows, arrow)
                        rows = []
                ident, key = next_ident, next_key
                waiting.append(pickle.loads(acc))
                if len(waiting) >= MERGE_BATCH:
                    waiting = [merged()]
        if waiting:
            rows.append((*key, finish(merged())))
        if rows:
            yield _batch(rows, arrow)

    return run
