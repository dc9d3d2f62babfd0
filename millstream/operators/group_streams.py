"""Groups and co-groups of any size, handed to a caller's function row batch by row batch.

The rows of all inputs are dealt by key and sorted by key, input and order in one shuffle; the
sort spills to disk. The engine also marks where a group begins. A task then reads its
groups one after the other and never holds more than a batch of rows, so a key with a third
of all rows needs no more memory than others (but it is one task's work: what can be said with
aggregates, ``count_values`` or ``cogroup_join`` should be).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Gets the key and the group's batches, each with the name of its input.
GroupFunction = Callable[[tuple, Iterator[tuple[str, pa.RecordBatch]]], Iterator[pa.RecordBatch]]


def per_group(
    inputs: Mapping[str, DataFrame],
    keys: Sequence[str],
    function: GroupFunction,
    schema: StructType | str,
    order: Sequence[str] = (),
) -> DataFrame:
    """What ``function`` yields for every key of any input. It gets the rows of the first input,
    by ``order``, then those of the second, and so on, without the key columns; it need not
    read all of them. An input may lack columns of ``order``. Null keys are one group."""
    keys, names = list(keys), list(inputs)
    parts = []
    for i, (name, df) in enumerate(inputs.items()):
        rest = [c for c in df.columns if c not in keys]
        if not rest:
            raise ValueError(f"input {name!r} has no value columns")
        parts.append(df.select(
            *[F.col(k).alias(f"k{j}") for j, k in enumerate(keys)], F.lit(i).alias("input"),
            *[F.col(o).alias(f"o{j}") for j, o in enumerate(order) if o in rest],
            F.struct(*rest).alias(f"r{i}")))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    own = [f"k{j}" for j in range(len(keys))]
    sorted_by = ["input", *[c for c in rows.columns if c.startswith("o")]]
    in_group = Window.partitionBy(*own).orderBy(*sorted_by)
    marked = rows.select("*", (F.row_number().over(in_group) == 1).alias("first"))
    marked = marked.select(*own, "input", "first", *[f"r{i}" for i in range(len(names))])
    n = len(keys)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """Key, whether a group begins, input and rows of stretches of one input."""
        for batch in batches:
            number = batch.column(n).to_pylist()
            first = batch.column(n + 1).to_pylist()
            start = 0
            for stop in range(1, len(number) + 1):
                if stop < len(number) and not first[stop] and number[stop] == number[start]:
                    continue
                part = batch.slice(start, stop - start)
                key = tuple(part.column(j)[0].as_py() for j in range(n))
                i = number[start]
                yield key, first[start], names[i], pa.RecordBatch.from_struct_array(
                    part.column(n + 2 + i))
                start = stop

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ahead = pieces(batches)
        piece = next(ahead, None)

        def group() -> Iterator[tuple[str, pa.RecordBatch]]:
            nonlocal piece
            yield piece[2], piece[3]
            while (piece := next(ahead, None)) is not None and not piece[1]:
                yield piece[2], piece[3]

        while piece is not None:
            rows_of_group = group()
            yield from function(piece[0], rows_of_group)
            for _ in rows_of_group:  # what the function has left
                pass

    return marked.mapInArrow(run, schema)
