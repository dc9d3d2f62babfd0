"""A stated set of query vectors against all rows, in blocks that stream through tasks.

Queries are dealt to groups of bounded size, rows to columns; a cell is one group and one
column. Every row is sent to each group once, every query to each column. A task gets the
queries of its cell first and then the rows batch by batch, so it holds one group, one batch
and what the search keeps per query, however many rows there are. Cells are as many as the
cluster can use, and each row is in exactly one cell of a group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple, Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A column of rows is not cut finer than this.
LEAST_ROWS = 1024
#: Cells for each core of the cluster, so that a slow one does not hold up the rest.
CELLS_PER_CORE = 4


class Stats(NamedTuple):
    """Length of the vectors, their number, and the largest norm."""

    size: int
    rows: int
    norm: float


class Search(Protocol):
    """Made from a group of queries, it is shown blocks of rows and then asked for results."""

    def block(self, rows: Block) -> None: ...

    def results(self) -> pa.RecordBatch: ...


class Block(NamedTuple):
    ids: np.ndarray
    vectors: np.ndarray
    more: dict[str, pa.Array]


def finite_vectors(df: DataFrame, id_col: str, vector: str, **more: Column) -> DataFrame:
    """``(id, vec, …)``, each distinct row once: rows with an id and a vector of finite
    components; ``vec`` is an array of floats or doubles."""
    kind = df.schema[vector].dataType.simpleString()
    vec = F.col(f"`{vector}`")
    vec = vec if kind == "array<float>" else vec.cast("array<double>")
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), vec.alias("vec"),
                     *[c.alias(name) for name, c in more.items()])
    finite = F.forall("vec", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return rows.where(F.col("id").isNotNull() & (F.size("vec") > 0) & finite).distinct()


def stats_of(rows: DataFrame) -> Stats | None:
    """Of the vectors with the most frequent length (of equally frequent ones the largest)."""
    squares = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    best = (rows.groupBy(F.size("vec").alias("d"))
            .agg(F.count("id").alias("n"), F.max(squares).alias("square"))
            .orderBy(F.desc("n"), F.desc("d")).first())
    return Stats(best.d, best.n, best.square ** 0.5) if best else None


def matrix(vectors: pa.Array) -> np.ndarray:
    """Vectors of one length as rows of doubles."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(vectors), -1)


def search_blocks(queries: DataFrame, n_queries: int, rows: DataFrame, n_rows: int,
                  make: Callable[[Block], Search], schema: str, group: int) -> DataFrame:
    """What ``make(queries)`` finds in the rows of each cell. Both tables have ``id`` and
    ``vec``; other columns come along, under their name, for the side that has them."""
    spark = rows.sparkSession
    groups = max(1, -(-n_queries // group))
    cells = CELLS_PER_CORE * spark.sparkContext.defaultParallelism
    columns = max(1, min(-(-cells // groups), -(-n_rows // LEAST_ROWS)))
    place = F.xxhash64("id", "vec")

    def dealt(side: DataFrame, number: int, first: Column, step: int, last: int) -> DataFrame:
        cells = F.sequence(first, first + F.lit(last), F.lit(step))
        return side.select("*", F.lit(number).alias("side"), F.explode(cells).alias("cell"))

    of_group = (F.pmod(place, F.lit(groups)) * columns).cast("int")
    of_column = F.pmod(place, F.lit(columns)).cast("int")
    every = dealt(queries, 0, of_group, 1, columns - 1).unionByName(
        dealt(rows, 1, of_column, columns, columns * (groups - 1)), allowMissingColumns=True)
    every = every.repartitionById(groups * columns, "cell").sortWithinPartitions(
        "cell", "side", "id", "vec")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, search, waiting = None, None, []
        for batch in batches:
            keys = 2 * batch.column("cell").to_numpy() + batch.column("side").to_numpy()
            cuts = [0, *(1 + np.flatnonzero(keys[1:] != keys[:-1])), len(keys)]
            for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
                if start == stop:
                    continue
                if keys[start] // 2 != cell:
                    if search:
                        yield search.results()
                    cell, search, waiting = keys[start] // 2, None, []
                part = batch.slice(start, stop - start)
                if keys[start] % 2 == 0:
                    waiting.append(part)
                elif waiting or search:
                    search = search or make(_block(waiting))
                    waiting = []
                    search.block(_block([part]))
        if search:
            yield search.results()

    return every.mapInArrow(run, schema)


def _block(parts: list[pa.RecordBatch]) -> Block:
    table = pa.Table.from_batches(parts).combine_chunks()
    columns = {c: table.column(c).chunk(0) for c in table.column_names}
    vectors = matrix(columns.pop("vec"))
    ids = columns.pop("id").to_numpy()
    return Block(ids, vectors, columns)
