"""Co-groups, the joins that follow from them, exclusion and union."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .grouping import piece_of


def cogroup(
    inputs: Mapping[str, DataFrame],
    keys: Sequence[str],
    chunks: int = 1,
    chunk: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per key of any input, with a list per input of structs ``row`` (its
    non-key columns) and ``times``; a list is empty where the input lacks the key.

    Equal rows of a key are counted first, which begins next to the data; then all inputs
    meet in one shuffle of what is left. ``chunks`` cuts the lists of all keys into pieces by a hash of the row, or
    ``chunk`` gives the piece per input; pieces are for reading the lists. To pair the rows
    of one input with those of another use ``cogroup_join``, which loses no pair of a key
    of any size.
    """
    keys = list(keys)
    parts = []
    for name, df in inputs.items():
        fields = [c for c in df.columns if c not in keys]
        if not fields:
            raise ValueError(f"input {name!r} has no value columns")
        row = F.struct(*fields)
        piece = chunk[name] if chunk else piece_of(row, chunks)
        parts.append(df.select(*keys, piece.cast("int").alias("chunk"), row.alias(name)))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    counted = rows.groupBy(*keys, "chunk", *inputs).agg(F.count(F.lit(1)).alias("times"))
    lists = [F.collect_list(F.when(F.col(name).isNotNull(), F.struct(
        F.col(name).alias("row"), "times"))).alias(name) for name in inputs]
    return counted.groupBy(*keys, "chunk").agg(*lists)


def cogroup_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """The relational join that a co-group of two inputs expands to. No hint is
    given: the optimiser broadcasts a side it knows to be small, and adaptive
    execution splits skewed partitions of a shuffled join."""
    if how not in ("inner", "left", "right", "full"):
        raise ValueError("how must be inner, left, right or full")
    return left.join(right, list(keys), how)


def exclude(df: DataFrame, excluded: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is not in ``excluded``. A row with a NULL key is
    kept, unlike with ``NOT IN``.

    An outer join of which the rows without a partner stay: the optimiser would move an
    anti join below an aggregate of ``df``, and a hot key would then be shuffled before it
    is aggregated. A short list is broadcast by its size in the statistics or, when it
    is known only at run time, by adaptive execution; nothing is counted ahead.
    """
    keys = list(keys)
    marked = excluded.select(*keys).distinct().withColumn("_listed", F.lit(True))
    return df.join(marked, keys, "left").where(F.col("_listed").isNull()).drop("_listed")


def flatten(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, repeats kept; columns are matched by name."""
    return reduce(lambda a, b: a.unionByName(b), frames)
