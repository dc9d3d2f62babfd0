"""Count-triggered panes: per key, every ``size`` rows in order of arrival make a
pane, and a pane holds only its own rows. An incomplete rest is not emitted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DatetimeType, NumericType, TimestampNTZType

from ..session import cut_lineage
from .hot_keys import KEY_HASH, hot_keys, key_hash, with_hot_rows
from .side_inputs import bounded_broadcast

# Keys with more rows than this are counted in slices of the arrival order of about so many.
HOT_ROWS = 1_000_000
# The most slices of a key, and how many bounds are looked at together.
SLICES = 1024
BOUNDS = 32


def count_panes(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    size: int = 5,
    name: str = "total",
    slice_column: Column | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """The full panes: keys, ``pane`` (from 0) and the sum of its values. ``order``
    must put the rows of a key in one definite order."""
    sums = pane_sums(df, keys, order, value, size, name, slice_column, hot_rows)
    return sums.where(F.col("n") == size).drop("n")


def pane_sums(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    size: int,
    name: str,
    slice_column: Column | None = None,
    hot_rows: int = HOT_ROWS,
    state: DataFrame | None = None,
) -> DataFrame:
    """Keys, ``pane``, row count ``n`` and sum of all panes, full or not; with
    ``state`` (of ``pane_state``) the panes go on where an earlier table ended.

    The pane of a row follows from its rank under its key. A key with more than
    about ``hot_rows`` rows is ranked by several tasks, one per slice of the arrival
    order. Slices are bounded by quantiles of the key's own arrival order, so a burst is
    split as evenly as anything else; ``slice_column`` gives other slices. Where a slice
    starts follows from a small table of row counts. The start
    reaches the rows as one marker row that sorts before them, so there is no join,
    and without hot keys and state there is one shuffle only.
    """
    keys = list(keys)
    rows = df.select(*keys, *order, F.col(value).alias("_value"))
    kind = df.schema[order[0]].dataType
    if slice_column is None and not isinstance(
            kind, (NumericType, DatetimeType, TimestampNTZType)):
        raise TypeError(f"give slice_column: no slices are known for {kind.simpleString()}")
    part = F.struct((F.lit(0) if slice_column is None else slice_column).alias("at"))
    no_slice = F.lit(None).cast(df.select(part.alias("s")).schema["s"].dataType)
    hot = hot_keys(df, keys, hot_rows)
    if hot is None:
        placed = rows.withColumn("_slice", no_slice)
    elif slice_column is None:
        known = bounded_broadcast(slice_bounds(df, hot, keys, order[0], hot_rows))
        at = F.struct(slice_of(F.col(order[0]), F.col("_bounds")).alias("at"))
        placed = with_hot_rows(rows, known, keys).select(
            *rows.columns, F.when(F.col("_rows").isNotNull(), at).alias("_slice"))
    else:
        sliced = df.select(*keys, *order, F.col(value).alias("_value"), part.alias("_at"))
        placed = with_hot_rows(sliced, hot, keys).select(
            *rows.columns, F.when(F.col("_rows").isNotNull(), F.col("_at")).alias("_slice"))

    starts = []
    if state is not None:
        begun = state.select(
            *keys, no_slice.alias("_slice"), (F.col("pane") * size + F.col("n")).alias("_start"))
        starts.append(begun)
    if hot is not None:
        counts = placed.where(F.col("_slice").isNotNull()).groupBy(*keys, "_slice").agg(
            F.count(F.lit(1)).alias("_start"))
        if state is not None:
            counts = counts.unionByName(
                with_hot_rows(begun, hot, keys).where(F.col("_rows").isNotNull()).drop("_rows"))
        before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(
            Window.unboundedPreceding, -1)
        starts.append(
            counts.withColumn("_start", F.coalesce(F.sum("_start").over(before), F.lit(0)))
            .where(F.col("_slice").isNotNull()))

    in_order = Window.partitionBy(*keys, "_slice").orderBy(*order)
    position = F.row_number().over(in_order) - 1
    if starts:
        placed = placed.withColumns({"_start": F.lit(None).cast("bigint"), "_mark": F.lit(0)})
        for start in starts:
            placed = placed.unionByName(
                start.withColumn("_mark", F.lit(1)), allowMissingColumns=True)
        in_order = Window.partitionBy(*keys, "_slice").orderBy(F.desc("_mark"), *order)
        position = (
            F.row_number().over(in_order) - 1 - F.first("_mark").over(in_order)
            + F.coalesce(F.first("_start").over(in_order), F.lit(0))
        )
    items = placed.withColumn("_position", position)
    if starts:
        items = items.where(F.col("_mark") == 0)
    items = items.select(
        *keys, F.call_function("div", F.col("_position"), F.lit(size)).alias("pane"),
        F.lit(1).cast("bigint").alias("n"), F.col("_value").alias(name))
    if state is not None:
        items = items.unionByName(state.select(*keys, "pane", "n", name))
    return items.groupBy(*keys, "pane").agg(F.sum("n").alias("n"), F.sum(name).alias(name))


def pane_state(sums: DataFrame, keys: Sequence[str], size: int, name: str = "total") -> DataFrame:
    """One row per key: the pane that is open after ``sums``, its rows and their sum."""
    last = sums.groupBy(*keys).agg(
        F.max("pane").alias("_last"), F.max_by(F.struct("n", name), "pane").alias("_open"))
    full = F.col("_open.n") == size
    return last.select(
        *keys,
        (F.col("_last") + F.when(full, 1).otherwise(0)).alias("pane"),
        F.when(full, 0).otherwise(F.col("_open.n")).cast("bigint").alias("n"),
        F.when(~full, F.col(f"_open.{name}")).alias(name),
    )


def slice_bounds(df: DataFrame, hot: DataFrame, keys: Sequence[str], column: str,
                 hot_rows: int) -> DataFrame:
    """``hot`` with ``_bounds``: quantiles of ``column`` under the key that cut its rows into
    slices of about ``hot_rows``, at most ``SLICES``. They come from mergeable sketches, one
    per key and task, so no task sees all rows of a key. They are fixed once computed,
    because a sketch that is merged in another order may give other bounds."""
    rows = with_hot_rows(df.select(*keys, column), hot, keys).where(F.col("_rows").isNotNull())
    shares = F.array(*[F.lit(i / SLICES) for i in range(1, SLICES)])
    sketched = rows.groupBy(key_hash(keys).alias(KEY_HASH), "_rows").agg(
        F.percentile_approx(column, shares, F.lit(8 * SLICES)).alias("_all"))
    step = F.greatest(F.lit(1), F.floor(
        F.lit(SLICES) / F.ceil(F.col("_rows") / F.lit(hot_rows)))).cast("int")
    return cut_lineage(sketched.withColumn("_step", step).select(
        KEY_HASH, "_rows",
        F.coalesce(F.filter("_all", lambda _, i: (i + 1) % F.col("_step") == 0),
                   F.array().cast(sketched.schema["_all"].dataType)).alias("_bounds")))


def slice_of(value: Column, bounds: Column) -> Column:
    """How many of the sorted bounds a value has reached; looked up in two steps."""
    def reached(some: Column) -> Column:
        return F.size(F.filter(some, lambda b: b <= value))

    blocks = reached(F.filter(bounds, lambda _, i: i % BOUNDS == 0))
    last = F.greatest(blocks - 1, F.lit(0)) * BOUNDS
    return F.when(blocks > 0, last + reached(F.slice(bounds, last + 1, F.lit(BOUNDS)))).otherwise(0)
