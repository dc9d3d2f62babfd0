"""Session windows: per key, events closer together than a gap belong together.

Two events exactly one gap apart are in different sessions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A slice of time is so many gaps wide.
SLICE_CELLS = 512


def seconds(value: float) -> Column:
    """An interval of so many seconds, to the microsecond."""
    micros = round(value * 1_000_000)
    return F.expr(f"INTERVAL '{micros // 1_000_000}.{micros % 1_000_000:06d}' SECOND")


def session_windows(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    value: str,
    gap_seconds: float = 10,
    name: str = "total",
) -> DataFrame:
    """Sum and count per key and session; a session ends one gap after its last event."""
    if df.isStreaming:
        return _on_stream(df, keys, time, value, gap_seconds, name)
    return _on_table(df, keys, time, value, gap_seconds, name)


def _on_stream(
    df: DataFrame, keys: Sequence[str], time: str, value: str, gap: float, name: str
) -> DataFrame:
    """Spark's own session window joins events exactly one gap apart, so it is
    given a gap one microsecond shorter."""
    micros = round(gap * 1_000_000)
    window = F.session_window(time, f"{micros - 1} microseconds")
    return (
        df.groupBy(*keys, window.alias("_w"))
        .agg(F.sum(value).alias(name), F.count(F.lit(1)).alias("n"))
        .select(
            F.col("_w.start").alias("window_start"),
            (F.col("_w.end") + seconds(1e-6)).alias("window_end"),
            *keys, name, "n",
        )
    )


def _on_table(
    df: DataFrame, keys: Sequence[str], time: str, value: str, gap: float, name: str
) -> DataFrame:
    """Three steps. Events of a key within one cell of gap width are always in one
    session, so an ordinary aggregate reduces them to (first, last, sum, count);
    it works before the shuffle, and a hot key costs at most one row per task and
    cell. Then the cells of a key and a slice of time are joined in order where the
    distance is below the gap, so a hot key is spread over as many tasks as it has slices. Of a
    slice's sessions only the first and the last may go on beyond it; those of a key, at most
    two a slice, are joined in order in the same way.
    """
    width = round(gap * 1_000_000)
    cell = F.window(time, f"{width} microseconds")["start"]
    cells = df.groupBy(*keys, cell.alias("_cell")).agg(
        F.min(time).alias("_first"), F.max(time).alias("_last"),
        F.sum(value).alias(name), F.count(F.lit(1)).alias("n"),
    )
    # a slice holds whole cells: both are counted from the epoch
    slices = cells.withColumn("_slice", F.window("_cell", f"{width * SLICE_CELLS} microseconds")["start"])
    pieces = _joined(slices, [*keys, "_slice"], "_cell", gap, name)
    last = F.max("_number").over(Window.partitionBy(*keys, "_slice"))
    at_edge = (F.col("_number") == 1) | (F.col("_number") == last)
    pieces = pieces.withColumn("_edge", at_edge)
    edges = _joined(pieces.where("_edge"), keys, "_first", gap, name)
    rest = [*keys, "_first", "_last", name, "n"]
    return pieces.where("NOT _edge").select(*rest).unionByName(edges.select(*rest)).select(
        F.col("_first").alias("window_start"), (F.col("_last") + seconds(gap)).alias("window_end"),
        *keys, name, "n")


def _joined(pieces: DataFrame, part: Sequence[str], order: str, gap: float, name: str) -> DataFrame:
    """Pieces of ``part`` joined where they are less than a gap apart, with ``_number`` in it."""
    in_order = Window.partitionBy(*part).orderBy(order)
    opens = F.when(F.col("_first") < F.lag("_last").over(in_order) + seconds(gap), 0).otherwise(1)
    so_far = in_order.rowsBetween(Window.unboundedPreceding, 0)
    numbered = pieces.withColumn("_opens", opens).withColumn("_number", F.sum("_opens").over(so_far))
    return numbered.groupBy(*part, "_number").agg(
        F.min("_first").alias("_first"), F.max("_last").alias("_last"),
        F.sum(name).alias(name), F.sum("n").alias("n"))
