"""Fixed and sliding windows over an event-time column, on tables and streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Milliseconds of the units of a duration.
UNITS = {"millisecond": 1, "second": 1000, "minute": 60_000, "hour": 3_600_000,
         "day": 86_400_000, "week": 604_800_000}


def windowed(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    size: str,
    slide: str | None,
    *aggregates: Column,
) -> DataFrame:
    """Aggregates per key and window; windows start at whole multiples of the slide
    since the epoch. Rows of a task are aggregated before the shuffle, so a busy
    key or window costs one row per task. On a stream the caller sets the watermark.
    """
    window = F.window(time, size, slide) if slide else F.window(time, size)
    return (
        df.groupBy(*keys, window.alias("_w")).agg(*aggregates)
        .select(
            F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "*"
        )
        .drop("_w")
    )


def fixed_windows(
    df: DataFrame, keys: Sequence[str], time: str, value: str, size: str = "5 seconds",
    name: str = "total",
) -> DataFrame:
    """Sum per key in windows of one size."""
    return windowed(df, keys, time, size, None, F.sum(value).alias(name))


def sliding_windows(
    df: DataFrame, keys: Sequence[str], time: str, value: str, size: str = "10 seconds",
    slide: str = "5 seconds", name: str = "total",
) -> DataFrame:
    """Sum per key in overlapping windows: a row counts in ``size / slide`` of them.

    On a table whose size is a multiple of the slide, rows are summed per slide first and
    only these sums are put into every window, instead of every row.
    """
    if df.isStreaming or not _divides(slide, size):
        return windowed(df, keys, time, size, slide, F.sum(value).alias(name))
    cells = df.groupBy(*keys, F.window(time, slide).alias("_cell")).agg(
        F.sum(value).alias("_sum"))
    cells = cells.select(*keys, F.col("_cell.start").alias("_at"), "_sum")
    return windowed(cells, keys, "_at", size, slide, F.sum("_sum").alias(name))


def _divides(slide: str, size: str) -> bool:
    """Whether ``size`` is a whole multiple of ``slide``, as far as plain durations show."""
    parts = [d.split() for d in (slide, size)]
    if any(len(p) != 2 or not p[0].isdigit() for p in parts):
        return False
    (a, unit_a), (b, unit_b) = ((int(n), UNITS.get(u.lower().rstrip("s"))) for n, u in parts)
    return bool(unit_a and unit_b and a) and (b * unit_b) % (a * unit_a) == 0
