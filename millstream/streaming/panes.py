"""The count trigger on a stream, on the engine's own keyed state.

A key's state is the pane that is open: its number, its rows so far and their sum, in typed
columns that travel with the rows in Arrow batches. A micro-batch adds the key's rows in the order of arrival, every full pane leaves as a
row, and the rest goes back to the state store. So a batch without rows, a restart and a
batch that runs again need nothing of their own, and the result is a stream that any sink can
take. The rows of one key in one micro-batch meet in one task, which holds their order and
value columns; the reader's admission limit bounds them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import DataType, LongType, NumericType, StringType, StructField, StructType


def _cutter(size: int) -> Callable[..., Iterator[pd.DataFrame]]:
    """Cuts the rows of a key into panes of ``size`` rows. Rows hold the columns ``o…`` that
    order them, ``value`` and ``missing`` (such a value adds nothing)."""

    def cut(key: tuple, rows: Iterator[pd.DataFrame], state: GroupState
            ) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows))
        if len(batch) > 1:
            batch = batch.sort_values([c for c in batch.columns if c.startswith("o")],
                                      kind="stable")
        pane, n, total = state.get if state.exists else (0, 0, None)
        values, missing = batch["value"].tolist(), batch["missing"].tolist()
        done = []
        at = 0
        while at < len(values):
            stop = min(at + size - n, len(values))
            for value, gone in zip(values[at:stop], missing[at:stop], strict=True):
                if not gone:
                    total = value if total is None else total + value
            n += stop - at
            at = stop
            if n == size:
                done.append((pane, total))
                pane, n, total = pane + 1, 0, None
        state.update((pane, n, total))
        if done:
            numbers, totals = zip(*done, strict=True)
            out = {f"k{i}": [v] * len(done) for i, v in enumerate(key)}
            yield pd.DataFrame(out | {"pane": numbers, "total": totals}, dtype=object)

    return cut


def count_trigger(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    size: int = 5,
    name: str = "total",
) -> DataFrame:
    """The full panes of a stream: keys, ``pane`` (from 0) and the sum of its ``size`` rows.
    Batches follow each other; within one the rows of a key are taken by ``order``, which must
    put them in one definite order (nulls first). The stream must be started with the
    RocksDB state store, as ``get_session`` sets it and ``start`` does in any session."""
    placed = {f"k{i}": F.col(k) for i, k in enumerate(keys)}
    short = list(placed)
    for i, c in enumerate(order):
        placed |= {f"o{i}set": F.col(c).isNotNull(),
                   f"o{i}to": F.coalesce(c, _default(df.schema[c].dataType))}
    kind = df.schema[value].dataType
    placed |= {"value": F.coalesce(value, F.lit(0).cast(kind)), "missing": F.isnull(value)}
    rows = df.select(*[c.alias(n) for n, c in placed.items()]).groupBy(*short)
    total = rows.agg(F.sum("value")).schema[-1].dataType
    output = StructType([
        *[StructField(n, df.schema[k].dataType) for n, k in zip(short, keys, strict=True)],
        StructField("pane", LongType()), StructField("total", total)])
    state = StructType([StructField("pane", LongType()), StructField("n", LongType()),
                        StructField("total", total)])
    panes = rows.applyInPandasWithState(
        _cutter(size), output, state, "append", GroupStateTimeout.NoTimeout)
    return panes.toDF(*keys, "pane", name)


def _default(kind: DataType) -> Column:
    """Stands for a missing value of an order column, which is told apart by its flag."""
    if isinstance(kind, NumericType):
        return F.lit(0).cast(kind)
    if isinstance(kind, StringType):
        return F.lit("")
    return F.lit("1970-01-01").cast(kind)
