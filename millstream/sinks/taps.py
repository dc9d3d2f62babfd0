"""Look at rows on their way without changing them.

A tap counts the rows that pass and shows some of them, as JSON. Which rows are shown follows from
hashes of the rows: for each of ``show`` seeds the row with the smallest one. So a task keeps
``show`` rows at most, tasks are merged by a minimum, no extra pass is made, and rows that
run again are the same ones.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


def _metrics(df: DataFrame, show: int) -> list[Column]:
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    return [F.count(F.lit(1)).alias("rows"), *[
        F.min(F.struct(F.xxhash64(F.lit(seed), row).alias("hash"), row.alias("row"))).alias(f"row{seed}")
        for seed in range(show)]]


def tap(df: DataFrame, name: str, show: int = 0) -> tuple[DataFrame, Observation]:
    """The same rows plus an observation; after an action on the frame,
    ``observation.get["rows"]`` tells how many passed, ``shown(observation.get)`` some of them."""
    observation = Observation(name)
    return df.observe(observation, *_metrics(df, show)), observation


def tap_stream(df: DataFrame, name: str, show: int = 0) -> DataFrame:
    """The same stream; counts and rows per batch appear under ``observedMetrics``, and reach
    a ``TapListener``."""
    return df.observe(name, *_metrics(df, show))


def shown(metrics: Mapping[str, Any]) -> list[dict]:
    """The rows that a tap shows, each once, in the order of their JSON."""
    found = {metrics[k]["row"] for k in metrics if k != "rows" and metrics[k] is not None}
    return [json.loads(r) for r in sorted(r for r in found if r is not None)]


class TapListener(StreamingQueryListener):
    """Hands what the taps ``name`` of running streams have seen to ``use(batch, rows,
    shown rows)``, batch by batch. Add it with ``spark.streams.addListener``."""

    def __init__(self, name: str, use: Callable[[int, int, list[dict]], None]):
        self.name, self.use = name, use

    def onQueryStarted(self, event: Any) -> None:
        pass

    def onQueryProgress(self, event: Any) -> None:
        seen = (event.progress.observedMetrics or {}).get(self.name)
        if seen is not None and seen["rows"]:
            metrics = seen.asDict()
            self.use(event.progress.batchId, metrics["rows"], shown(metrics))

    def onQueryIdle(self, event: Any) -> None:
        pass

    def onQueryTerminated(self, event: Any) -> None:
        pass
