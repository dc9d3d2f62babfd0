"""Run streaming queries over what a topic holds, to a table and to an end."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..session import STATE_STORE, settings
from ..sources.topics import to_messages


def start(writer: DataStreamWriter, df: DataFrame) -> StreamingQuery:
    """Start the stream with the state store that all operators work with. A query takes the
    session's settings when it starts; one that goes on from a checkpoint keeps its own."""
    with settings(df.sparkSession, STATE_STORE):
        return writer.start()


def stream_to_table(
    df: DataFrame, path: str, checkpoint: str, *, available_now: bool = True
) -> StreamingQuery:
    """Start a stream in append mode into Parquet files: a window appears once the
    watermark has passed its end, and rows later than that are dropped."""
    writer = (
        df.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
    )
    return start(writer.trigger(availableNow=True) if available_now else writer, df)


def run_available(query: StreamingQuery, timeout: float | None = None) -> StreamingQuery:
    """Wait until everything available has been read; errors of the query surface here."""
    query.awaitTermination(timeout)
    return query


def run_to_end(query: StreamingQuery) -> StreamingQuery:
    """Let a stream without an end read all that there is, batch by batch under its admission
    limit, and stop it. Spark runs ``available_now`` on a log of messages as one batch, without
    the limit and without the batch that closes windows; this is the way for logs."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return query


def sentinel_message(
    spark: SparkSession, payload: Column, after: dt.datetime | str, **kwargs
) -> DataFrame:
    """One message far in the future. Published behind the data of a finite topic it
    moves the watermark past every open window. Its own rows must be left out when
    the result table is read, not inside the stream."""
    one = spark.range(1).select()
    return to_messages(one, payload, publish_time=F.lit(after).cast("timestamp"), **kwargs)
