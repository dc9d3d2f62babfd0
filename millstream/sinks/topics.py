"""Write messages to a topic, from a table or from a stream."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..streaming.runner import start
from ..sources.topic_log import FORMAT, MessageLog
from ..sources.topics import kafka_options, to_messages, topic_parts


def publish(messages: DataFrame, topic: str, writer: str | None = None) -> None:
    """Append a table of messages to a topic. In a log it is the next part of the shard
    ``writer``, or of a shard of its own."""
    kind, place = topic_parts(topic)
    if kind == "dir":
        messages.write.mode("append").parquet(place)
    elif kind == "log":
        messages.sparkSession.dataSource.register(MessageLog)
        sink = messages.write.format(FORMAT).mode("append").option("path", place)
        (sink.option("writer", writer) if writer else sink).save()
    else:
        _kafka_rows(messages).write.format("kafka").options(**_kafka_sink(place)).save()


def write_messages(
    df: DataFrame,
    topic: str,
    checkpoint: str,
    *,
    data: Column | None = None,
    with_attributes: bool = False,
    message_id: Column | None = None,
    id_label: str | None = None,
    timestamp_attribute: str | None = None,
    available_now: bool = True,
    every: str | None = None,
) -> StreamingQuery:
    """Start a stream into a topic. The frame holds message columns with
    ``with_attributes``; otherwise ``data`` is its payload and ``message_id`` its id.

    A log publishes every micro-batch once, also if it runs again, under the shard that the
    checkpoint names; rows without an id, equal ones too, each get one of their own there."""
    kind, place = topic_parts(topic)
    messages = df
    if not with_attributes:
        messages = to_messages(
            df,
            F.col("data") if data is None else data,
            message_id=message_id,
            content_ids=kind != "log",
            id_label=id_label,
            timestamp_attribute=timestamp_attribute,
        )
    if kind == "dir":
        writer = messages.writeStream.format("parquet").option("path", place)
    elif kind == "log":
        df.sparkSession.dataSource.register(MessageLog)
        shard = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]
        writer = messages.writeStream.format(FORMAT).options(
            path=place, writer=shard, **({"id_label": id_label} if id_label else {}))
    else:
        writer = _kafka_rows(messages).writeStream.format("kafka").options(**_kafka_sink(place))
    writer = writer.outputMode("append").option("checkpointLocation", checkpoint)
    if every:
        writer = writer.trigger(processingTime=every)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return start(writer, df)


def _kafka_sink(place: str) -> dict[str, str]:
    options = kafka_options(place)
    options["topic"] = options.pop("subscribe")
    return options | {"includeHeaders": "true"}


def _kafka_rows(messages: DataFrame) -> DataFrame:
    headers = F.transform(
        F.map_entries("attributes"),
        lambda e: F.struct(e["key"].alias("key"), e["value"].cast("binary").alias("value")),
    )
    return messages.select(F.col("data").alias("value"), headers.alias("headers"))
