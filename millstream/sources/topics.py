"""Message topics.

A topic is named by a URI: ``dir:/shared/path`` for a folder of message files,
``log:/shared/path`` for a log of many writers (see ``topic_log``) or
``kafka:name@host:port`` for a Kafka topic. A message is a payload of bytes with
attributes, an id and the time it was published.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .topic_log import FORMAT, MESSAGE_SCHEMA, MessageLog


def topic_parts(uri: str) -> tuple[str, str]:
    """``(kind, place)`` of a topic URI."""
    kind, _, place = uri.partition(":")
    if kind not in ("dir", "log", "kafka") or not place:
        raise ValueError(f"topic URI must start with dir:, log: or kafka:, got {uri!r}")
    return kind, place


def to_messages(
    df: DataFrame,
    data: Column,
    *,
    attributes: dict[str, Column] | None = None,
    message_id: Column | None = None,
    publish_time: Column | None = None,
    id_label: str | None = None,
    timestamp_attribute: str | None = None,
    content_ids: bool = True,
) -> DataFrame:
    """Rows as messages. ``id_label`` also puts the id under that attribute name,
    ``timestamp_attribute`` the publish time in milliseconds since the epoch.

    Without ``message_id`` a row keeps the id it has, or gets one that a task that runs
    again gives it again: from its content and, in a table, its place. Rows of a stream
    that agree in every column then share an id. ``content_ids=False`` leaves such ids to the
    topic: a log gives each message one of its own when it is published.
    """
    if message_id is None and "message_id" in df.columns:
        message_id = F.col("message_id")
    if message_id is None and content_ids:
        message_id = _content_id(df, data)
    staged = df.select(
        data.cast("binary").alias("data"),
        (F.lit(None) if message_id is None else message_id).cast("string").alias("message_id"),
        (publish_time if publish_time is not None else F.current_timestamp())
        .cast("timestamp").alias("publish_time"),
        *[c.cast("string").alias(f"attr_{i}") for i, c in enumerate((attributes or {}).values())],
    )
    pairs: list[Column] = []
    for i, name in enumerate(attributes or {}):
        pairs += [F.lit(name), F.col(f"attr_{i}")]
    if id_label and (content_ids or message_id is not None):
        pairs += [F.lit(id_label), F.col("message_id")]
    if timestamp_attribute:
        pairs += [F.lit(timestamp_attribute), F.unix_millis("publish_time").cast("string")]
    attribute_map = (
        F.create_map(*pairs) if pairs else F.expr("cast(map() as map<string,string>)")
    )
    return staged.select("data", attribute_map.alias("attributes"), "message_id", "publish_time")


def _content_id(df: DataFrame, data: Column) -> Column:
    row = F.concat_ws("|", F.hex(data.cast("binary")), F.to_json(F.struct("*"))) if df.columns \
        else F.hex(data.cast("binary"))
    if not df.isStreaming:
        row = F.concat_ws("|", row, F.monotonically_increasing_id())
    return F.sha2(row, 256)


def read_messages(
    spark: SparkSession,
    topic: str | None = None,
    subscription: str | None = None,
    *,
    with_attributes: bool = False,
    id_label: str | None = None,
    timestamp_attribute: str | None = None,
    streaming: bool = True,
    max_files_per_trigger: int | None = None,
    max_rows_per_trigger: int | None = None,
    dedup_delay: str = "10 minutes",
) -> DataFrame:
    """Messages of a topic as a stream, or as a table with ``streaming=False``.

    Columns: ``data`` and ``element_time``, plus the other message fields with
    ``with_attributes``. ``element_time`` is the publish time, or the named
    attribute (milliseconds since the epoch). ``id_label`` names the attribute
    that identifies a message; repeats of one id are dropped. What a micro-batch admits is
    limited by files for a folder and by rows, in whole files, for a log.
    """
    if (topic is None) == (subscription is None):
        raise ValueError("give either topic or subscription, and not both")
    kind, place = topic_parts(topic or subscription)
    if kind == "dir":
        raw = _from_directory(spark, place, streaming, max_files_per_trigger)
    elif kind == "log":
        raw = _from_log(spark, place, streaming, max_rows_per_trigger)
    else:
        raw = _from_kafka(spark, place, streaming, subscription is not None)
    messages = raw.withColumn("element_time", element_time(timestamp_attribute))
    if id_label:
        label = F.coalesce(F.col("attributes")[id_label], F.col("message_id"))
        messages = messages.withColumn("dedup_id", label)
        messages = drop_repeats(messages, "dedup_id", "element_time", dedup_delay)
        messages = messages.drop("dedup_id")
    return messages if with_attributes else messages.select("data", "element_time")


def element_time(timestamp_attribute: str | None = None) -> Column:
    """Publish time, or an attribute in milliseconds since the epoch if it is there."""
    if timestamp_attribute is None:
        return F.col("publish_time")
    millis = F.try_element_at("attributes", F.lit(timestamp_attribute)).cast("bigint")
    return F.coalesce(F.timestamp_millis(millis), F.col("publish_time"))


def drop_repeats(
    df: DataFrame, id_column: str, time_column: str, delay: str, salts: int = 0
) -> DataFrame:
    """One message per id. A stream remembers an id for ``delay`` of event time; a
    table keeps the message with the earliest time.

    On a stream ``salts`` spreads the repeats of a very frequent id over that many
    tasks, each of which passes on one, before the final step sees them.
    """
    if not df.isStreaming:
        return first_per_id(df, [id_column], F.col(time_column))
    rows = df.withWatermark(time_column, delay)
    if salts:
        rows = (
            rows.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
            .dropDuplicatesWithinWatermark([id_column, "_salt"]).drop("_salt")
        )
    return rows.dropDuplicatesWithinWatermark([id_column])


def first_per_id(df: DataFrame, ids: list[str], order: Column) -> DataFrame:
    """The row with the smallest ``order`` for every id, of several the one with the
    smallest message id, then payload, then other columns; repeats collapse before the
    shuffle."""
    rest = [c for c in df.columns if c not in ids]
    sorted_kinds = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    ties = [c for c in ("message_id", "data") if c in rest]
    ties += [c for c in rest if c in sorted_kinds and c not in ties]
    first = F.struct(order.alias("_order"), *ties)
    kept = df.groupBy(*ids).agg(F.min_by(F.struct(*rest), first).alias("kept"))
    return kept.select(*ids, "kept.*").select(*df.columns)


def _from_directory(
    spark: SparkSession, place: str, streaming: bool, max_files: int | None
) -> DataFrame:
    if not streaming:
        return spark.read.schema(MESSAGE_SCHEMA).parquet(place)
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(place)


def _from_log(
    spark: SparkSession, place: str, streaming: bool, max_rows: int | None
) -> DataFrame:
    spark.dataSource.register(MessageLog)
    reader = (spark.readStream if streaming else spark.read).format(FORMAT).option("path", place)
    return (reader.option("rows_per_batch", max_rows) if max_rows else reader).load()


def kafka_options(place: str, is_subscription: bool = False) -> dict[str, str]:
    """Options from ``name@servers``, or ``name/group@servers`` for a subscription."""
    name, _, servers = place.partition("@")
    if not servers:
        raise ValueError("a Kafka topic is written name@host:port")
    name, _, group = name.partition("/")
    options = {"kafka.bootstrap.servers": servers, "subscribe": name}
    if is_subscription and group:
        options["kafka.group.id"] = group
    return options


def _from_kafka(
    spark: SparkSession, place: str, streaming: bool, is_subscription: bool
) -> DataFrame:
    reader = spark.readStream if streaming else spark.read
    options = kafka_options(place, is_subscription) | {"includeHeaders": "true"}
    if not is_subscription:
        options["startingOffsets"] = "earliest"
    rows = reader.format("kafka").options(**options).load()
    headers = F.map_from_entries(
        F.transform("headers", lambda h: F.struct(h["key"], h["value"].cast("string")))
    )
    return rows.select(
        F.col("value").alias("data"),
        F.coalesce(headers, F.expr("cast(map() as map<string,string>)")).alias("attributes"),
        F.concat_ws("-", "topic", "partition", "offset").alias("message_id"),
        F.col("timestamp").alias("publish_time"),
    )
