"""The stream queries: the events become messages of a topic, a stream with its
own checkpoint consumes the topic, and the rows of its sink are the result.

Finite topics end with a sentinel message that closes the last windows. Every
query uses fresh paths in the shared scratch folder.
"""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import operators as op
from ..functions.text import from_bytes, to_bytes
from ..operators.windows import windowed
from ..session import cut_lineage, scratch_path, settings
from ..sinks import publish, write_messages, write_tagged_messages
from ..sources.topics import drop_repeats, read_messages, to_messages
from ..streaming import (
    count_trigger, run_available, run_to_end, sentinel_message, stream_to_table,
)
from .jobs import sales_job
from .registry import query
from .tables import event_records
from .window_queries import ARRIVAL_SQL, FIXED_SQL, PANES_SQL, SESSION_SQL, SLIDING_SQL

EVENT_FIELDS = ["event_id", "user_id", "event_type", "cents", "at"]
EVENT_JSON = "event_id bigint, user_id bigint, event_type string, cents bigint, at bigint"
SENTINEL = "sentinel"
NO_ZONE = "timestamp_ntz"

CENTS = "CAST(round(value * 100) AS BIGINT)"


@dataclass
class Topic:
    """A topic of this run and the paths around it."""

    spark: SparkSession
    place: str
    result: str
    checkpoint: str
    kind: str = "dir"

    @property
    def uri(self) -> str:
        return f"{self.kind}:{self.place}"

    def read(self, **kwargs) -> DataFrame:
        return read_messages(self.spark, topic=self.uri, with_attributes=True, **kwargs)


def new_topic(spark: SparkSession, name: str, kind: str = "dir") -> Topic:
    base = scratch_path(spark, name)
    return Topic(spark, f"{base}/topic", f"{base}/result", f"{base}/checkpoint", kind)


def stream_query(sql: str | None = None) -> Callable:
    """Register a query that runs streams. Event times have no zone; they are taken as UTC
    on both sides of the stream, and the result is fixed before the session's own zone
    holds again."""

    def wrap(fn: Callable) -> Callable:
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            with settings(spark, {"spark.sql.session.timeZone": "UTC"}):
                return cut_lineage(fn(spark, sf_dir))

        return query(sql)(run)

    return wrap


def event_messages(
    events: DataFrame, message_id: Column | None = None, publish_time: Column | None = None
) -> DataFrame:
    """Events as messages. The record holds its event time (``at``, microseconds since
    the epoch); the message is published then, or at ``publish_time``."""
    timed = events.withColumn("at", F.unix_micros(F.col("ts").cast("timestamp")))
    return to_messages(
        timed, to_bytes(F.to_json(F.struct(*EVENT_FIELDS))),
        message_id=F.col("event_id") if message_id is None else message_id,
        publish_time=F.col("ts") if publish_time is None else publish_time)


def decoded(messages: DataFrame, from_record: bool = False) -> DataFrame:
    """Messages as event rows with ``ts``: the time in the record, or that of the message."""
    row = F.from_json(from_bytes("data"), EVENT_JSON)
    rows = messages.select("element_time", "message_id", row.alias("e"))
    time = F.timestamp_micros("e.at") if from_record else F.col("element_time")
    return rows.select(time.alias("ts"), "message_id", "e.*").drop("at")


def close(topic: Topic, batches: list[DataFrame]) -> None:
    """Publish the sentinel, two years after the last event."""
    last = max(filter(None, (b.agg(F.max("ts")).first()[0] for b in batches)),
               default=dt.datetime(2000, 1, 1))
    after = (last + dt.timedelta(days=730)).strftime("%Y-%m-%d %H:%M:%S")
    fields = {"event_id": F.lit(-1), "user_id": F.lit(-1), "event_type": F.lit(SENTINEL),
              "cents": F.lit(0), "at": F.unix_micros(F.lit(after).cast("timestamp"))}
    payload = to_bytes(F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()])))
    publish(sentinel_message(topic.spark, payload, after, message_id=F.lit(SENTINEL)),
            topic.uri)


def through_windows(
    spark: SparkSession, name: str, batches: list[DataFrame], delay: str,
    step: Callable[[DataFrame], DataFrame], from_record: bool = False,
) -> DataFrame:
    """Publish each batch and consume it before the next one; the stream starts anew
    from its checkpoint each time. Ends with the sentinel, whose own windows are
    left out of the result."""
    topic = new_topic(spark, name)

    def consume() -> None:
        rows = decoded(topic.read(), from_record).withWatermark("ts", delay)
        run_available(stream_to_table(step(rows), topic.result, topic.checkpoint))

    for batch in batches:
        sent = F.current_timestamp() if from_record else None
        publish(event_messages(batch, publish_time=sent), topic.uri)
        consume()
    close(topic, batches)
    consume()
    result = spark.read.parquet(topic.result)
    for key, mark in (("event_type", SENTINEL), ("user_id", -1)):
        if key in result.columns:
            result = result.where(~F.col(key).eqNullSafe(F.lit(mark)))
    bounds = {c: F.col(c).cast(NO_ZONE) for c in ("window_start", "window_end")}
    return result.withColumns(bounds)


@stream_query(f"SELECT event_id, user_id, event_type, {CENTS} AS cents FROM events")
def stream_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = new_topic(spark, "passthrough-in"), new_topic(spark, "passthrough-out")
    publish(event_messages(event_records(spark, sf_dir)), source.uri)
    messages = read_messages(spark, topic=source.uri)
    run_available(write_messages(messages, target.uri, target.checkpoint))
    arrived = target.read(streaming=False)
    return decoded(arrived).drop("ts", "message_id")


@stream_query(FIXED_SQL)
def stream_fixed_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By the time in the record; when the message was sent plays no part."""
    return through_windows(
        spark, "fixed", [event_records(spark, sf_dir)], "1 hour",
        lambda rows: op.fixed_windows(rows, ["event_type"], "ts", "cents", "1 hour"),
        from_record=True)


@stream_query(ARRIVAL_SQL)
def stream_arrival_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By the time of the message."""
    return through_windows(
        spark, "arrival", [event_records(spark, sf_dir)], "1 hour",
        lambda rows: op.fixed_windows(rows, ["user_id"], "ts", "cents", "1 day"))


@stream_query(SLIDING_SQL)
def stream_sliding_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return through_windows(
        spark, "sliding", [event_records(spark, sf_dir)], "1 hour",
        lambda rows: op.sliding_windows(rows, ["event_type"], "ts", "cents", "2 hours", "1 hour"))


@stream_query(SESSION_SQL)
def stream_session_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return through_windows(
        spark, "session", [event_records(spark, sf_dir)], "1 hour",
        lambda rows: op.session_windows(rows, ["user_id"], "ts", "cents", 6 * 3600))


@stream_query(f"""
WITH moved AS (
  SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 10 DAY AS watermark
  FROM events WHERE event_type <> 'error'
)
SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
       event_type, CAST(sum({CENTS}) AS BIGINT) AS total, count(*) AS n
FROM events, moved
WHERE event_type <> 'error' OR date_trunc('hour', ts) + INTERVAL 1 HOUR > watermark
GROUP BY ALL
""")
def late_data_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors arrive after all other events. Those whose window the watermark has
    passed by then are dropped, the others still count."""
    events = event_records(spark, sf_dir)
    is_error = F.col("event_type") == "error"
    return through_windows(
        spark, "late", [events.where(~is_error), events.where(is_error)], "10 days",
        lambda rows: windowed(
            rows, ["event_type"], "ts", "1 hour", None,
            F.sum("cents").alias("total"), F.count(F.lit(1)).alias("n")))


@stream_query(PANES_SQL)
def stream_count_trigger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first half of January and the rest arrive in separate batches; open panes
    go on from one to the next."""
    topic = new_topic(spark, "panes")
    events = event_records(spark, sf_dir)
    early = F.col("ts") < F.lit("2024-01-15").cast(NO_ZONE)
    for batch in (events.where(early), events.where(~early)):
        publish(event_messages(batch), topic.uri)
        panes = count_trigger(decoded(topic.read()), ["user_id"], ["event_id"], "cents")
        run_available(stream_to_table(panes, topic.result, topic.checkpoint))
    return spark.read.parquet(topic.result)


@stream_query("""
SELECT user_id || '-' || event_type AS message_id, count(DISTINCT user_id || event_type) AS n
FROM events GROUP BY 1
""")
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages with repeated ids: which repeat stays depends on arrival, the ids do not."""
    topic = new_topic(spark, "dedup")
    ids = F.concat_ws("-", "user_id", "event_type")
    publish(event_messages(event_records(spark, sf_dir), ids), topic.uri)
    unique = drop_repeats(topic.read(), "message_id", "element_time", "400 days", salts=4)
    run_available(stream_to_table(
        unique.select("message_id", "element_time"), topic.result, topic.checkpoint))
    return op.count_per_key(spark.read.parquet(topic.result), ["message_id"])




# ---- the options of topics -------------------------------------------------

@stream_query("""
SELECT event_id, event_type, date_trunc('milliseconds', ts) AS element_time FROM events
""")
def stream_read_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two writers publish each event under ids of their own. The reader knows events by
    an attribute and takes their time from another; it admits a few files a batch, is stopped
    after the first batches and goes on from its checkpoint."""
    topic = new_topic(spark, "options", "log")
    events = event_records(spark, sf_dir).withColumn("at", F.col("ts").cast("timestamp"))
    for writer in ("first", "second"):
        publish(to_messages(
            events.repartition(4, "event_id"), to_bytes("event_type"),
            attributes={"uid": F.col("event_id"), "sent": F.unix_millis("at")},
            message_id=F.concat_ws("-", F.lit(writer), "event_id")), topic.uri, writer)

    def stream():
        unique = topic.read(id_label="uid", timestamp_attribute="sent", dedup_delay="400 days",
                            max_rows_per_trigger=1)
        rows = unique.select(F.col("attributes")["uid"].cast("bigint").alias("event_id"),
                             from_bytes("data").alias("event_type"), "element_time")
        return stream_to_table(rows, topic.result, topic.checkpoint, available_now=False)

    query = stream()
    while query.isActive and not (query.lastProgress and query.lastProgress["batchId"] > 0):
        query.awaitTermination(0.1)
    query.stop()
    run_to_end(stream())
    return spark.read.parquet(topic.result).withColumn(
        "element_time", F.col("element_time").cast(NO_ZONE))


@stream_query("""
SELECT event_type, count(*) AS messages, count(*) AS ids, true AS labelled, true AS stamped
FROM events GROUP BY event_type
""")
def stream_write_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that agree in every column become messages with ids of their own; ids and
    publish times are in the attributes too."""
    source, target = (new_topic(spark, f"stamps-{n}", "log") for n in ("in", "out"))
    publish(event_messages(event_records(spark, sf_dir)), source.uri)
    kinds = decoded(source.read()).select("event_type")
    run_to_end(write_messages(
        kinds, target.uri, target.checkpoint, data=to_bytes("event_type"), id_label="uid",
        timestamp_attribute="sent", available_now=False))
    sent = target.read(streaming=False)
    label, stamp = F.col("attributes")["uid"], F.col("attributes")["sent"]
    return sent.groupBy(from_bytes("data").alias("event_type")).agg(
        F.count(F.lit(1)).alias("messages"), F.countDistinct("message_id").alias("ids"),
        F.every(label == F.col("message_id")).alias("labelled"),
        F.every(stamp == F.unix_millis("publish_time").cast("string")).alias("stamped"))


@stream_query(f"""
SELECT CASE WHEN event_type = 'error' THEN 'errors' WHEN {CENTS} >= 5000 THEN 'large' ELSE 'small'
       END AS tag, CAST(event_id AS BIGINT) AS event_id, count(*) AS n
FROM events GROUP BY ALL
""")
def stream_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pass over a stream into three topics; each is read on its own."""
    source = new_topic(spark, "untagged", "log")
    target = new_topic(spark, "tagged", "log")
    publish(event_messages(event_records(spark, sf_dir)), source.uri)
    row = F.from_json(from_bytes("data"), EVENT_JSON)
    rules = [("errors", F.col("row.event_type") == "error"), ("large", F.col("row.cents") >= 5000)]
    tagged = source.read().select(row.alias("row"), "data").transform(
        op.tag_rows(rules, otherwise="small"))
    tags = ["errors", "large", "small"]
    run_to_end(write_tagged_messages(
        tagged, target.place, target.checkpoint, tags, available_now=False))
    outputs = [
        read_messages(spark, topic=f"log:{target.place}/{t}", with_attributes=True,
                      streaming=False).select(F.lit(t).alias("tag"), "data") for t in tags]
    events = F.from_json(from_bytes("data"), EVENT_JSON)["event_id"]
    return op.flatten(*outputs).groupBy("tag", events.alias("event_id")).agg(
        F.count(F.lit(1)).alias("n"))


# ---- store sales from text to text -----------------------------------------

SALES_SQL = f"""
WITH sales AS (
  SELECT 'STR_' || (user_id % 40) AS store_id, 'CAT_' || (user_id % 100) AS category,
         1 + event_id % 7 AS pieces, ({CENTS} - 100) * (1 + event_id % 7) AS profit, ts, event_id
  FROM events WHERE event_type <> 'error'
), results AS ({{}})
SELECT '(''' || key || ''', ' || total || ')' AS line, count(*) AS n FROM results GROUP BY ALL
"""
PROFIT_SQL = """
SELECT store_id AS key, CAST(sum(profit) AS BIGINT) AS total FROM {} GROUP BY store_id, {}"""


def sale_lines(events: DataFrame) -> DataFrame:
    """Events as lines of text: errors are sales of a city that no job looks at."""
    city = F.when(F.col("event_type") == "error", "Pune").when(
        F.col("user_id") % 2 == 0, "Mumbai").otherwise("Bangalore")
    line = F.concat_ws(
        ",", F.concat(F.lit("STR_"), F.col("user_id") % 40), city, F.lit("P1"),
        F.concat(F.lit("CAT_"), F.col("user_id") % 100), 1 + F.col("event_id") % 7, F.lit(100),
        "cents", F.unix_seconds(F.col("ts").cast("timestamp")))
    return to_messages(  # the ids sort as the events do
        events, to_bytes(F.concat(F.lit(" "), line, F.lit("\r\n"))),
        message_id=F.lpad(F.col("event_id").cast("string"), 19, "0"), publish_time=F.col("ts"))


def sales_stream(spark: SparkSession, sf_dir: str, kind: str, delay: str = "1 hour") -> DataFrame:
    """The job over a log that ends with a sale far in the future; its results as text, with
    how often each occurs."""
    source, target = (new_topic(spark, f"sales-{n}", "log") for n in ("in", "out"))
    publish(sale_lines(event_records(spark, sf_dir)), source.uri)

    def run() -> None:
        run_to_end(sales_job(spark, kind, source.uri, target.uri, target.checkpoint, delay=delay))

    run()
    if kind != "panes":
        end = to_bytes(F.lit("END,Mumbai,P1,END,0,0,0,5000000000"))
        publish(sentinel_message(spark, end, "2128-06-11 08:53:20", message_id=F.lit(SENTINEL)),
                source.uri)
        run()
    sent = target.read(streaming=False).select(from_bytes("data").alias("line"))
    return sent.where(~F.col("line").startswith("('END'")).groupBy("line").agg(
        F.count(F.lit(1)).alias("n"))


BUCKET = "time_bucket(INTERVAL 5 SECOND, ts)"


@stream_query(SALES_SQL.format(PROFIT_SQL.format("sales", BUCKET)))
def stream_sales_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_stream(spark, sf_dir, "fixed_event_time")


@stream_query(SALES_SQL.format(PROFIT_SQL.format("sales", BUCKET)))
def stream_sales_arrival_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_stream(spark, sf_dir, "fixed_arrival_time")


@stream_query(SALES_SQL.format(PROFIT_SQL.format(
    "sales CROSS JOIN (VALUES (0), (1)) AS o(k)", f"epoch({BUCKET}) - 5 * k")))
def stream_sales_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_stream(spark, sf_dir, "sliding")


@stream_query(SALES_SQL.format("""
SELECT category AS key, CAST(sum(pieces) AS BIGINT) AS total FROM (
  SELECT *, sum(opens) OVER (PARTITION BY category ORDER BY ts, event_id) AS session FROM (
    SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY category ORDER BY ts, event_id)
      + INTERVAL 10 SECOND THEN 0 ELSE 1 END AS opens FROM sales))
GROUP BY category, session"""))
def stream_sales_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_stream(spark, sf_dir, "session")


@stream_query(SALES_SQL.format("""
SELECT store_id AS key, CAST(sum(profit) AS BIGINT) AS total FROM (
  SELECT *, (row_number() OVER (PARTITION BY store_id ORDER BY ts, event_id) - 1) // 5 AS pane
  FROM sales)
GROUP BY store_id, pane HAVING count(*) = 5"""))
def stream_sales_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_stream(spark, sf_dir, "panes")
