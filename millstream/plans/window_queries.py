"""Queries of the windows, on tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import operators as op
from ..sources.topics import element_time, first_per_id
from .registry import query
from .tables import event_records

CENTS = "CAST(round(value * 100) AS BIGINT)"
NO_ZONE = "timestamp_ntz"

FIXED_SQL = f"""
SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
       event_type, CAST(sum({CENTS}) AS BIGINT) AS total
FROM events GROUP BY ALL
"""

ARRIVAL_SQL = f"""
SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start,
       time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end,
       user_id, CAST(sum({CENTS}) AS BIGINT) AS total
FROM events GROUP BY ALL
"""

SLIDING_SQL = f"""
SELECT window_start, window_start + INTERVAL 2 HOUR AS window_end, event_type,
       CAST(sum({CENTS}) AS BIGINT) AS total
FROM (
  SELECT date_trunc('hour', ts) - to_hours(k) AS window_start, event_type, value
  FROM events CROSS JOIN (VALUES (0), (1)) AS o(k)
) GROUP BY ALL
"""

SESSION_SQL = f"""
WITH opened AS (
  SELECT user_id, ts, {CENTS} AS cents,
         CASE WHEN ts < lag(ts) OVER w + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS opens
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
), numbered AS (
  SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts
                             RANGE UNBOUNDED PRECEDING) AS session FROM opened
)
SELECT min(ts) AS window_start, max(ts) + INTERVAL 6 HOUR AS window_end, user_id,
       CAST(sum(cents) AS BIGINT) AS total, count(*) AS n
FROM numbered GROUP BY user_id, session
"""

PANES_SQL = f"""
SELECT user_id, CAST(pane AS BIGINT) AS pane, CAST(sum(cents) AS BIGINT) AS total FROM (
  SELECT user_id, {CENTS} AS cents,
         (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 5 AS pane
  FROM events)
GROUP BY 1, 2 HAVING count(*) = 5
"""


@query(FIXED_SQL)
def fixed_window_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.fixed_windows(event_records(spark, sf_dir), ["event_type"], "ts", "cents", "1 hour")


@query(ARRIVAL_SQL)
def fixed_window_arrival_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrived = event_records(spark, sf_dir).withColumnRenamed("ts", "publish_time")
    return op.fixed_windows(arrived, ["user_id"], "publish_time", "cents", "1 day")


@query(SLIDING_SQL)
def sliding_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.sliding_windows(
        event_records(spark, sf_dir), ["event_type"], "ts", "cents", "2 hours", "1 hour")


@query(SESSION_SQL)
def session_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.session_windows(
        event_records(spark, sf_dir), ["user_id"], "ts", "cents", 6 * 3600)


@query(PANES_SQL)
def count_trigger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.count_panes(event_records(spark, sf_dir), ["user_id"], ["event_id"], "cents", 5)


@query(PANES_SQL)
def count_trigger_in_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every key with more than 20 events is ranked per slice of its own arrival order."""
    return op.count_panes(
        event_records(spark, sf_dir), ["user_id"], ["event_id"], "cents", 5, hot_rows=20)


DEDUP_SQL = f"""
SELECT message_id, event_id, cents FROM (
  SELECT user_id || '-' || event_type AS message_id, event_id, {CENTS} AS cents,
         row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS rn
  FROM events) WHERE rn = 1
"""


@query(DEDUP_SQL)
def dedup_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = event_records(spark, sf_dir).select(
        F.concat_ws("-", "user_id", "event_type").alias("message_id"), "event_id", "cents")
    return first_per_id(messages, ["message_id"], F.col("event_id"))


@query("""
SELECT event_id, date_trunc('milliseconds', ts) AS element_time FROM events
""")
def timestamp_from_millis(spark: SparkSession, sf_dir: str) -> DataFrame:
    zero = F.lit("1970-01-01 00:00:00").cast(NO_ZONE)
    millis = F.timestamp_diff("MILLISECOND", zero, F.col("ts"))
    stamped = event_records(spark, sf_dir).select(
        "event_id",
        F.create_map(F.lit("sent"), millis.cast("string")).alias("attributes"),
        F.lit(None).cast("timestamp").alias("publish_time"))
    instant = element_time("sent")
    local = F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant.cast(NO_ZONE))
    return stamped.select("event_id", local.alias("element_time"))
