"""The worked jobs from end to end: files to files, topics to topics.

Each file job reads text files (globs allowed) and writes text shards to a fresh
folder. Each stream job returns its running query.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.numbers import to_int
from ..functions.text import join_fields, pair_text, strip_all
from ..operators.cogroup import flatten
from ..operators.group_streams import per_group
from ..sinks import write_messages, write_tagged, write_text
from ..sources import read_messages, read_text
from ..streaming import count_trigger
from . import attendance, cards, layouts, loans, sales, words


# ---- files -----------------------------------------------------------------

def _departments(spark: SparkSession, source: str) -> DataFrame:
    return layouts.department_rows(read_text(spark, source))


def attendance_counts(
    spark: SparkSession, source: str, target: str, dept: str = "Accounts"
) -> None:
    """Lines such as ``('Kim', 2)``."""
    counts = attendance.attendance_count(_departments(spark, source), dept)
    write_text(counts, target, pair_text("name", "n"))


def attendance_of_departments(
    spark: SparkSession, source: str, target: str, depts: Sequence[str] = ("Accounts", "HR")
) -> None:
    """Lines such as ``('Kim', 2, 'Accounts')``."""
    counts = attendance.departments_merged(_departments(spark, source), depts)
    write_text(counts, target, pair_text("name", "n", "dept", types=("str", "num", "str")))


def frequent_names(
    spark: SparkSession, source: str, target: str,
    depts: Sequence[str] = ("Accounts", "HR"), minimum: int = 30,
) -> None:
    """Lines such as ``('Kim', 31, 'Employee')``."""
    names = attendance.frequent_names(_departments(spark, source), depts, minimum)
    write_text(names, target, pair_text("name", "n", "tag", types=("str", "num", "str")))


def attendance_without_excluded(
    spark: SparkSession, source: str, exclusions: str, target: str,
    dept: str = "Accounts", lower: int = 3, upper: int | None = 10,
) -> None:
    """Lines such as ``(('5', 'Joe'), 1)``; ``exclusions`` holds one id per line."""
    listed = read_text(spark, exclusions).select(strip_all("value").alias("id"))
    counts = attendance.attendance_with_exclusions(
        _departments(spark, source), listed, dept, lower, upper)
    key = pair_text("id", "name", types=("str", "str"))
    write_text(counts, target, F.concat(F.lit("("), key, F.lit(", "), F.col("n"), F.lit(")")))


def names_in_three_outputs(
    spark: SparkSession, source: str, target: str, cutoff_length: int = 4, marker: str = "K"
) -> None:
    """One pass, a subfolder per kind of name."""
    names = _departments(spark, source).select("name")
    write_tagged(attendance.names_by_kind(names, cutoff_length, marker), target, line="name")


def word_counts(spark: SparkSession, source: str, target: str) -> None:
    write_text(words.word_lines(words.word_count(read_text(spark, source))), target)


def employees_with_locations(
    spark: SparkSession, employees: str, locations: str, target: str, per_line: int = 1000
) -> None:
    """One JSON line per id with the records of both files under ``dep_data`` and
    ``loc_data``; an id with more than ``per_line`` records goes on in further lines."""

    def lines(key, batches):
        record, held, written = {"key": key[0], "dep_data": [], "loc_data": []}, 0, False
        for side, batch in batches:
            for fields in batch.column("fields").to_pylist():
                if held == per_line:
                    yield _json_line(record)
                    record, held, written = record | {"dep_data": [], "loc_data": []}, 0, True
                record[side].append(fields)
                held += 1
        if held or not written:
            yield _json_line(record)

    groups = per_group({
        "dep_data": layouts.keyed_rows(read_text(spark, employees)),
        "loc_data": layouts.keyed_rows(read_text(spark, locations)),
    }, ["key"], lines, "value string")
    write_text(groups, target)


def _json_line(record: dict) -> pa.RecordBatch:
    text = json.dumps(record, separators=(",", ":"), ensure_ascii=False)
    return pa.RecordBatch.from_arrays([pa.array([text])], ["value"])


def card_skippers(
    spark: SparkSession, source: str, target: str, both_bonus: bool = True
) -> None:
    rows = layouts.card_rows(read_text(spark, source, skip_header_lines=1))
    write_text(cards.defaulter_lines(cards.card_defaulters(rows, both_bonus)), target)


def loan_defaulters(
    spark: SparkSession, source: str, medical_target: str, target: str,
    min_missed: int = loans.PERSONAL_MIN_MISSED,
) -> None:
    """Medical defaulters in one place, both kinds in the other. The names are few
    beside the loans; they are kept while both are written."""
    rows = layouts.loan_rows(read_text(spark, source, skip_header_lines=1))
    found = loans.defaulters(loans.late_flags(rows), min_missed=min_missed).persist()
    try:
        write_text(found.where(F.col("tag") == "medical_loan"), medical_target, "name")
        write_text(found, target, "name")
    finally:
        found.unpersist()


def salaries(spark: SparkSession, source: str, target: str) -> None:
    """Lines such as ``7:Kim, 300``."""
    rows = _departments(spark, source).withColumn("salary", to_int("salary"))
    sums = attendance.salary_per_employee(rows)
    key = join_fields(":", F.col("employee.id"), F.col("employee.name"))
    write_text(sums, target, join_fields(", ", key, F.col("total")))


def merged_files(spark: SparkSession, sources: Sequence[str], target: str) -> None:
    """The lines of all sources, repeats kept."""
    write_text(flatten(*[read_text(spark, s) for s in sources]), target)


# ---- topics ----------------------------------------------------------------

def passthrough(
    spark: SparkSession, source: str, target: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Messages keep their ids, so that a reader can drop what a retry has sent twice."""
    messages = read_messages(spark, subscription=source, with_attributes=True)
    return write_messages(messages, target, checkpoint, available_now=available_now)


def _event_time(rows: DataFrame, delay: str) -> DataFrame:
    return sales.profit_by_fixed_window(sales.with_event_time(rows, delay))


def _arrival(window):
    return lambda rows, delay: window(rows.withWatermark("element_time", delay))


SALES_JOBS = {
    "fixed_event_time": (_event_time, "store_id"),
    "fixed_arrival_time": (_arrival(sales.profit_by_fixed_window), "store_id"),
    "sliding": (_arrival(sales.profit_by_sliding_window), "store_id"),
    "session": (_arrival(sales.pieces_by_session), "product_category"),
    "panes": (None, "store_id"),  # counts rows in the order of arrival, without a watermark
}


def sales_job(
    spark: SparkSession, kind: str, source: str, target: str, checkpoint: str,
    *, delay: str = "0 seconds", cities: Sequence[str] = sales.CITIES,
    payload: Column | None = None, on_error: str = "raise", available_now: bool = False,
) -> StreamingQuery:
    """Sales messages in, messages such as ``('STR_2', 216)`` out. ``kind`` is one of
    ``SALES_JOBS``; sales may arrive ``delay`` after newer ones and still count."""
    step, key = SALES_JOBS[kind]
    rows = sales.sales_from_messages(
        read_messages(spark, subscription=source, with_attributes=True), cities, on_error)
    data = sales.result_payload(key) if payload is None else payload
    if kind == "panes":
        panes = count_trigger(
            rows, [key], ["element_time", "message_id"], "profit", sales.PANE_ROWS)
        return write_messages(
            panes, target, checkpoint, data=data, message_id=F.concat_ws("-", key, "pane"),
            available_now=available_now)
    return write_messages(
        step(rows, delay), target, checkpoint, data=data, available_now=available_now)
