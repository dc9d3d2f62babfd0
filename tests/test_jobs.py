"""The jobs from end to end, files to files and topics to topics."""

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_plans import CARDS, DEPT, monthly, sale_messages
from test_streams import CLOSING_SALE, FUTURE

from millstream.functions.text import to_bytes
from millstream.plans import jobs, sales
from millstream.sinks import publish
from millstream.sources import read_messages, read_text, to_messages
from millstream.streaming import run_available, sentinel_message


@pytest.fixture
def files(tmp_path):
    def write(**texts):
        for name, text in texts.items():
            (tmp_path / f"{name}.txt").write_text(text.strip() + "\n")
        return [str(tmp_path / f"{name}.txt") for name in texts]

    return write


def lines_of(spark, path):
    return [r[0] for r in rows(read_text(spark, path))]


def test_department_jobs(spark, files, scratch):
    dept, out, places = files(
        dept=DEPT, out="1\n9", places="1,Pune,2nd floor\n9,Goa")
    targets = [scratch(f"t{i}") for i in range(7)]
    jobs.attendance_counts(spark, dept, targets[0])
    assert "('Kim', 2)" in lines_of(spark, targets[0])
    jobs.attendance_of_departments(spark, dept, targets[1])
    assert {"('Kim', 2, 'Accounts')", "('Joe', 1, 'HR')"} <= set(lines_of(spark, targets[1]))
    jobs.frequent_names(spark, dept, targets[2], minimum=1)
    assert lines_of(spark, targets[2]) == ["('Kim', 2, 'Employee')"]
    jobs.attendance_without_excluded(spark, dept, out, targets[3])
    assert lines_of(spark, targets[3]) == ["(('5', 'Joe'), 1)", "(('6', 'Maximilian'), 1)"]
    jobs.names_in_three_outputs(spark, dept, targets[4])
    assert lines_of(spark, f"{targets[4]}/tag=K") == ["Kim", "Kim"]
    assert lines_of(spark, f"{targets[4]}/tag=Long_Names") == ["Bartholomew", "Maximilian"]
    assert lines_of(spark, f"{targets[4]}/tag=Short_Names") == ["Al", "Joe", "Joe"]
    jobs.employees_with_locations(spark, dept, places, targets[5])
    found = {r["key"]: r for r in map(json.loads, lines_of(spark, targets[5]))}
    assert found["9"] == {"key": "9", "dep_data": [], "loc_data": [["Goa"]]}
    assert len(found["1"]["dep_data"]) == 2
    short = scratch("short")
    jobs.employees_with_locations(spark, dept, places, short, per_line=1)
    ones = [r for r in map(json.loads, lines_of(spark, short)) if r["key"] == "1"]
    assert [len(r["dep_data"]) + len(r["loc_data"]) for r in ones] == [1, 1, 1]
    assert sorted(r["dep_data"][0] for r in ones if r["dep_data"]) == sorted(
        found["1"]["dep_data"])
    jobs.salaries(spark, dept, targets[6])
    assert "1:Kim, 200" in lines_of(spark, targets[6])


def test_other_file_jobs(spark, files, scratch):
    text, card, loan = files(
        text="a b a", card="header\n" + CARDS.strip(),
        loan="header\n" + "\n".join(
            monthly("M", late=(1, 5, 9), category="Medical Loan") + monthly("P", missed=(2, 3))))
    t = [scratch(f"t{i}") for i in range(5)]
    jobs.word_counts(spark, text, t[0])
    assert lines_of(spark, t[0]) == ["a, 2", "b, 1"]
    jobs.card_skippers(spark, card, t[1])
    assert "C5 Ed Poe 3" in lines_of(spark, t[1])
    jobs.loan_defaulters(spark, loan, t[2], t[3])
    assert lines_of(spark, t[2]) == ["M FM LM"]
    assert lines_of(spark, t[3]) == ["M FM LM", "P FP LP"]
    jobs.merged_files(spark, [text, text], t[4])
    assert lines_of(spark, t[4]) == ["a b a", "a b a"]


@pytest.mark.parametrize("kind,expected", [
    ("fixed_event_time", {"('S1', 2)", "('S1', 0)", "('S2', 15)", "('S2', 4)"}),
    ("fixed_arrival_time", {"('S1', 10)", "('S1', -10)", "('S2', 15)", "('S2', 4)", "('S1', 2)"}),
    ("session", {"('Toys', 2)", "('Food', 1)", "('Toys', 3)", "('Food', 4)", "('Toys', 1)"}),
])
def test_sales_jobs(spark, scratch, kind, expected):
    source, target = f"dir:{scratch('in')}", f"dir:{scratch('out')}"
    checkpoint = scratch("checkpoint")
    publish(sale_messages(spark), source)
    for last in (False, True):
        if last:
            publish(sentinel_message(spark, to_bytes(F.lit(CLOSING_SALE)), FUTURE), source)
        run_available(jobs.sales_job(
            spark, kind, source, target, checkpoint, delay="100 seconds", available_now=True))
    got = read_messages(spark, topic=target, streaming=False).select(F.decode("data", "UTF-8"))
    assert {r[0] for r in got.collect() if "END" not in r[0]} == expected


@pytest.mark.parametrize("per_file", [7, 42])
def test_panes_job_counts_in_order_of_arrival(spark, scratch, per_file):
    """Messages of files that hold them in another order than they arrived."""
    source, target = f"dir:{scratch('in')}", f"dir:{scratch('out')}"
    checkpoint = scratch("checkpoint")
    lines = [(f"S1,Mumbai,P1,Toys,1,0,{i}", i) for i in range(42)]
    for start in range(0, 42, per_file):
        part = list(reversed(lines[start:start + per_file]))
        frame = spark.createDataFrame(part, "line string, at int")
        publish(to_messages(frame, to_bytes("line"), publish_time=F.timestamp_seconds("at")), source)
        run_available(jobs.sales_job(
            spark, "panes", source, target, checkpoint, available_now=True))
    got = read_messages(spark, topic=target, streaming=False, with_attributes=True)
    sums = sorted(int(bytes(r["data"]).decode().split(", ")[1][:-1]) for r in got.collect())
    assert sums == [10, 35, 60, 85, 110, 135, 160, 185]
    assert {r["message_id"] for r in got.collect()} == {f"S1-{p}" for p in range(8)}


def test_sliding_job(spark, scratch):
    source, target = f"dir:{scratch('in')}", f"dir:{scratch('out')}"
    checkpoint = scratch("checkpoint")
    publish(sale_messages(spark), source)
    for last in (False, True):
        if last:
            publish(sentinel_message(spark, to_bytes(F.lit(CLOSING_SALE)), FUTURE), source)
        run_available(jobs.sales_job(
            spark, "sliding", source, target, checkpoint, delay="100 seconds", available_now=True))
    got = read_messages(spark, topic=target, streaming=False).select(F.decode("data", "UTF-8"))
    table = sales.sales_from_messages(sale_messages(spark).withColumn(
        "element_time", F.col("publish_time")))
    want = [f"('{r.store_id}', {r.total})" for r in sales.profit_by_sliding_window(table).collect()]
    assert sorted(r[0] for r in got.collect() if "END" not in r[0]) == sorted(want)


def test_passthrough_job(spark, scratch):
    source, target = f"dir:{scratch('in')}", f"dir:{scratch('out')}"
    publish(sale_messages(spark), source)
    run_available(jobs.passthrough(
        spark, source, target, scratch("checkpoint"), available_now=True))
    assert read_messages(spark, topic=target, streaming=False).count() == 6
