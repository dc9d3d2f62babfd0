import os
import time

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_plans import SALES, sale_messages

from millstream import operators as op
from millstream.functions.text import pair_text, to_bytes
from millstream.plans import sales
from millstream.sinks import TapListener, publish, shown, tap, tap_stream, write_messages
from millstream.sources import read_messages, to_messages
from millstream.sources.topics import drop_repeats
from millstream.streaming import count_trigger, run_available, sentinel_message, stream_to_table

FUTURE = "2150-01-01 00:00:00"
CLOSING_SALE = f"END,Mumbai,P,END,0,0,0,{5_000_000_000}"


@pytest.fixture
def topic(scratch):
    return f"dir:{scratch('topic')}"


def closed(spark, messages, topic, step, scratch):
    """Rows of a windowed step over a topic that ends with a sentinel."""
    publish(messages, topic)
    result, checkpoint = scratch("result"), scratch("checkpoint")
    for last in (False, True):
        if last:
            publish(sentinel_message(spark, to_bytes(F.lit(CLOSING_SALE)), FUTURE), topic)
        stream = step(read_messages(spark, topic=topic))
        run_available(stream_to_table(stream, result, checkpoint))
    found = spark.read.parquet(result)
    key = "store_id" if "store_id" in found.columns else "product_category"
    return found.where(F.col(key) != "END")


def arrived(messages):
    return sales.sales_from_messages(messages.withWatermark("element_time", "0 seconds"))


@pytest.mark.parametrize("window", [
    sales.profit_by_fixed_window, sales.profit_by_sliding_window, sales.pieces_by_session])
def test_arrival_time_windows_on_stream_and_table(spark, topic, scratch, window):
    messages = sale_messages(spark)
    got = closed(spark, messages, topic, lambda m: window(arrived(m)), scratch)
    table = messages.withColumn("element_time", F.col("publish_time"))
    want = window(sales.sales_from_messages(table))
    assert rows(got.select(*want.columns)) == rows(want)


def test_event_time_window_on_stream_and_table(spark, topic, scratch):
    messages = sale_messages(spark)

    def step(m):
        timed = sales.with_event_time(sales.sales_from_messages(m), delay="1000 seconds")
        return sales.profit_by_fixed_window(timed)

    got = closed(spark, messages, topic, step, scratch)
    table = sales.with_event_time(sales.sales_from_messages(
        messages.withColumn("element_time", F.col("publish_time"))))
    want = sales.profit_by_fixed_window(table)
    assert rows(got.select(*want.columns)) == rows(want)


def late_run(spark, topic, scratch, delay):
    """Two sales in one batch, then one 60 s older than the newest in the next."""
    result, checkpoint = scratch("result"), scratch("checkpoint")
    dropped = 0
    for text in ("S1,Mumbai,P,T,1,0,1,1000\nS1,Mumbai,P,T,1,0,1,1060", "S1,Mumbai,P,T,1,0,5,1001",
                 CLOSING_SALE):
        publish(sale_messages(spark, text), topic)
        timed = sales.with_event_time(
            sales.sales_from_messages(read_messages(spark, topic=topic)), delay=delay)
        query = run_available(
            stream_to_table(sales.profit_by_fixed_window(timed), result, checkpoint))
        dropped += sum(
            op["numRowsDroppedByWatermark"]
            for p in query.recentProgress for op in p["stateOperators"])
    found = spark.read.parquet(result).where("store_id = 'S1'")
    return dropped, sorted(r["total"] for r in found.collect())


@pytest.mark.parametrize("delay,expected", [
    ("0 seconds", (1, [1, 1])), ("120 seconds", (0, [1, 6]))])
def test_late_rows_are_dropped(spark, topic, scratch, delay, expected):
    assert late_run(spark, topic, scratch, delay) == expected


def panes_of(spark, topic, result, checkpoint, size=sales.PANE_ROWS):
    kept = sales.sales_from_messages(read_messages(spark, topic=topic, with_attributes=True))
    run_available(stream_to_table(
        count_trigger(kept, ["store_id"], ["element_time", "message_id"], "profit", size),
        result, checkpoint))
    return spark.read.schema("store_id string, pane long, total long").parquet(result)


def numbered_sales(spark, numbers, line="S{key},Mumbai,P,T,1,0,{i}"):
    frame = spark.createDataFrame(
        [(line.format(key=i % 2 + 1, i=i), i) for i in numbers], "line string, at int")
    return to_messages(frame, to_bytes("line"), message_id=F.lpad(F.col("at").cast("string"), 9, "0"),
                       publish_time=F.timestamp_seconds("at"))


def test_count_trigger_goes_on_over_batches(spark, topic, scratch):
    """The first batch has no rows that count, later ones hold them in another order."""
    result, checkpoint = scratch("result"), scratch("checkpoint")
    publish(numbered_sales(spark, [0, 1], "S{key},Pune,P,T,1,0,{i}"), topic)
    assert panes_of(spark, topic, result, checkpoint).count() == 0
    for part in (range(12, 1, -1), range(13, 14), range(40, 13, -1)):
        publish(numbered_sales(spark, part), topic)
        found = panes_of(spark, topic, result, checkpoint)
        again = panes_of(spark, topic, result, checkpoint)  # nothing new
        assert rows(again) == rows(found)
    table = numbered_sales(spark, range(2, 41)).withColumn("element_time", F.col("publish_time"))
    want = rows(sales.profit_by_panes(sales.sales_from_messages(table)))
    assert rows(found) == want and len(want) == 7


def test_a_batch_that_runs_again_gives_the_same_panes(spark, topic, scratch):
    """The commit of a batch is lost: it runs once more from the state before it."""
    result, checkpoint = scratch("result"), scratch("checkpoint")
    publish(numbered_sales(spark, range(14)), topic)
    panes_of(spark, topic, result, checkpoint)
    publish(numbered_sales(spark, range(14, 33)), topic)
    want = rows(panes_of(spark, topic, result, checkpoint))
    done = sorted(int(f) for f in os.listdir(f"{checkpoint}/commits") if f.isdigit())
    for f in (f"{done[-1]}", f".{done[-1]}.crc"):
        os.remove(f"{checkpoint}/commits/{f}")
    assert rows(panes_of(spark, topic, result, checkpoint)) == want and len(want) == 6


def test_count_trigger_with_missing_keys_and_values(spark, topic, scratch):
    """Also with decimals, which stay exact, and nulls among the order columns."""
    data = [(None, 1, None), (None, 2, "0.10"), ("a", 1, None), ("a", 2, None), (None, 3, "0.20"),
            ("a", None, "5.00"), (None, None, "1.00")]
    frame = spark.createDataFrame(data, "k string, o int, v string")
    publish(to_messages(frame, F.to_json(F.struct("*")).cast("binary")), topic)
    row = F.from_json(F.col("data").cast("string"), "k string, o int, v decimal(10,2)")
    stream = read_messages(spark, topic=topic).select(row.alias("r")).select("r.*")
    panes = count_trigger(stream, ["k"], ["o"], "v", 2, "sum")
    assert panes.schema["sum"].dataType.simpleString() == "decimal(20,2)"
    result = scratch("result")
    run_available(stream_to_table(panes, result, scratch("checkpoint")))
    got = {(r["k"], r["pane"]): r["sum"] and str(r["sum"])
           for r in spark.read.parquet(result).collect()}
    assert got == {(None, 0): "1.00", (None, 1): "0.30", ("a", 0): "5.00"}


@pytest.mark.parametrize("salts", [0, 3])
def test_repeated_ids_on_a_stream(spark, topic, scratch, salts):
    ids = spark.range(400, numPartitions=4).select((F.col("id") % 7).cast("string").alias("i"))
    result, checkpoint = scratch("result"), scratch("checkpoint")
    for _ in range(2):
        publish(to_messages(ids, F.encode("i", "UTF-8"), message_id=F.col("i"),
                            publish_time=F.timestamp_seconds(F.lit(1000))), topic)
        stream = read_messages(spark, topic=topic, with_attributes=True)
        unique = drop_repeats(stream, "message_id", "element_time", "1 hour", salts)
        run_available(stream_to_table(unique, result, checkpoint))
    assert rows(spark.read.parquet(result).select("message_id")) == [(str(i),) for i in range(7)]


def test_id_label_on_a_stream(spark, topic, scratch):
    ids = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "2")], "d string, uid string")
    publish(to_messages(ids, F.encode("d", "UTF-8"), attributes={"uid": F.col("uid")}), topic)
    result = scratch("result")
    stream = read_messages(spark, topic=topic, id_label="uid")
    assert stream.columns == ["data", "element_time"]
    run_available(stream_to_table(stream, result, scratch("checkpoint")))
    assert spark.read.parquet(result).count() == 2


def test_passthrough_and_stamps(spark, topic, scratch):
    publish(sale_messages(spark), topic)
    out = f"dir:{scratch('out')}"
    run_available(write_messages(
        read_messages(spark, topic=topic), out, scratch("checkpoint"),
        id_label="uid", timestamp_attribute="sent"))
    got = read_messages(spark, subscription=out, streaming=False, with_attributes=True).collect()
    assert sorted(bytes(r["data"]).decode().strip() for r in got) == sorted(
        SALES.strip().split("\n"))
    assert all(r["attributes"]["uid"] == r["message_id"] and r["attributes"]["sent"].isdigit()
               for r in got)
    assert len({r["message_id"] for r in got}) == len(got)
    # whole messages with their attributes pass unchanged
    again = f"dir:{scratch('again')}"
    run_available(write_messages(
        read_messages(spark, topic=out, with_attributes=True).drop("element_time"),
        again, scratch("checkpoint"), with_attributes=True))
    copied = read_messages(spark, topic=again, streaming=False, with_attributes=True)
    assert sorted(r["message_id"] for r in copied.collect()) == sorted(
        r["message_id"] for r in got)


def test_results_as_payloads_of_a_topic(spark, topic, scratch):
    publish(sale_messages(spark), topic)
    publish(sentinel_message(spark, to_bytes(F.lit(CLOSING_SALE)), FUTURE), topic)
    out, checkpoint = f"dir:{scratch('out')}", scratch("checkpoint")
    totals = sales.profit_by_fixed_window(arrived(read_messages(spark, topic=topic)))
    run_available(write_messages(
        totals, out, checkpoint, data=sales.result_payload("store_id")))
    got = read_messages(spark, topic=out, streaming=False)
    texts = {bytes(r["data"]).decode() for r in got.collect()}
    assert {"('S2', 15)", "('S1', 10)", "('S1', -10)"} <= texts


def test_tap_on_a_stream(spark, topic, scratch):
    publish(sale_messages(spark), topic)
    query = run_available(stream_to_table(
        tap_stream(read_messages(spark, topic=topic), "seen"), scratch("r"), scratch("c")))
    seen = sum(p["observedMetrics"]["seen"]["rows"] for p in query.recentProgress
               if "seen" in (p["observedMetrics"] or {}))
    assert seen == 6


def test_taps_show_rows(spark, topic, scratch):
    """Few, the same ones on every run, also from a stream while it runs."""
    table = spark.range(500, numPartitions=7).select("id", (F.col("id") % 3).alias("a.b"))
    got = []
    for parts in (2, 5):
        tapped, seen = tap(table.repartition(parts), "t", show=4)
        assert tapped.count() == 500 and seen.get["rows"] == 500
        got.append(shown(seen.get))
    assert got[0] == got[1] and 1 <= len(got[0]) <= 4
    assert all(r["a.b"] == r["id"] % 3 and 0 <= r["id"] < 500 for r in got[0])
    tapped, seen = tap(table.where("id < 0"), "none", show=2)
    assert tapped.count() == 0 and shown(seen.get) == []

    publish(sale_messages(spark), topic)
    heard = []
    listener = TapListener("seen", lambda *a: heard.append(a))
    spark.streams.addListener(listener)
    try:
        rows_in = sales.sales_from_messages(read_messages(spark, topic=topic))
        run_available(stream_to_table(
            tap_stream(rows_in.select("store_id", "pieces"), "seen", show=3), scratch("r"),
            scratch("c")))
        deadline = time.time() + 20
        while not heard and time.time() < deadline:
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert [(b, n) for b, n, _ in heard] == [(0, 5)]
    assert {r["store_id"] for r in heard[0][2]} <= {"S1", "S2"} and heard[0][2]


def test_one_function_serves_table_and_stream(spark):
    table = spark.range(3).select(F.lit("k").alias("k"), F.col("id").alias("v"))
    step = op.chain(op.filter_equals("k", "k"), op.map_columns(t=pair_text("k", "v")))
    assert table.transform(step).columns == ["t"]
    stream = spark.readStream.format("rate").load().select(
        F.lit("k").alias("k"), F.col("value").alias("v"))
    assert stream.transform(step).isStreaming
