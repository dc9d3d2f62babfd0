"""The log of messages as a source and a sink."""

import os

import pyarrow as pa
import pytest
from conftest import rows
from pyspark.sql import functions as F

from millstream.functions.text import to_bytes
from millstream.sinks import publish, write_messages
from millstream.sources import read_messages, to_messages, topic_log
from millstream.sources.topic_log import ARROW_SCHEMA, Log, Slice, StreamReader, read_slice, slices
from millstream.streaming import run_to_end, stream_to_table


@pytest.fixture
def place(scratch):
    return scratch("log")


def numbered(spark, first, n, parts=2):
    frame = spark.range(first, first + n, numPartitions=parts).select(
        F.col("id").cast("string").alias("i"))
    return to_messages(frame, to_bytes("i"), message_id=F.col("i"))


def payloads(df):
    return sorted(int(bytes(r["data"]).decode()) for r in df.select("data").collect())


def all_of(spark, place):
    return read_messages(spark, topic=f"log:{place}", streaming=False, with_attributes=True)


def test_tables_of_several_writers(spark, place):
    publish(numbered(spark, 0, 10), f"log:{place}", "a")
    publish(numbered(spark, 10, 10), f"log:{place}", "a")
    publish(numbered(spark, 20, 5), f"log:{place}")
    publish(numbered(spark, 0, 0), f"log:{place}", "none")  # publishes nothing
    assert payloads(all_of(spark, place)) == list(range(25))
    log = Log(place)
    assert log.epochs("a") == [0, 1] and len(log.writers()) == 2
    with pytest.raises(Exception, match="not a name of a shard"):
        publish(numbered(spark, 0, 1), f"log:{place}", "../x")
    with pytest.raises(Exception, match="only be appended"):
        numbered(spark, 0, 1).write.format(topic_log.FORMAT).mode("overwrite").option(
            "path", place).save()


def test_a_topic_without_messages(spark, place, scratch):
    assert all_of(spark, place).count() == 0
    result = scratch("r")
    run_to_end(stream_to_table(read_messages(spark, topic=f"log:{place}"), result, scratch("c"),
                               available_now=False))


def test_an_epoch_is_published_once_and_as_a_whole(place):
    log = Log(place)

    def message(i):
        return pa.record_batch([pa.array([b"x"]), pa.array([[]], ARROW_SCHEMA[1].type),
                                pa.array([i], pa.string()),
                                pa.array([0], pa.timestamp("us", "UTC"))], ARROW_SCHEMA.names)

    first, second = log.write("w", iter([message("1")])), log.write("w", iter([message("2")]))
    assert log.writers() == []  # written, not published
    assert log.commit("w", 7, [first])
    assert not log.commit("w", 7, [second])
    log.remove("w", [second[0]])
    assert log.committed("w", 7) == [first] and log.names("shards", "w") == [first[0]]
    assert log.write("w", iter([])) is None


def test_offsets_per_shard_and_the_admission_limit(spark, place):
    publish(numbered(spark, 0, 40, 4), f"log:{place}", "a")
    publish(numbered(spark, 40, 20, 2), f"log:{place}", "b")
    publish(numbered(spark, 60, 10, 1), f"log:{place}", "b")
    reader = StreamReader(place, 30)
    seen, start = [], reader.initialOffset()
    sizes = []
    while (end := reader.latestOffset()) != start:
        parts = reader.partitions(start, end)
        got = [int(bytes(v.as_py()).decode()) for p in parts for b in reader.read(p)
               for v in b.column(0)]
        sizes.append(len(got))
        seen += got
        start = end
    assert sorted(seen) == list(range(70)) and sizes == [30, 30, 10]
    assert set(start) == {"a", "b"}
    # a reader that goes on learns its place from the last batch that the engine plans
    again = StreamReader(place, 30)
    half = {"a": [0, 2], "b": [0, 1]}
    again.partitions({}, half)
    assert again.latestOffset() == {"a": [0, 4], "b": [0, 2]}
    assert StreamReader(place, None).latestOffset() == start


def test_large_files_are_read_in_slices(spark, place, monkeypatch):
    monkeypatch.setattr(topic_log, "GROUP_ROWS", 10)
    monkeypatch.setattr(topic_log, "TASK_ROWS", 25)
    log = Log(place)
    batch = pa.RecordBatch.from_arrays([
        pa.array([str(i).encode() for i in range(95)]), pa.array([[]] * 95, ARROW_SCHEMA[1].type),
        pa.nulls(95, pa.string()), pa.nulls(95, pa.timestamp("us", "UTC"))], ARROW_SCHEMA.names)
    file = log.write("w", iter([batch]))
    assert file[1:] == [95, 10]
    parts = slices("w", [file])
    assert [(p.first, p.last) for p in parts] == [(0, 2), (2, 4), (4, 6), (6, 8), (8, 10)]
    got = [int(v.as_py()) for p in parts for b in read_slice(place, p) for v in b.column(0)]
    assert got == list(range(95))
    assert Slice("w", file[0], 0, 2) == parts[0]


def test_restart_goes_on_where_it_stopped(spark, place, scratch):
    result, checkpoint = scratch("result"), scratch("checkpoint")

    def consume():
        stream = read_messages(spark, topic=f"log:{place}", max_rows_per_trigger=10)
        return run_to_end(stream_to_table(stream, result, checkpoint, available_now=False))

    publish(numbered(spark, 0, 40, 8), f"log:{place}", "a")
    batches = consume().lastProgress["batchId"]
    assert batches >= 3  # the limit holds from the first batch on
    publish(numbered(spark, 40, 25, 5), f"log:{place}", "a")
    assert consume().lastProgress["batchId"] > batches + 1
    assert payloads(spark.read.parquet(result)) == list(range(65))


def test_a_repeated_epoch_leaves_each_message_once(spark, place, scratch):
    """The writer's commit is lost after its messages were published; equal rows have ids
    of their own, which stay the same."""
    source, checkpoint = scratch("source"), scratch("checkpoint")
    equal = to_messages(spark.range(50, numPartitions=5).select(F.lit("x").alias("i")), to_bytes("i"))
    publish(equal, f"log:{source}")

    def send():
        rows_in = read_messages(spark, topic=f"log:{source}").select("data")
        run_to_end(write_messages(rows_in, f"log:{place}", checkpoint, id_label="uid",
                                  timestamp_attribute="at", available_now=False))
        return all_of(spark, place).select("message_id", "attributes", "publish_time")

    first = rows(send())
    assert len(first) == len({r[0] for r in first}) == 50
    assert all(r[1]["uid"] == r[0] and r[1]["at"].isdigit() for r in first)
    for f in ("0", ".0.crc"):
        os.remove(f"{checkpoint}/commits/{f}")
    assert rows(send()) == first
    log = Log(place)
    [writer] = log.writers()
    assert len(log.names("shards", writer)) == len(log.committed(writer, 0))  # no left-overs


def test_options_together(spark, place, scratch):
    frame = spark.createDataFrame(
        [("a", "1", 1000), ("b", "1", 2000), ("c", "2", 3000), ("d", None, 4000)],
        "d string, uid string, at long")
    messages = to_messages(frame, to_bytes("d"), attributes={"uid": F.col("uid"), "at": F.col("at")},
                           message_id=F.col("d"))
    publish(messages, f"log:{place}")
    result = scratch("result")
    stream = read_messages(spark, subscription=f"log:{place}", with_attributes=True, id_label="uid",
                           timestamp_attribute="at")
    run_to_end(stream_to_table(stream, result, scratch("c"), available_now=False))
    got = {r["message_id"]: r for r in spark.read.parquet(result).collect()}
    assert len(got) == 3 and {"c", "d"} < set(got)
    assert got["c"]["element_time"].timestamp() == 3


# ---- several topics of one stream ---------------------------------------------


def tagged_batch(tags, name):
    n = len(tags)
    return pa.record_batch(
        [pa.array(tags), pa.array([f"{name}{i}".encode() for i in range(n)]),
         pa.array([[]] * n, ARROW_SCHEMA[1].type), pa.array([None] * n, pa.string()),
         pa.array([0] * n, pa.timestamp("us", "UTC"))], ["tag", *ARROW_SCHEMA.names])


def data_of(place, tag):
    log = Log(f"{place}/{tag}")
    parts = [s for w in log.writers() for e in log.epochs(w) for s in slices(w, log.committed(w, e))]
    return sorted(v.as_py().decode() for s in parts for b in read_slice(log.place, s)
                  for v in b.column("data"))


def test_a_transaction_over_topics_is_finished_by_a_repeat(tmp_path):
    from millstream.sinks.tagged_topics import TRANSACTIONS, TaggedWriter

    place = str(tmp_path)
    sink = TaggedWriter(place, "w", ["a", "b"], None)
    first = [sink.write(iter([tagged_batch(["a", "b", "a"], "x")])), sink.write(iter([]))]
    # the run fails when its list is in place and one topic has published
    files = first[0].files
    assert Log(f"{place}/{TRANSACTIONS}").commit("w", 0, files)
    Log(f"{place}/a").commit("w", 0, [f[1:] for f in files if f[0] == "a"])
    sink.abort(first, 0)  # must not take the files of the transaction away
    assert data_of(place, "a") == ["x0", "x2"] and data_of(place, "b") == []

    again = [sink.write(iter([tagged_batch(["a", "b", "a"], "y")]))]
    sink.commit(again, 0)
    assert data_of(place, "a") == ["x0", "x2"] and data_of(place, "b") == ["x1"]
    sink.commit([sink.write(iter([tagged_batch(["b"], "z")]))], 1)
    assert data_of(place, "a") == ["x0", "x2"] and data_of(place, "b") == ["x1", "z0"]
    assert len(Log(f"{place}/a").names("shards", "w")) == 1  # nothing of the repeat is left
    lost = sink.write(iter([tagged_batch(["a"], "q")]))
    sink.abort([lost, None], 2)
    assert len(Log(f"{place}/a").names("shards", "w")) == 1
    with pytest.raises(ValueError, match="no topic"):
        sink.write(iter([tagged_batch(["c"], "q")]))
    with pytest.raises(ValueError, match="no topic"):
        sink.write(iter([tagged_batch([None], "q")]))


def test_a_stream_into_several_topics(spark, place, scratch):
    from millstream.sinks import write_tagged_messages

    outputs, checkpoint = scratch("tagged"), scratch("c")

    def run():
        rows = read_messages(spark, topic=f"log:{place}", with_attributes=True).withColumn(
            "tag", F.when(F.col("message_id").cast("int") % 3 == 0, "third").otherwise("rest"))
        run_to_end(write_tagged_messages(
            rows, outputs, checkpoint, ["third", "rest", "never"], id_label="uid",
            message_id=F.col("message_id"), available_now=False))

    for first in (0, 50):
        publish(numbered(spark, first, 50), f"log:{place}", "a")
        run()
    third, rest = (all_of(spark, f"{outputs}/{t}") for t in ("third", "rest"))
    assert payloads(third) == list(range(0, 100, 3))
    assert payloads(rest) == [i for i in range(100) if i % 3]
    assert third.where("attributes['uid'] = message_id AND size(attributes) = 1").count() == 34
    assert all_of(spark, f"{outputs}/never").count() == 0
    with pytest.raises(ValueError, match="not a name of a topic"):
        write_tagged_messages(rest, outputs, checkpoint, ["_x"])
