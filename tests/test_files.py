import datetime as dt
import gc
import gzip
import os
import sys
import types

import numpy as np
import pytest
from conftest import rows
from pyspark import TaskContext, cloudpickle
from pyspark.sql import functions as F

from millstream import sinks, sources
from millstream.operators import count_per_key
from millstream.sources import files, records
from millstream.sources.jdbc import jdbc_options


def values(df):
    return sorted(r[0] for r in df.collect())


def local(path):
    return path.removeprefix("file:")


def test_text_lines_globs_and_blank_lines(spark, tmp_path):
    (tmp_path / "in1.txt").write_text("a\n\nb\n")
    (tmp_path / "in2.txt").write_text("c")
    (tmp_path / "other.txt").write_text("z\n")
    with gzip.open(tmp_path / "in3.txt.gz", "wt") as f:
        f.write("packed\n")
    assert values(sources.read_text(spark, f"{tmp_path}/in*")) == ["", "a", "b", "c", "packed"]


@pytest.mark.parametrize("n", [1, 2])
def test_header_lines_are_skipped_per_file(spark, tmp_path, n):
    for i in range(5):
        head = "".join(f"head{k}\n" for k in range(n))
        (tmp_path / f"f{i}.txt").write_text(head + f"row{i}\n\nhead0\n")
    got = values(sources.read_text(spark, f"{tmp_path}/*.txt", skip_header_lines=n))
    assert got == sorted([f"row{i}" for i in range(5)] + ["", "head0"] * 5)


def test_header_is_skipped_once_in_a_file_of_many_splits(spark, tmp_path):
    (tmp_path / "big.txt").write_text("head\n" + "".join(f"{i}\n" for i in range(5000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        df = sources.read_text(spark, str(tmp_path / "big.txt"), skip_header_lines=1)
        assert df.rdd.getNumPartitions() > 3
        assert sorted(map(int, values(df))) == list(range(5000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_line_ends(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"x\r\ny\rz\n\r\nlast\r")
    assert values(sources.read_text(spark, str(tmp_path))) == ["", "last", "x", "y\rz"]


def test_keep_line_ends(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x\ny\n")
    assert values(sources.read_text(
        spark, str(tmp_path), strip_trailing_newlines=False)) == ["x\n", "y\n"]


def test_missing_path(spark, tmp_path):
    missing = f"{tmp_path}/none*"
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        sources.read_text(spark, missing)
    assert sources.read_text(spark, missing, validate=False).count() == 0
    assert sources.read_text(spark, missing, validate=False, skip_header_lines=1).count() == 0
    empty = sources.read_parquet(spark, missing, validate=False, schema="a int, b int",
                                 columns=["b"])
    assert empty.columns == ["b"] and empty.count() == 0
    with pytest.raises(Exception, match="no files"):
        sources.read_tfrecord(spark, missing).count()
    assert sources.read_tfrecord(spark, missing, validate=False).count() == 0


def test_csv_types_and_bad_rows(spark, tmp_path):
    (tmp_path / "s.csv").write_text("id, n,day\r\nA, 1,03-11-2019\r\nB,x,04-11-2019\r\n")
    schema = "id string, n int, day date"
    with pytest.raises(Exception):
        sources.read_csv(spark, str(tmp_path), schema, date_format="dd-MM-yyyy").collect()
    good = sources.read_csv(
        spark, str(tmp_path), schema, date_format="dd-MM-yyyy", on_error="drop")
    assert rows(good) == [("A", 1, dt.date(2019, 11, 3))]


def test_text_sink_shards_header_and_exact_lines(spark, scratch):
    lines = ["plain", "", ' "quoted", x ', "#not a comment", "back\\slash", "tab\there"]
    df = sources.create(spark, lines, "value string")
    path = scratch()
    sinks.write_text(df, path, num_shards=2, header="h1,h2")
    files = [f for f in os.listdir(local(path)) if f.startswith("part-")]
    assert len(files) == 2
    for f in files:
        with open(f"{local(path)}/{f}") as opened:
            assert opened.readline() == "h1,h2\n"
    assert values(sources.read_text(spark, path, skip_header_lines=1)) == sorted(lines)


def test_text_sink_without_line_ends(spark, scratch):
    df = sources.create(spark, ["ab", "cd"], "value string").coalesce(1)
    path = scratch()
    sinks.write_text(df, path, append_trailing_newlines=False, file_name_suffix=".raw")
    files = [f for f in os.listdir(local(path)) if f.endswith(".raw")]
    assert len(files) == 1
    with open(f"{local(path)}/{files[0]}", "rb") as f:
        assert f.read() == b"abcd"


def test_text_sink_with_suffix(spark, scratch):
    path = scratch()
    sinks.write_text(sources.create(spark, ["a", "", "b"], "value string"), path,
                     file_name_suffix=".log", num_shards=2, compression="gzip")
    names = os.listdir(local(path))
    assert len([n for n in names if n.endswith(".log.gz")]) == 2
    assert values(sources.read_text(spark, f"{path}/*.gz")) == ["", "a", "b"]


def test_parquet_schema_codec_and_pruning(spark, scratch):
    df = sources.create(spark, [(1, "a", 2.0), (2, "b", 3.0)], "x int, y string, z double")
    path = scratch()
    sinks.write_parquet(df, path, schema="x bigint, y string, z double", codec="gzip",
                        num_shards=1, row_group_buffer_size=1 << 20)
    back = sources.read_parquet(spark, path, columns=["x"])
    assert back.schema.simpleString() == "struct<x:bigint>" and values(back) == [1, 2]
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<x:bigint>" in plan
    with pytest.raises(Exception, match="already exists"):
        sinks.write_parquet(df, path)


def test_avro_needs_its_module(spark, scratch):
    """Where Spark's module is missing, the error says which one."""
    df = spark.range(3)
    path = scratch()
    try:
        sinks.write_avro(df, path)
    except RuntimeError as error:
        assert "spark-avro" in str(error)
        with pytest.raises(RuntimeError, match="spark-avro"):
            sources.read_avro(spark, path)
    else:
        assert sources.read_avro(spark, path).count() == 3


def test_python_sinks_modes(spark, scratch):
    path = scratch()
    df = spark.range(3).select(F.col("id").cast("string").cast("binary").alias("value"))
    sinks.write_tfrecord(df, path)
    with pytest.raises(FileExistsError):
        sinks.write_tfrecord(df, path)
    sinks.write_tfrecord(df, path, mode="append")
    assert sources.read_tfrecord(spark, path).count() == 6
    sinks.write_tfrecord(df, path, mode="overwrite")
    assert values(sources.read_tfrecord(spark, path, coder="utf8")) == ["0", "1", "2"]


def test_crc32c_known_values():
    # Published check values of CRC-32C.
    assert records.crc32c(b"123456789") == 0xE3069283
    assert records.crc32c(bytes(32)) == 0x8A9136AA
    assert records.crc32c(b"\xff" * 32) == 0x62A8AB43
    chunks = [bytes([i % 251]) * n for i, n in enumerate([0, 1, 3, 4, 8, 511, 512, 513, 3000])]
    assert records.crc32c_all(chunks).tolist() == [records.crc32c(c) for c in chunks]


@pytest.mark.parametrize("most", [5, 90, 2000, 40_000, 700_000])
def test_crc32c_of_many_lengths(most):
    random = np.random.default_rng(most)
    lengths = [most, 0, 1, 4, 16, 17, *random.integers(0, most, 12).tolist()]
    chunks = [random.bytes(n) for n in lengths]
    assert records.crc32c_all(chunks).tolist() == [records.crc32c(c) for c in chunks]
    assert [records.crc32c_all([c])[0] for c in chunks] == records.crc32c_all(chunks).tolist()


@pytest.mark.parametrize("compression", ["none", "gzip", "zlib"])
def test_tfrecord_roundtrip(spark, scratch, compression):
    data = [b"", b"x", bytes(range(256)) * 700, "grüße".encode()]
    df = sources.create(spark, data, "value binary")
    path = scratch()
    sinks.write_tfrecord(df, path, compression=compression, num_shards=2)
    assert sorted(bytes(r[0]) for r in sources.read_tfrecord(spark, path).collect()) == sorted(data)
    decoded = sources.read_tfrecord(spark, path, coder=F.octet_length("value"))
    assert values(decoded) == sorted(map(len, data))


def test_tfrecord_damage_is_noticed(spark, scratch):
    path = scratch()
    sinks.write_tfrecord(sources.create(spark, [b"hello world"], "value binary"), path)
    for name in os.listdir(local(path)):
        full = f"{local(path)}/{name}"
        if name.endswith(".tfrecord") and os.path.getsize(full):
            data = bytearray(open(full, "rb").read())
            data[14] ^= 1
            open(full, "wb").write(bytes(data))
    with pytest.raises(Exception, match="wrong checksum of a record"):
        sources.read_tfrecord(spark, path).count()


@pytest.mark.parametrize("split", [1, 13, 100, 5000, 1 << 20])
def test_tfrecord_splits(tmp_path, split):
    data = [b"", b"", b"x" * 700, bytes(900), b"", bytes(range(256)) * 40, b"yz", b"end"] * 3
    path = tmp_path / "one.tfrecord"
    path.write_bytes(records.frame(data))
    size = path.stat().st_size
    got = []
    with open(path, "rb") as stream:
        for start in range(0, size, split):
            for values in records.unframe_split(stream, "one", start, min(start + split, size), size):
                got += values
    assert got == data


class Counted:
    """A file that counts the bytes that are read of it."""

    def __init__(self, file):
        self.file, self.seek, self.n = file, file.seek, 0

    def read(self, n):
        data = self.file.read(n)
        self.n += len(data)
        return data


@pytest.mark.parametrize("long", [0, 3_000_000])
def test_tfrecord_small_splits_read_little(tmp_path, long):
    """Neither small splits nor a record over many of them are scanned again and again."""
    data = [bytes([i % 256]) * (i % 1400) for i in range(3000)]
    data.insert(1500, bytes(range(251)) * (long // 251))
    path = tmp_path / "one.tfrecord"
    path.write_bytes(records.frame(data))
    size, split, got = path.stat().st_size, 1 << 16, []
    with open(path, "rb") as file:
        stream = Counted(file)
        for start in range(0, size, split):
            end = min(start + split, size)
            for values in records.unframe_split(stream, "one", start, end, size):
                got += values
    assert got == data
    assert stream.n < 3 * size


def test_tfrecord_splits_are_sent_short(tmp_path):
    path = tmp_path / "one.tfrecord"
    path.write_bytes(records.frame([b"x" * 100] * 100))
    reader = records._RecordReader({"path": str(path), "splitbytes": "1000"})
    parts = reader.partitions()
    assert len(parts) == 12
    assert max(len(cloudpickle.dumps(p)) for p in parts) < 1000


def test_tfrecord_workers_set_modules_aside_once(tmp_path, monkeypatch):
    path = tmp_path / "one.tfrecord"
    path.write_bytes(records.frame([b"x" * 100] * 100))
    reader = records._RecordReader({"path": str(path), "splitbytes": "1000"})
    frozen = []
    monkeypatch.setitem(sys.modules, "_millstream_worker", types.ModuleType("_millstream_worker"))
    monkeypatch.setattr(gc, "freeze", lambda: frozen.append(1))
    whole = [b for p in reader.partitions() for b in reader.read(p)]
    assert frozen == []
    monkeypatch.setattr(TaskContext, "get", lambda: object())
    again = [b for p in reader.partitions() for b in reader.read(p)]
    assert frozen == [1] and again == whole
    assert sum(b.num_rows for b in whole) == 100


def test_tfrecord_splits_on_spark(spark, scratch):
    path = scratch()
    data = [str(i).encode() * (i % 90) for i in range(3000)]
    sinks.write_tfrecord(sources.create(spark, data, "value binary"), path, num_shards=1)
    whole = sources.read_tfrecord(spark, path, split_bytes=0)
    cut = sources.read_tfrecord(spark, path, split_bytes=10_000)
    assert whole.rdd.getNumPartitions() == 1 and cut.rdd.getNumPartitions() > 20
    assert sorted(bytes(r[0]) for r in cut.collect()) == sorted(data)


def test_tfrecord_one_file_is_written_by_many_tasks(spark, scratch):
    path = scratch()
    data = [str(i).encode() * (i % 50) for i in range(4000)]
    rows = sources.create(spark, data, "value binary").repartition(8)
    sc = spark.sparkContext
    sc.setJobGroup("one-file", "one file of frames")
    try:
        sinks.write_tfrecord(rows, path, num_shards=1)
    finally:
        sc.setJobGroup("other", "other")
    tracker = sc.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("one-file")
              for s in tracker.getJobInfo(j).stageIds]
    assert min(s.numTasks for s in stages if s) > 1
    whole = sources.read_tfrecord(spark, path, split_bytes=0)
    assert whole.rdd.getNumPartitions() == 1
    assert sorted(bytes(r[0]) for r in whole.collect()) == sorted(data)
    cut = sources.read_tfrecord(spark, path, split_bytes=5_000)
    assert sorted(bytes(r[0]) for r in cut.collect()) == sorted(data)


def test_tfrecord_frames_within_a_record_are_noticed(tmp_path):
    inner = records.frame([b"inner" * 20] * 200)
    path = tmp_path / "one.tfrecord"
    path.write_bytes(records.frame([b"a", inner, b"b" * 50]))
    size = path.stat().st_size
    with open(path, "rb") as stream:
        parts = [list(records.unframe_split(stream, "one", 0, size, size))]
        assert sum(parts[0], []) == [b"a", inner, b"b" * 50]
        with pytest.raises(ValueError, match="holds frames itself"):
            list(records.unframe_split(stream, "one", 0, 5000, size))


def test_jdbc_options():
    plain = jdbc_options("jdbc:x:y", "t", properties={"user": "u"})
    assert plain == {"url": "jdbc:x:y", "dbtable": "t", "fetchsize": "10000", "user": "u"}
    split = jdbc_options("jdbc:x:y", "t", partition_column="id", lower_bound=0,
                         upper_bound=100, num_partitions=8, driver="d")
    assert split["numPartitions"] == "8" and split["partitionColumn"] == "id"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x:y", "t", partition_column="id")


def test_create(spark):
    assert values(sources.create(spark, ["b", "a"], "value string")) == ["a", "b"]
    pairs = sources.create(spark, [("maths", 52), ("maths", 52), ("art", 1)], "k string, v int")
    assert rows(count_per_key(pairs, ["k", "v"])) == [("art", 1, 1), ("maths", 52, 2)]
    lists = sources.create_from_map(spark, {"r1": [1, 2], "r2": []}, "k string, v array<int>")
    assert rows(lists) == [("r1", [1, 2]), ("r2", [])]


def test_tap_counts_and_changes_nothing(spark):
    df, seen = sinks.tap(spark.range(7), "seen")
    assert df.count() == 7 and seen.get["rows"] == 7


def test_write_tagged(spark, scratch):
    df = sources.create(spark, [("a", 1), ("b", 2), ("a", 3)], "tag string, v int")
    path = scratch()
    sinks.write_tagged(df, path)
    assert values(sources.read_parquet(spark, f"{path}/tag=a")) == [1, 3]


def test_an_overwrite_that_fails_loses_no_row(spark, scratch, monkeypatch):
    """The old files go only after the new ones are in place."""
    path = scratch()
    df = spark.range(5).select(F.col("id").cast("string").alias("value"))
    sinks.write_tfrecord(df, path, num_shards=2)
    part = files.new_part(path, ".x")
    with files.open_output(part.staged) as f:
        f.write(b"new")
    lost = files.WrittenFile(f"{path}/_staged/gone", f"{path}/part-gone")
    with pytest.raises(FileNotFoundError):
        files.publish_parts(path, [part, lost], overwrite=True)
    assert len(files.list_files(path)) == 3
    files.publish_parts(path, [], overwrite=True)
    assert files.list_files(path, validate=False) == []
