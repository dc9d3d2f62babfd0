"""Groups handed over batch by batch."""

import sys

import pyarrow as pa
import pytest
from conftest import rows
from pyspark import cloudpickle
from pyspark.sql import functions as F

from millstream import operators as op
from millstream.session import settings

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "key string, seen string, batches long, most long"


def describe(key, batches):
    seen, n, most = [], 0, 0
    for name, batch in batches:
        seen += [f"{name}{v}" for v in batch.column("v").to_pylist()]
        n, most = n + 1, max(most, batch.num_rows)
    yield pa.RecordBatch.from_arrays(
        [pa.array([str(key)]), pa.array([" ".join(seen)]), pa.array([n]), pa.array([most])],
        ["key", "seen", "batches", "most"])


def test_inputs_follow_each_other_in_order(spark):
    a = spark.createDataFrame([("x", 2), ("x", 1), (None, 5), ("y", 7)], "k string, v int")
    b = spark.createDataFrame([("x", 9), ("z", 3), ("x", 8), (None, None)], "k string, v int")
    got = op.per_group({"a": a.repartition(3), "b": b}, ["k"], describe, SCHEMA, ["v"])
    assert {(r.key, r.seen) for r in got.collect()} == {
        ("('x',)", "a1 a2 b8 b9"), ("('y',)", "a7"), ("('z',)", "b3"), ("(None,)", "a5 bNone")}


def test_a_hot_key_comes_in_batches(spark):
    hot = spark.range(50_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("v"))
    with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "500"}):
        got = op.per_group({"h": hot}, ["k"], describe, SCHEMA, ["v"])
        found = got.where("key = \"('hot',)\"").collect()
        assert got.count() == 33_334
    assert found[0].seen == " ".join(f"h{i}" for i in range(0, 50_000, 3))
    assert found[0].most <= 500 and found[0].batches >= 33


@pytest.mark.parametrize("reads", [0, 1])
def test_a_function_need_not_read_its_group(spark, reads):
    def lazy(key, batches):
        for _ in range(reads):
            next(batches)
        yield pa.RecordBatch.from_pylist([{"k": key[0]}])

    df = spark.range(1000).select((F.col("id") % 40).alias("k"), "id")
    with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "7"}):
        got = op.per_group({"d": df}, ["k"], lazy, "k long")
        assert rows(got) == sorted([(i,) for i in range(40)], key=repr)


def test_no_rows_and_no_values(spark):
    none = spark.createDataFrame([], "k string, v int")
    assert op.per_group({"a": none, "b": none}, ["k"], describe, SCHEMA).count() == 0
    with pytest.raises(ValueError, match="no value columns"):
        op.per_group({"a": none.select("k")}, ["k"], describe, SCHEMA)
