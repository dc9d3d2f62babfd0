"""Exclusion by long lists, and functions over tables."""

import sys

import numpy as np
import pyarrow as pa
import pytest
from conftest import rows
from pyspark import cloudpickle
from pyspark.sql import functions as F

from millstream import operators as op
from millstream.operators import long_lists as ll
from millstream.sources import create

cloudpickle.register_pickle_by_value(sys.modules[__name__])

@pytest.mark.parametrize("bits", [64, 1 << 12, 1 << 20])
def test_no_row_is_lost_and_none_too_many_stays(spark, bits):
    df = spark.range(3000).select(
        F.when(F.col("id") % 7 != 0, F.col("id") % 500).alias("k"),
        F.concat(F.lit("n"), F.col("id") % 3).alias("name"), F.col("id").alias("row.id"))
    df = df.unionAll(df.where("k = 3"))
    listed = spark.range(0, 400, 3).select(
        F.col("id").alias("k"), F.lit("n1").alias("name"), F.lit(1).alias("more"))
    listed = listed.unionAll(listed).unionAll(listed.limit(1).withColumn("k", F.lit(None).cast("long")))
    for keys in (["k"], ["k", "name"]):
        got = op.exclude_long(df, listed, keys, bits=bits)
        assert got.columns == df.columns
        assert rows(got) == rows(op.exclude(df, listed, keys).select("k", "name", "`row.id`"))


def test_empty_sides(spark):
    df = create(spark, [(1,), (None,)], "k int")
    none = df.where("k > 5")
    assert rows(op.exclude_long(df, none, ["k"])) == rows(df)
    assert rows(op.exclude_long(none, df, ["k"])) == []


def test_the_share_of_false_positives_is_bounded(spark):
    bits, listed = 1 << 17, 10_000
    words = ll.bloom_filter(spark.range(listed), ["id"], bits)
    others = spark.range(1_000_000, 1_050_000).select(
        *[p.alias(f"p{i}") for i, p in enumerate(ll._places(F.xxhash64("id"), bits))])
    p = [c.to_numpy() for c in others.toArrow().columns]
    hit = np.all([(words[x >> 6] >> (x & 63).astype(np.uint64)) & np.uint64(1) for x in p], axis=0)
    assert hit.mean() < 1.3 * ll.false_positives(listed, bits)
    assert ll.false_positives(10_000_000) < 0.005
    assert len(words) == bits // 64


def test_bad_arguments(spark):
    df = create(spark, [(1,)], "k int")
    with pytest.raises(ValueError, match="power of two"):
        op.exclude_long(df, df, ["k"], bits=100)
    with pytest.raises(TypeError, match="other types"):
        op.exclude_long(df, df.select(F.col("k").cast("long").alias("k")), ["k"])


def test_only_possible_hits_are_shuffled(spark):
    df = spark.range(100_000)
    plan = op.exclude_long(df, spark.range(10), ["id"])
    shuffled = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in shuffled and shuffled.count("may_be_listed") >= 2
    assert plan.count() == 99_990


class Spread(op.TableFn):
    """Every row ``times`` times, then how many rows there were."""

    def __init__(self):
        self.seen = 0

    @classmethod
    def analyze(cls, schema, times):
        return "k string, copies bigint" if "k" in schema.names else "copies bigint"

    def process(self, batch, times):
        self.seen += batch.num_rows
        for _ in range(times):
            ones = pa.array([1] * batch.num_rows, pa.int32())
            yield pa.table({"copies": ones} | ({"k": batch.column("k")} if "k" in batch.schema.names else {}))

    def finish(self, times):
        pass


class Firsts(op.TableFn):
    """The first value of a partition, and its rows, as they come at the end."""

    def __init__(self):
        self.first, self.n = None, 0

    @classmethod
    def analyze(cls, schema):
        return "first bigint, n bigint"

    def process(self, batch):
        if not self.n:
            self.first = batch.column("v")[0].as_py()
        self.n += batch.num_rows
        return None

    def finish(self):
        yield pa.record_batch({"n": pa.array([self.n]), "first": pa.array([self.first], pa.int64())})


def test_the_columns_follow_from_the_table(spark):
    df = create(spark, [("a", 1), ("b", 2)], "k string, v int")
    assert rows(op.apply_table(df, Spread, 2)) == [("a", 1), ("a", 1), ("b", 1), ("b", 1)]
    assert op.apply_table(df, Spread, 0).count() == 0
    assert op.apply_table(df.drop("k"), Spread, 3).columns == ["copies"]
    assert op.apply_table(df.where("v > 9"), Spread, 2).count() == 0


def test_partitions_and_order(spark):
    df = spark.range(30_000).select(
        (F.col("id") % 3).alias("k"), F.col("id").alias("v")).unionAll(
        create(spark, [(None, 5), (None, -5)], "k bigint, v bigint"))
    got = op.apply_table(df, Firsts, partition_by=["k"], order_by=[F.col("v").desc()])
    assert rows(got) == [(29997, 10000), (29998, 10000), (29999, 10000), (5, 2)]  # as text
    with pytest.raises(ValueError, match="partition_by"):
        op.apply_table(df, Firsts, order_by=["v"])


def test_a_table_function_in_sql(spark):
    df = create(spark, [(1, 4), (1, 3), (2, 9)], "k bigint, v bigint")
    df.createOrReplaceTempView("table_fn_rows")
    op.register_table_function(spark, "firsts_of", Firsts, df.schema)
    got = spark.sql("SELECT * FROM firsts_of(TABLE(table_fn_rows) PARTITION BY k ORDER BY v)")
    assert rows(got) == [(3, 2), (9, 1)]
