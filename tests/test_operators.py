import datetime as dt
import random
import sys
from collections import Counter, defaultdict
from decimal import Decimal

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark import cloudpickle
from pyspark.sql import functions as F

from millstream import operators as op
from millstream.operators.pardo import tagged_output
from millstream.session import settings as session_settings
from millstream.sources import create

# the workers do not have the test folder on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])

few = settings(max_examples=8, deadline=None,
               suppress_health_check=[HealthCheck.function_scoped_fixture])

T0 = dt.datetime(2024, 1, 1)


# ---- element-wise ----------------------------------------------------------

def test_element_steps(spark):
    df = create(spark, [(1, "x,y"), (2, "z")], "id int, t string")
    step = op.chain(
        op.flat_map(F.split("t", ","), "w", keep=["id"]),
        op.filter_in("w", ["x", "z"]),
        op.tag_constant("dept", "HR"),
        op.struct_key("k", "id", "w"),
        op.key_value(["k"], F.col("dept"), "v"))
    assert rows(df.transform(step)) == [((1, "x"), "HR"), ((2, "z"), "HR")]


def test_label_changes_nothing(spark):
    df = spark.range(5)
    step = op.filter_equals("id", 3)
    assert rows(df.transform(op.labelled("pick", step))) == rows(df.transform(step))


def test_typed(spark):
    df = spark.range(3).select(F.col("id").alias("v"))
    assert df.transform(op.typed("v bigint")).count() == 3
    for wrong in ("v int", "w bigint", "v bigint, w int"):
        with pytest.raises(TypeError):
            df.transform(op.typed(wrong))
    nested = spark.createDataFrame([], "a array<struct<x:int>>, m map<string,int>")
    nested.transform(op.typed("a array<struct<x:int>>, m map<string,int>"))


@few
@given(st.lists(st.text("Kabc", min_size=0, max_size=6), max_size=30))
def test_tags_are_disjoint_and_complete(spark, names):
    df = create(spark, names, "name string")
    tagged = df.transform(op.tag_rows(
        [("K", F.col("name").startswith("K")), ("S", F.length("name") <= 3)], "L"))
    parts = {t: [r[0] for r in op.output(tagged, t).collect()] for t in "KSL"}
    assert sorted(sum(parts.values(), [])) == sorted(names)
    for name in names:
        kind = "K" if name.startswith("K") else "S" if len(name) <= 3 else "L"
        assert name in parts[kind]


class Spread(op.DoFn):
    def setup(self):
        self.unit = 10

    def process(self, element, times=1):
        for i in range(element.n * times):
            yield element.name, i * self.unit


def test_par_do(spark):
    df = create(spark, [("a", 2), ("b", 0), ("c", 1)], "name string, n int")
    got = op.par_do(df, Spread(), "name string, v int", times=2)
    assert rows(got) == [("a", 0), ("a", 10), ("a", 20), ("a", 30), ("c", 0), ("c", 10)]
    single = op.par_do(df, lambda e: [e.name * e.n] if e.n else None, "s string")
    assert rows(single) == [("aa",), ("c",)]
    nothing = op.par_do(df.where("false"), Spread(), "name string, v int")
    assert nothing.count() == 0


def test_row_functions(spark):
    df = create(spark, [("a b", 2), ("c", None)], "t string, n int")
    assert rows(op.map_rows(df, lambda e, k: (e.t.upper(), (e.n or 0) + k), "t string, n int", 1)
                ) == [("A B", 3), ("C", 1)]
    assert rows(op.flat_map_rows(df, lambda e: e.t.split(), "w string")) == [
        ("a",), ("b",), ("c",)]
    kept = op.filter_rows(df, lambda e: e.n is None)
    assert kept.schema == df.schema and rows(kept) == [("c", None)]


EVERY_TYPE = (
    "a int, b bigint, f float, d double, s string, y binary, t boolean, day date, "
    "nz timestamp_ntz, amount decimal(12,2), list array<string>, "
    "m map<string,bigint>, r struct<x:int,y:array<struct<z:string>>>")


def every_type():
    full = (-5, 2**62, 1.5, -2.25, "grüße", b"\x00\xff", True, dt.date(1969, 12, 31),
            dt.datetime(1960, 1, 1, 0, 0, 0, 1), Decimal("-1234567.89"), ["a", None, ""],
            {"k": 1, "l": None}, (7, [("q",), (None,)]))
    return [full, tuple([None] * 13)]


def test_functions_of_rows_see_every_type(spark):
    df = spark.createDataFrame(every_type(), EVERY_TYPE)
    assert rows(op.filter_rows(df, lambda e: True)) == rows(df)


def test_tables_only(spark):
    stream = spark.readStream.format("rate").load()
    with pytest.raises(ValueError, match="stream"):
        op.count_panes(stream, ["value"], ["timestamp"], "value")


def test_par_do_tagged(spark):
    df = create(spark, [(i,) for i in range(6)], "n int")

    def split(element):
        if element.n % 2:
            return [op.Tagged("odd", (element.n, str(element.n)))]
        return [element.n, element.n]

    tagged = op.par_do_tagged(df, split, {"even": "n int", "odd": "n int, t string"}, "even")
    assert rows(tagged_output(tagged, "odd")) == [(1, "1"), (3, "3"), (5, "5")]
    assert rows(tagged_output(tagged, "even")) == [(0,), (0,), (2,), (2,), (4,), (4,)]
    with pytest.raises(ValueError):
        op.par_do_tagged(df, split, {"odd": "n int"}, "even")


# ---- grouping and combining ------------------------------------------------

pairs = st.lists(
    st.tuples(st.one_of(st.none(), st.sampled_from("ab")), st.one_of(st.none(), st.integers(0, 9))),
    max_size=40)


def grouped(data):
    groups = defaultdict(list)
    for k, v in data:
        groups[k].append(v)
    return groups


@few
@given(pairs, st.sampled_from([1, 3, 50]))
def test_group_by_key_keeps_every_value(spark, data, chunks):
    df = create(spark, data, "k string, v int")
    pieces = op.group_by_key(df, ["k"], "v", chunks=chunks).collect()
    got = defaultdict(Counter)
    for r in pieces:
        got[r["k"]].update({v["value"]: v["times"] for v in r["values"]})
    want = {k: Counter(v) for k, v in grouped(data).items()}
    assert got == want
    assert rows(op.count_values(df, ["k"], "v")) == sorted(
        ((k, v, n) for k, c in want.items() for v, n in c.items()), key=repr)
    if chunks == 1:
        assert len(pieces) == len(got)


@pytest.mark.parametrize("chunks", [1, 4])
def test_groups_do_not_depend_on_size_or_layout(spark, chunks):
    """A key of many equal values, one of many different ones, and a small one."""
    df = op.flatten(
        spark.range(20_000).select(F.lit("equal").alias("k"), F.lit(7).alias("v")),
        spark.range(20_000).select(F.lit("mixed").alias("k"), F.col("id").cast("int").alias("v")),
        spark.range(10).select(F.lit("small").alias("k"), F.lit(1).alias("v")))
    seen = set()
    for parts in (1, 7, 13):
        got = op.group_by_key(df.repartition(parts), ["k"], "v", chunks=chunks).select(
            "k", "chunk", F.xxhash64(F.array_sort("values")).alias("h"), F.size("values"))
        seen.add(tuple(rows(got)))
    assert len(seen) == 1
    sizes = {r[0]: 0 for r in seen.copy().pop()}
    for k, _, _, n in seen.pop():
        sizes[k] += n
    assert sizes == {"equal": 1, "mixed": 20_000, "small": 1}


def test_fold_of_pieces_is_the_sum(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("k"), (F.col("id") % 50).alias("v"))
    from millstream.operators.grouping import fold_groups, sum_list

    for chunks in (1, 8):
        got = fold_groups(op.group_by_key(df, ["k"], "v", chunks=chunks), ["k"], sum_list)
        assert rows(got) == rows(op.sum_per_key(df, ["k"], "v"))


class Stats(op.CombineFn):
    """(count, sum, list of extremes): not one of Spark's own aggregates."""

    def create_accumulator(self):
        return [0, 0, []]

    def add_input(self, acc, v):
        return [acc[0] + 1, acc[1] + (v or 0), self._ends(acc[2] + [v or 0])]

    def merge_accumulators(self, accs):
        accs = list(accs)
        ends = [e for a in accs for e in a[2]]
        return [sum(a[0] for a in accs), sum(a[1] for a in accs), self._ends(ends)]

    def extract_output(self, acc):
        return {"n": acc[0], "total": acc[1], "ends": acc[2]}

    @staticmethod
    def _ends(values):
        return sorted({min(values), max(values)}) if values else []


OUTPUT = "r struct<n:bigint,total:bigint,ends:array<bigint>>"


def brute(values):
    acc = Stats().create_accumulator()
    for v in values:
        acc = Stats().add_input(acc, v)
    return acc[0], acc[1], acc[2]


@few
@given(pairs, st.integers(1, 5), st.sampled_from([1, 2, 100]), st.sampled_from([0, 3]))
def test_combine_per_key_is_independent_of_layout(spark, data, parts, max_keys, fanout):
    df = create(spark, data, "k string, v int").repartition(parts)
    got = op.combine_per_key(
        df, ["k"], ["v"], Stats(), OUTPUT, max_keys_per_task=max_keys, fanout=fanout)
    assert {r["k"]: (r["r"]["n"], r["r"]["total"], r["r"]["ends"]) for r in got.collect()} == {
        k: brute(v) for k, v in grouped(data).items()}


def test_combine_keys_with_nan_and_structs(spark):
    nan = float("nan")
    df = create(spark, [(nan, 1), (nan, 2), (0.5, 3)], "k double, v int").repartition(3)
    got = op.combine_per_key(df, ["k"], ["v"], Stats(), OUTPUT).select("r.total")
    assert rows(got) == [(3,), (3,)]
    df = df.select(F.struct(F.lit("a").alias("x")).alias("k"), "v")
    got = op.combine_per_key(df, ["k"], ["v"], Stats(), OUTPUT).select("k.x", "r.total")
    assert rows(got) == [("a", 6)]
    with pytest.raises(TypeError):
        op.combine_per_key(df.select(F.create_map(F.lit(1), "v").alias("k"), "v"),
                           ["k"], ["v"], Stats(), OUTPUT)


@pytest.mark.parametrize("n,parts,fanout", [(0, 1, 4), (1, 1, 4), (1000, 7, 3), (1000, 7, 64)])
def test_combine_globally_gives_one_row(spark, n, parts, fanout):
    df = spark.range(n, numPartitions=parts).select(F.col("id").alias("v"))
    got = op.combine_globally(df, ["v"], Stats(), OUTPUT, fanout=fanout).select("r.*").collect()
    assert [tuple(r) for r in got] == [brute(range(n))]


class CountPairs(op.CombineFn):
    def create_accumulator(self):
        return 0

    def add_input(self, acc, element):
        a, b = element
        return acc + a * b

    def merge_accumulators(self, accs):
        return sum(accs)

    def extract_output(self, acc):
        return acc


def test_combine_several_values(spark):
    df = create(spark, [("k", 2, 3), ("k", 4, 5)], "k string, a int, b int")
    got = op.combine_per_key(df, ["k"], ["a", "b"], CountPairs(), "s bigint")
    assert rows(got) == [("k", 26)]


# ---- co-groups -------------------------------------------------------------

keyed = st.lists(st.tuples(st.sampled_from("abcd"), st.integers(0, 5)), max_size=15)


@few
@given(keyed, keyed, keyed, st.sampled_from([1, 3]))
def test_cogroup_of_three(spark, a, b, c, chunks):
    inputs = {n: create(spark, d, f"k string, {n}_v int") for n, d in
              (("x", a), ("y", b), ("z", c))}
    got = {k: {n: Counter() for n in inputs} for k in {k for k, _ in a + b + c}}
    for r in op.cogroup(inputs, ["k"], chunks=chunks).collect():
        for n in inputs:
            for v in r[n]:
                got[r["k"]][n][v["row"][0]] += v["times"]
    for n, data in (("x", a), ("y", b), ("z", c)):
        for k in got:
            assert got[k][n] == Counter(v for key, v in data if key == k)


def test_cogroup_expands_to_all_pairs(spark):
    six = spark.range(6).select(F.lit("k").alias("k"), F.col("id").alias("v"))
    groups = op.cogroup({"x": six, "y": six}, ["k"])
    pairs = groups.select("k", F.explode("x").alias("x")).join(
        groups.select("k", F.explode("y").alias("y")), "k")
    assert pairs.distinct().count() == 36
    assert op.cogroup_join(six, six.withColumnRenamed("v", "w"), ["k"]).count() == 36


def test_joins_and_exclusion(spark):
    left = create(spark, [("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, v int")
    right = create(spark, [("a", 10), ("c", 30)], "k string, w int")
    assert rows(op.cogroup_join(left, right, ["k"])) == [("a", 1, 10), ("a", 2, 10)]
    assert op.cogroup_join(left, right, ["k"], "left").count() == 4
    assert op.cogroup_join(left, right, ["k"], "full").count() == 5
    with pytest.raises(ValueError):
        op.cogroup_join(left, right, ["k"], "cross")
    assert rows(op.exclude(left, right, ["k"])) == [("b", 3), (None, 4)]
    with_null = right.unionAll(create(spark, [(None, 1)], "k string, w int"))
    assert rows(op.exclude(left, with_null, ["k"])) == [("b", 3), (None, 4)]
    assert op.exclude(left, with_null, ["k"]).columns == ["k", "v"]
    counted = op.exclude(op.count_per_key(left, ["k"]), right, ["k"])
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join LeftOuter") < plan.index("Aggregate")


def test_broadcast_only_below_the_bound(spark):
    small, big = spark.range(5), spark.range(50)

    def hinted(df):
        return "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()

    assert hinted(op.bounded_broadcast(small, 100)) and not hinted(op.bounded_broadcast(big, 100))


def test_flatten_keeps_repeats(spark):
    a = create(spark, [(1, "x"), (1, "x")], "n int, t string")
    b = create(spark, [("x", 1)], "t string, n int")
    assert rows(op.flatten(a, b, a)) == [(1, "x")] * 5


# ---- windows ---------------------------------------------------------------

events = st.lists(
    st.tuples(st.sampled_from("ab"), st.integers(0, 90), st.integers(-5, 5)), max_size=40)


def timed(spark, data):
    with_time = [(k, T0 + dt.timedelta(seconds=s), v, i) for i, (k, s, v) in enumerate(data)]
    return create(spark, with_time, "k string, ts timestamp_ntz, v int, seq bigint")


def sessions(data, gap):
    result = []
    for k in sorted({k for k, _, _ in data}):
        current = None
        for s, v in sorted((s, v) for key, s, v in data if key == k):
            if current and s - current[1] < gap:
                current[1], current[2], current[3] = s, current[2] + v, current[3] + 1
            else:
                current = [s, s, v, 1]
                result.append((k, current))
    return sorted(
        (T0 + dt.timedelta(seconds=c[0]), T0 + dt.timedelta(seconds=c[1] + gap), k, c[2], c[3])
        for k, c in result)


@few
@given(events, st.sampled_from([1, 7, 10]))
def test_sessions_against_brute_force(spark, data, gap):
    got = op.session_windows(timed(spark, data), ["k"], "ts", "v", gap)
    assert sorted(tuple(r) for r in got.collect()) == sessions(data, gap)


@pytest.mark.parametrize("width", [1, 2, 3])
def test_sessions_that_cross_slices_of_time(spark, monkeypatch, width):
    """Sessions that fill slices, end at their edges or lie between them."""
    monkeypatch.setattr(op.sessions, "SLICE_CELLS", width)
    rng = random.Random(width)
    for step in (3, 9, 14, 30):
        at, data = 0, []
        for _ in range(120):
            at += rng.choice([1, 10, rng.randint(1, step)])
            data.append((rng.choice("ab"), at, rng.randint(-5, 5)))
        got = op.session_windows(timed(spark, data), ["k"], "ts", "v", 10)
        assert sorted(tuple(r) for r in got.collect()) == sessions(data, 10)


def test_sessions_of_one_key_are_spread_over_tasks(spark):
    data = [("hot", 10 * i + 1000 * (i // 20), 1) for i in range(20_000)]
    with session_settings(spark, {"spark.sql.shuffle.partitions": "24",
                                  "spark.sql.adaptive.enabled": "false"}):
        got = op.session_windows(timed(spark, data), ["k"], "ts", "v", 15)
        tasks = got.select(F.spark_partition_id()).distinct().count()
        assert tasks >= 8
        assert rows(got.select("total", "n")) == [(20, 20)] * 1000


def test_events_one_gap_apart_are_two_sessions(spark):
    data = [("a", 0, 1), ("a", 10, 1), ("a", 19, 1)]
    got = op.session_windows(timed(spark, data), ["k"], "ts", "v", 10)
    assert [r["n"] for r in sorted(got.collect())] == [1, 2]


@few
@given(events)
def test_window_sums_add_up(spark, data):
    df = timed(spark, data)
    total = sum(v for _, _, v in data)
    fixed = op.fixed_windows(df, ["k"], "ts", "v", "5 seconds")
    sliding = op.sliding_windows(df, ["k"], "ts", "v", "10 seconds", "5 seconds")
    assert sum(r["total"] for r in fixed.collect()) == total
    assert sum(r["total"] for r in sliding.collect()) == 2 * total
    expected = defaultdict(int)
    for k, s, v in data:
        expected[k, T0 + dt.timedelta(seconds=s // 5 * 5)] += v
    assert {(r["k"], r["window_start"]): r["total"] for r in fixed.collect()} == expected


@few
@given(events, st.sampled_from([1, 3, 5]), st.sampled_from([2, 7]), st.sampled_from([1, 12, 1000]))
def test_panes_against_brute_force(spark, data, size, slice_width, hot_rows):
    df = timed(spark, data).repartition(3)
    by_slice = F.floor(F.col("seq") / slice_width)
    got = op.count_panes(
        df, ["k"], ["seq"], "v", size, slice_column=by_slice, hot_rows=hot_rows)
    expected = []
    for k in "ab":
        values = [v for key, _, v in data if key == k]
        for i in range(len(values) // size):
            expected.append((k, i, sum(values[i * size:(i + 1) * size])))
    assert sorted(tuple(r) for r in got.collect()) == expected


@few
@given(events, st.integers(0, 40), st.sampled_from([1, 8, 1000]))
def test_panes_go_on_from_a_state(spark, data, cut, hot_rows):
    from millstream.operators.panes import pane_sums

    df = timed(spark, data)
    by_slice = F.floor(F.col("seq") / 3)
    first = pane_sums(df.where(F.col("seq") < cut), ["k"], ["seq"], "v", 5, "total",
                      by_slice, hot_rows)
    state = op.pane_state(first, ["k"], 5)
    second = pane_sums(df.where(F.col("seq") >= cut), ["k"], ["seq"], "v", 5, "total",
                       by_slice, hot_rows, state=state)
    parts = first.unionByName(second).where("n = 5").drop("n")
    assert rows(parts) == rows(op.count_panes(df, ["k"], ["seq"], "v", 5))


def test_panes_without_hot_keys_shuffle_once(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id", F.lit(1).alias("v"))
    plan = op.count_panes(df, ["k"], ["id"], "v")._jdf.queryExecution().executedPlan()
    assert plan.toString().count("Exchange hashpartitioning") == 1


def test_hot_keys_are_found_by_sample(spark):
    from millstream.operators.hot_keys import hot_keys, key_hash

    df = spark.range(300_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id")).alias("k"))
    hot = hot_keys(df, ["k"], 20_000)
    want = df.where("k is null").limit(1).select(key_hash(["k"])).collect()[0][0]
    assert [r[0] for r in hot.select("_key_hash").collect()] == [want]
    assert abs(hot.collect()[0]["_rows"] - 100_000) < 5_000
    assert hot_keys(df.where("k is not null"), ["k"], 20_000) is None


def test_panes_keep_rows_without_key_or_time(spark):
    data = [(None, None, 1), (None, T0, 2), ("a", T0, 3)]
    df = create(spark, data, "k string, ts timestamp_ntz, v int")
    for hot_rows in (1, 1000):
        got = op.count_panes(df, ["k"], ["ts", "v"], "v", 2, hot_rows=hot_rows)
        assert rows(got) == [(None, 0, 3)]
    with pytest.raises(TypeError):
        op.count_panes(df, ["v"], ["k"], "v", 2)


@pytest.mark.parametrize("hot_rows", [1, 40, 700])
def test_slices_of_a_burst_are_even(spark, hot_rows):
    """Most rows of a key fall within a minute; some have no time, many the same one."""
    from millstream.operators.hot_keys import hot_keys
    from millstream.operators.panes import SLICES, slice_bounds, slice_of, with_hot_rows

    burst = F.when(F.col("id") % 10 == 0, F.col("id") * 1_000_000).otherwise(
        F.lit(5_000_000_000) + F.col("id"))
    df = spark.range(4000).select(
        F.lit("hot").alias("k"),
        F.when(F.col("id") > 3, F.timestamp_micros(burst)).alias("ts"), F.col("id").alias("v"))
    df = df.unionAll(df.where("v < 50").withColumn("k", F.lit(None).cast("string")))
    got = sorted((r.k is None, r.pane, r.total) for r in op.count_panes(
        df, ["k"], ["ts", "v"], "v", 5, hot_rows=hot_rows).collect())
    want = []
    for k in ("hot", None):
        ordered = [r.v for r in df.where(F.col("k").eqNullSafe(F.lit(k))).collect()]
        at = lambda i: (i > 3, i * 1_000_000 if i % 10 == 0 else 5_000_000_000 + i, i)
        ordered.sort(key=at)
        want += [(k is None, p, sum(ordered[5 * p:5 * p + 5])) for p in range(len(ordered) // 5)]
    assert got == sorted(want)

    hot = slice_bounds(df, hot_keys(df, ["k"], hot_rows), ["k"], "ts", hot_rows)
    sizes = [r["count"] for r in with_hot_rows(df, hot, ["k"]).where("k = 'hot'").groupBy(
        slice_of(F.col("ts"), F.col("_bounds")).alias("s")).count().collect()]
    n = min(SLICES, -(-4000 // hot_rows))
    assert len(sizes) >= 0.6 * n and max(sizes) <= 3 * 4000 / n + 8


def test_slices_of_equal_and_missing_values(spark):
    df = spark.range(100).select(F.lit(1).alias("k"), F.lit(None).cast("long").alias("o"), "id")
    for column in (df["o"], F.lit(7).cast("long")):
        same = df.withColumn("o", column)
        got = op.count_panes(same, ["k"], ["o", "id"], "id", 10, hot_rows=5)
        assert sorted(r.total for r in got.collect()) == [45 + 100 * i for i in range(10)]
    with pytest.raises(TypeError, match="give slice_column"):
        op.count_panes(df.withColumn("o", F.lit("x")), ["k"], ["o"], "id", 10, hot_rows=5)
