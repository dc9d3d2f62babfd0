"""Queries of the element-wise, grouping and joining operators."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import operators as op
from ..functions.numbers import to_cents, to_int
from ..functions.text import (
    field, fields_after, from_bytes, join_fields, pair_text, split_fields, strip_all, to_bytes,
)
from ..operators.pardo import tagged_output
from ..operators.grouping import sum_list
from ..session import cut_lineage
from ..sources import create, create_from_map
from . import attendance, cards, loans, sales, words
from .registry import query
from .tables import (
    card_records, event_records, loan_records, order_records, sale_records, table,
)

URGENT, HIGH = "1-URGENT", "2-HIGH"

CENTS = "CAST(round({} * 100) AS BIGINT)"
VALUE_CENTS = CENTS.format("value")
SPLIT_WORDS = "unnest(regexp_split_to_array(text, '[^a-zA-Z]+'))"


# ---- attendance ------------------------------------------------------------

ATTENDANCE_SQL = """
SELECT o_custkey AS name, count(*) AS n FROM orders
WHERE o_orderpriority = '1-URGENT' GROUP BY 1
"""


@query(ATTENDANCE_SQL)
def attendance_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attendance.attendance_count(order_records(spark, sf_dir), URGENT)


@query(ATTENDANCE_SQL)
def group_then_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attendance.attendance_by_groups(order_records(spark, sf_dir), URGENT)


def urgent_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_records(spark, sf_dir).where(F.col("dept") == URGENT)


def id_list(values: str) -> list[Column]:
    """How many values a list stands for, and the values in order."""
    n = F.aggregate(values, F.lit(0).cast("bigint"), lambda acc, v: acc + v["times"])
    ids = F.array_sort(F.col(values)["value"]).cast("array<string>")
    return [n.alias("n"), F.concat_ws(",", ids).alias("ids")]


@query("""
SELECT o_custkey AS name, o_orderkey AS id, count(*) AS times
FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1, 2
""")
def group_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.count_values(urgent_orders(spark, sf_dir), ["name"], "id", "id")


GROUP_LISTS_SQL = """
SELECT o_custkey AS name, {chunk} count(*) AS n,
       string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS ids
FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY ALL
"""


@query(GROUP_LISTS_SQL.format(chunk=""))
def group_by_key_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = op.group_by_key(urgent_orders(spark, sf_dir), ["name"], "id")
    return groups.select("name", *id_list("values"))


@query(GROUP_LISTS_SQL.format(chunk="CAST(o_orderkey % 4 AS INTEGER) AS chunk,"))
def group_by_key_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = op.group_by_key(urgent_orders(spark, sf_dir), ["name"], "id",
                             chunk=(F.col("value") % 4).cast("int"))
    return groups.select("name", "chunk", *id_list("values"))


@query(ATTENDANCE_SQL)
def group_then_fold_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The count by lists of order ids in seven pieces, folded and merged."""
    rows = urgent_orders(spark, sf_dir)
    groups = op.group_by_key(rows.select("name", F.lit(1).alias("one")), ["name"], "one", chunks=7)
    return op.fold_groups(groups, ["name"], sum_list, name="n")


@query("SELECT o_orderpriority AS label, count(*) AS n FROM orders GROUP BY 1")
def combine_globally(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attendance.label_counts(order_records(spark, sf_dir), "dept")


@query("""
SELECT count(*) AS n, CAST(sum(cents) AS BIGINT) AS total, min(cents) AS lowest,
       max(cents) AS highest
FROM (SELECT CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders)
""")
def combine_globally_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    cents = table(spark, sf_dir, "orders").select(to_cents("o_totalprice").alias("cents"))
    return cents.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("cents"), F.lit(0)).alias("total"),
        F.min("cents").alias("lowest"), F.max("cents").alias("highest"))


@query("""
SELECT o_custkey AS name, count(*) AS n FROM orders
WHERE o_orderpriority = '1-URGENT' GROUP BY 1 HAVING count(*) > 3
""")
def having_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = attendance.attendance_count(order_records(spark, sf_dir), URGENT)
    return counts.transform(op.having(F.col("n") > 3))


@query("""
SELECT o_custkey AS name, 'URGENT' AS branch, count(*) AS n FROM orders
WHERE o_orderpriority = '1-URGENT' GROUP BY 1
UNION ALL
SELECT o_custkey AS name, 'HIGH' AS branch, count(*) AS n FROM orders
WHERE o_orderpriority = '2-HIGH' GROUP BY 1
""")
def branch_and_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = attendance.departments_merged(order_records(spark, sf_dir), [URGENT, HIGH])
    label = F.when(F.col("dept") == URGENT, "URGENT").otherwise("HIGH")
    return counts.select("name", label.alias("branch"), "n")


@query("""
SELECT o_custkey AS name, count(*) AS n, 'Employee' AS tag FROM orders
WHERE o_orderpriority = '1-URGENT' GROUP BY 1 HAVING count(*) > 3
UNION ALL
SELECT o_custkey AS name, count(*) AS n, 'Employee' AS tag FROM orders
WHERE o_orderpriority = '2-HIGH' GROUP BY 1 HAVING count(*) > 3
""")
def composite_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attendance.frequent_names(order_records(spark, sf_dir), [URGENT, HIGH], 3)


@query("""
SELECT key, CAST(sum(cents) AS BIGINT) AS total, count(*) AS n FROM (
  SELECT o_custkey AS key, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders
  UNION ALL
  SELECT l_suppkey, CAST(round(l_extendedprice * 100) AS BIGINT) FROM lineitem
  UNION ALL
  SELECT user_id, CAST(round(value * 100) AS BIGINT) FROM events
) GROUP BY 1
""")
def flatten_three(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("key"), to_cents("o_totalprice").alias("cents"))
    items = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("key"), to_cents("l_extendedprice").alias("cents"))
    events = event_records(spark, sf_dir).select(F.col("user_id").alias("key"), "cents")
    merged = op.flatten(orders, items, events)
    return merged.groupBy("key").agg(F.sum("cents").alias("total"), F.count(F.lit(1)).alias("n"))


@query("""
SELECT o_custkey AS id, o_orderpriority AS name, count(*) AS n FROM orders
WHERE length(o_orderpriority) BETWEEN 3 AND 10 AND o_orderstatus = 'F'
  AND NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = o_custkey)
GROUP BY 1, 2
""")
def side_input_exclude(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("name"),
        F.col("o_orderstatus").alias("dept"))
    exclusions = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"))
    return attendance.attendance_with_exclusions(records, exclusions, "F")


@query("""
SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (
  SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_mktsegment = 'BUILDING')
""")
def exclude_long_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(
        F.col("c_custkey").alias("o_custkey"))
    return op.exclude_long(
        table(spark, sf_dir, "orders", "o_orderkey", "o_custkey"), listed, ["o_custkey"])


@query("""
SELECT p_name AS name, CASE WHEN starts_with(p_name, 'red') THEN 'red'
  WHEN length(p_name) <= 9 THEN 'Short_Names' ELSE 'Long_Names' END AS tag
FROM part
""")
def branch_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "part").select(F.col("p_name").alias("name"))
    return attendance.names_by_kind(names, cutoff_length=9, marker="red")


@query("""
SELECT 'CUSTOMER:' || c_nationkey || ':' || c_mktsegment AS employee,
       CAST(sum(CAST(round(c_acctbal * 100) AS BIGINT)) AS BIGINT) AS total
FROM customer GROUP BY c_nationkey, c_mktsegment
""")
def struct_key_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("id"), F.col("c_mktsegment").alias("name"),
        to_cents("c_acctbal").alias("salary"))
    sums = attendance.salary_per_employee(records)
    text = join_fields(":", F.lit("CUSTOMER"), F.col("employee.id"), F.col("employee.name"))
    return sums.select(text.alias("employee"), "total")


# ---- element-wise ----------------------------------------------------------

LINE_SQL = "o_orderkey || ',' || o_custkey || ',' || o_orderstatus || ',' || o_orderpriority"


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as comma-separated lines."""
    orders = table(spark, sf_dir, "orders")
    return orders.select(join_fields(
        ",", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority").alias("value"))


@query("""
SELECT o_orderkey AS id, o_orderstatus AS status,
       o_custkey || '|' || o_orderstatus || '|' || o_orderpriority AS rest,
       lower(o_orderpriority) AS priority
FROM orders
""")
def map_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = order_lines(spark, sf_dir).select(split_fields("value").alias("f"))
    return split.transform(op.map_columns(
        id=to_int(field("f", 0)), status=field("f", 2),
        rest=F.array_join(fields_after("f", 0), "|"), priority=F.lower(field("f", 3))))


@query(f"""
SELECT word, count(*) AS n FROM (SELECT {SPLIT_WORDS} AS word FROM documents)
WHERE word <> '' GROUP BY 1
""")
def wordcount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.word_count(table(spark, sf_dir, "documents", "text"), "text")


@query("""
SELECT o_orderkey AS id, o_custkey AS name, o_orderpriority AS dept
FROM orders WHERE o_orderpriority = '1-URGENT'
""")
def filter_equals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_records(spark, sf_dir).transform(op.filter_equals("dept", URGENT))


@query("""
SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE l_returnflag IN ('A', 'R')
""")
def filter_isin(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_returnflag")
    return items.transform(op.filter_in("l_returnflag", ["A", "R"]))


class WordLengths(op.DoFn):
    """Every word longer than a bound with its length; texts without one give none."""

    def process(self, element, longer_than: int = 0):
        for word in element.text.split():
            if len(word) > longer_than:
                yield element.role, len(word)


@query("""
SELECT role, length(word) AS length, count(*) AS n FROM (
  SELECT role, unnest(regexp_extract_all(text, '[^ \\t\\n\\v\\f\\r]+')) AS word
  FROM conversations)
WHERE length(word) > 7 GROUP BY 1, 2
""")
def pardo_generic(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations", "role", "text")
    lengths = op.par_do(turns, WordLengths(), "role string, length bigint", longer_than=7)
    return op.count_per_key(lengths, ["role", "length"])


def keep_department(element, dept: str):
    return [element] if element.dept == dept else None


@query("""
SELECT o_orderkey AS id, o_custkey AS name, o_orderpriority AS dept
FROM orders WHERE o_orderpriority = '2-HIGH'
""")
def pardo_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = order_records(spark, sf_dir)
    return op.par_do(records, keep_department, "id bigint, name bigint, dept string", HIGH)


class NameKinds(op.DoFn):
    """The tagged outputs again, from a function of the caller: the first rule that
    holds names the output."""

    def process(self, element, cutoff: int, marker: str):
        name = element.name
        rules = [(marker, name.startswith(marker)), ("Short_Names", len(name) <= cutoff),
                 ("Long_Names", True)]
        yield op.Tagged(next(tag for tag, holds in rules if holds), name)


@query("""
SELECT p_name AS name, CASE WHEN starts_with(p_name, 'red') THEN 'red'
                            WHEN length(p_name) <= 9 THEN 'Short_Names' ELSE 'Long_Names' END AS tag
FROM part
""")
def pardo_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "part").select(F.col("p_name").alias("name"))
    kinds = {"red": "name string", "Short_Names": "name string", "Long_Names": "name string"}
    # written once, so that the function runs once and not for each output
    tagged = cut_lineage(op.par_do_tagged(names, NameKinds(), kinds, "red", 9, "red"))
    outputs = [tagged_output(tagged, k).withColumn("tag", F.lit(k)) for k in kinds]
    return op.flatten(*outputs)


class KindsTable(op.TableFn):
    """The tagged outputs once more, from a function over batches."""

    @classmethod
    def analyze(cls, schema, cutoff: int, marker: str):
        return StructType([*schema.fields, StructField("tag", StringType())])

    def process(self, batch, cutoff: int, marker: str):
        name = batch.column("name")
        tag = pc.if_else(pc.less_equal(pc.utf8_length(name), cutoff), "Short_Names", "Long_Names")
        tag = pc.if_else(pc.starts_with(name, marker), marker, tag)
        yield batch.append_column("tag", tag)


@query("""
SELECT p_name AS name, CASE WHEN starts_with(p_name, 'red') THEN 'red'
                            WHEN length(p_name) <= 9 THEN 'Short_Names' ELSE 'Long_Names' END AS tag
FROM part
""")
def table_function_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "part").select(F.col("p_name").alias("name"))
    return op.apply_table(names, KindsTable, 9, "red")


class RunningTotals(op.TableFn):
    """Sums so far in order, batch by batch, with a last row for the whole partition."""

    def __init__(self):
        self.total, self.key = 0, None

    @classmethod
    def analyze(cls, schema):
        return "cust bigint, order_key bigint, running bigint"

    def process(self, batch):
        sums = pc.add(pc.cumulative_sum(batch.column("cents")), self.total)
        if len(sums):
            self.total, self.key = sums[-1].as_py(), batch.column("cust")[0].as_py()
            yield pa.table({"cust": batch.column("cust"), "order_key": batch.column("order_key"),
                            "running": sums})

    def finish(self):
        if self.key is not None:
            yield pa.table({"cust": [self.key], "order_key": [-1], "running": [self.total]})


@query("""
WITH o AS (SELECT o_custkey AS cust, o_orderkey AS order_key, o_orderdate AS day,
                  CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders)
SELECT CAST(cust AS BIGINT) AS cust, CAST(order_key AS BIGINT) AS order_key, CAST(
         sum(cents) OVER (PARTITION BY cust ORDER BY day, order_key) AS BIGINT) AS running FROM o
UNION ALL SELECT CAST(cust AS BIGINT), -1, CAST(sum(cents) AS BIGINT) FROM o GROUP BY cust
""")
def table_function_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("long").alias("cust"),
        F.col("o_orderkey").cast("long").alias("order_key"),
        F.col("o_orderdate").alias("day"), to_cents("o_totalprice").alias("cents"))
    return op.apply_table(
        orders, RunningTotals, partition_by=["cust"], order_by=["day", "order_key"])


@query(f"""
SELECT CAST(cents AS VARCHAR) AS value
FROM (SELECT {CENTS.format('o_totalprice')} AS cents FROM orders) WHERE cents % 2 = 0
""")
def typed_even_to_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job's own task is to keep the even numbers, here of all order totals."""
    numbers = table(spark, sf_dir, "orders").select(to_cents("o_totalprice").alias("value"))
    return op.chain(
        op.typed("value bigint"),
        lambda df: df.where(F.col("value") % 2 == 0),
        op.typed("value bigint"),
        op.map_columns(value=F.col("value").cast("string")),
        op.typed("value string"),
    )(numbers)


@query(f"""
SELECT '(''' || event_type || ''', ' || {VALUE_CENTS} || ')' AS value FROM events
""")
def record_to_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = event_records(spark, sf_dir)
    return events.select(pair_text("event_type", "cents").alias("value"))


@query("""
SELECT page_id, length(html) AS n_chars, octet_length(encode(html)) AS n_bytes, html AS text
FROM pages
""")
def encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = table(spark, sf_dir, "pages", "page_id", "html").select(
        "page_id", to_bytes("html").alias("data"))
    return coded.select(
        "page_id", F.length(from_bytes("data")).cast("bigint").alias("n_chars"),
        F.octet_length("data").cast("bigint").alias("n_bytes"), from_bytes("data").alias("text"))


@query(r"""
SELECT doc_id, regexp_replace(line, '^[\s\v\p{Z}]+|[\s\v\p{Z}]+$', '', 'g') AS line
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
""")
def strip_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "documents", "doc_id", "text").transform(
        op.flat_map(F.split("text", "\n"), "line", keep=["doc_id"]))
    return lines.select("doc_id", strip_all("line").alias("line"))


# ---- values of the program beside tables -----------------------------------

@query("""
SELECT event_type, count(*) AS n FROM events
WHERE event_type IN ('click', 'view', 'purchase', 'no such type') GROUP BY 1
""")
def create_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = create(spark, ["click", "view", "purchase", "no such type"], "event_type string")
    events = table(spark, sf_dir, "events", "event_type")
    return op.count_per_key(
        events.join(op.bounded_broadcast(wanted), "event_type", "left_semi"), ["event_type"])


@query(f"""
SELECT event_type, CAST(sum({VALUE_CENTS} * weight) AS BIGINT) AS weighted, count(*) AS n
FROM events JOIN (VALUES ('click', 2), ('view', 3), ('click', 2), ('error', 7))
  AS w(event_type, weight) USING (event_type)
GROUP BY 1
""")
def create_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = create(
        spark, [("click", 2), ("view", 3), ("click", 2), ("error", 7)],
        "event_type string, weight int")
    joined = event_records(spark, sf_dir).join(op.bounded_broadcast(weights), "event_type")
    return joined.groupBy("event_type").agg(
        F.sum(F.col("cents") * F.col("weight")).alias("weighted"),
        F.count(F.lit(1)).alias("n"))


@query(f"""
SELECT grp, CAST(sum({VALUE_CENTS}) AS BIGINT) AS total, count(*) AS n
FROM events JOIN (VALUES ('money', 'purchase'), ('look', 'click'), ('look', 'view'),
  ('rest', 'signup'), ('rest', 'error')) AS g(grp, event_type) USING (event_type)
GROUP BY 1
""", name="create_from_map")
def create_from_map_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = create_from_map(
        spark, {"money": ["purchase"], "look": ["click", "view"], "rest": ["signup", "error"]},
        "grp string, types array<string>")
    flat = groups.transform(op.flat_map(F.col("types"), "event_type", keep=["grp"]))
    joined = event_records(spark, sf_dir).join(op.bounded_broadcast(flat), "event_type")
    return joined.groupBy("grp").agg(
        F.sum("cents").alias("total"), F.count(F.lit(1)).alias("n"))


# ---- combiners -------------------------------------------------------------

class MeanFn(op.CombineFn):
    """Mean of whole numbers, kept as (sum, count) so that it is exact."""

    def create_accumulator(self) -> tuple[int, int]:
        return 0, 0

    def add_input(self, accumulator, element):
        return accumulator[0] + element, accumulator[1] + 1

    def add_inputs(self, accumulator, elements):
        return accumulator[0] + int(np.sum(elements)), accumulator[1] + len(elements)

    def merge_accumulators(self, accumulators: Sequence[tuple[int, int]]):
        pairs = list(accumulators)
        return sum(p[0] for p in pairs), sum(p[1] for p in pairs)

    def extract_output(self, accumulator) -> int | None:
        total, count = accumulator
        return total // count if count else None


@query(f"""
SELECT c_nationkey AS nation, c_mktsegment AS segment,
       CAST(floor(CAST(sum({CENTS.format('c_acctbal')}) AS DOUBLE) / count(*)) AS BIGINT) AS mean
FROM customer GROUP BY 1, 2
""")
def combine_fn_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"),
        to_cents("c_acctbal").alias("cents"))
    return op.combine_per_key(rows, ["nation", "segment"], ["cents"], MeanFn(), "mean bigint")


# ---- co-groups -------------------------------------------------------------

def customer_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("key"), F.col("o_orderkey").alias("order_id"))
    return customers, orders


COGROUP_SQL = """
SELECT coalesce(c.key, o.key) AS key, {chunk} coalesce(c.names, '') AS names,
       coalesce(o.ids, '') AS ids, coalesce(o.n, 0) AS n
FROM (SELECT c_custkey AS key, 0 AS chunk, string_agg(c_name, ',' ORDER BY c_name) AS names
      FROM customer GROUP BY 1) c
FULL JOIN (SELECT o_custkey AS key, {piece} AS chunk, count(*) AS n,
                  string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS ids
           FROM orders GROUP BY 1, 2) o ON c.key = o.key AND c.chunk = o.chunk
"""


def cogroup_lists(groups: DataFrame, *more: str) -> DataFrame:
    times = F.aggregate("loc", F.lit(0).cast("bigint"), lambda acc, r: acc + r["times"])
    return groups.select(
        "key", *more, F.concat_ws(",", F.array_sort("dep.row.name")).alias("names"),
        F.concat_ws(",", F.array_sort("loc.row.order_id").cast("array<string>")).alias("ids"),
        times.alias("n"))


@query(COGROUP_SQL.format(chunk="", piece="0"))
def cogroup(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers, orders = customer_inputs(spark, sf_dir)
    return cogroup_lists(op.cogroup({"dep": customers, "loc": orders}, ["key"]))


@query(COGROUP_SQL.format(
    chunk="coalesce(c.chunk, o.chunk) AS chunk,", piece="CAST(o_orderkey % 3 AS INTEGER)"))
def cogroup_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers, orders = customer_inputs(spark, sf_dir)
    pieces = {"dep": F.lit(0), "loc": F.col("order_id") % 3}
    groups = op.cogroup({"dep": customers, "loc": orders}, ["key"], chunk=pieces)
    return cogroup_lists(groups, "chunk")


@query("""
SELECT c_custkey AS key, c_name AS name, o_orderkey AS order_id
FROM customer JOIN orders ON c_custkey = o_custkey
""")
def cogroup_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers, orders = customer_inputs(spark, sf_dir)
    return op.cogroup_join(customers, orders, ["key"], "inner").select("key", "name", "order_id")


@query("""
SELECT c_custkey AS key, c_name AS name, o_orderkey AS order_id
FROM customer LEFT JOIN orders ON c_custkey = o_custkey
""")
def cogroup_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers, orders = customer_inputs(spark, sf_dir)
    return op.cogroup_join(customers, orders, ["key"], "left").select("key", "name", "order_id")


@query("""
WITH marked AS (
  SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_id)
    - row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS island
  FROM events
), streaks AS (
  SELECT user_id, count(*) AS n FROM marked GROUP BY user_id, event_type, island
)
SELECT user_id, CAST(sum(n) AS BIGINT) AS n, max(n) AS longest FROM streaks GROUP BY user_id
""")
def group_stream_streaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Longest streak of one type among the events of a user, in order, batch by batch."""
    def longest(key, batches):
        n = best = current = 0
        last = None
        for _, batch in batches:
            for kind in batch.column("event_type").to_pylist():
                current = current + 1 if kind == last else 1
                best, last = max(best, current), kind
            n += batch.num_rows
        yield pa.RecordBatch.from_pylist(
            [{"user_id": key[0], "n": n, "longest": best}])

    events = table(spark, sf_dir, "events", "user_id", "event_id", "event_type")
    return op.per_group({"events": events}, ["user_id"], longest,
                        "user_id long, n long, longest long", order=["event_id"])


@query("""
WITH steps AS (
  SELECT o_custkey AS key, o_orderkey - lag(o_orderkey) OVER (
    PARTITION BY o_custkey ORDER BY o_orderkey) AS step FROM orders
), paired AS (SELECT key, count(*) AS n, max(step) AS widest FROM steps GROUP BY key)
SELECT coalesce(c_custkey, key) AS key, c_name AS name, coalesce(n, 0) AS n, widest
FROM customer FULL JOIN paired ON c_custkey = key
""")
def cogroup_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with the widest step between their order numbers: the customer's row comes
    first, then the orders in order."""
    def pair(key, batches):
        name, n, last, widest = None, 0, None, None
        for source, batch in batches:
            if source == "customers":
                name = batch.column("name")[0].as_py()
                continue
            ids = batch.column("order_id").to_numpy()
            n += len(ids)
            ids = ids if last is None else np.concatenate(([last], ids))
            steps = np.diff(ids).tolist()
            widest = max([*steps, *([] if widest is None else [widest])], default=None)
            last = ids[-1]
        yield pa.RecordBatch.from_arrays([
            pa.array([key[0]], pa.int64()), pa.array([name], pa.string()),
            pa.array([n], pa.int64()), pa.array([widest], pa.int64())],
            ["key", "name", "n", "widest"])

    customers, orders = customer_inputs(spark, sf_dir)
    return op.per_group({"customers": customers, "orders": orders}, ["key"], pair,
                        "key long, name string, n long, widest long", order=["order_id"])


# ---- use cases -------------------------------------------------------------

@query(f"""
SELECT l_suppkey AS store_id, CAST(sum(({CENTS.format('l_extendedprice')}
  - {CENTS.format('p_retailprice')}) * CAST(l_quantity AS BIGINT)) AS BIGINT) AS profit
FROM lineitem JOIN part ON p_partkey = l_partkey
WHERE l_returnflag IN ('A', 'R') GROUP BY 1
""")
def keyed_profit(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = sale_records(spark, sf_dir).transform(op.filter_in("store_location", ["A", "R"]))
    return op.sum_per_key(sales.with_profit(kept), ["store_id"], "profit", "profit")


def card_sql(bonus: str) -> str:
    return f"""
WITH statements AS (
  SELECT o_custkey AS customer_id, l_extendedprice AS spent,
         l_extendedprice * (1 - 4 * l_discount) AS cleared
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
), points AS (
  SELECT customer_id,
         CASE WHEN cleared < CAST(0.7 AS DOUBLE) * spent THEN 1 ELSE 0 END AS a,
         CASE WHEN spent >= 60000 AND cleared < spent THEN 1 ELSE 0 END AS b
  FROM statements
)
SELECT customer_id, CAST(sum(a + b{bonus}) AS BIGINT) AS points FROM points GROUP BY 1
"""


def customer_points(spark: SparkSession, sf_dir: str, both_bonus: bool) -> DataFrame:
    """Points are added up per order before the orders are joined, on the same
    partitioning: a hot order is reduced before its rows are shuffled."""
    points = cards.card_defaulters(card_records(spark, sf_dir), both_bonus, ["account"])
    owners = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("account"), F.col("o_custkey").alias("customer_id"))
    return op.sum_per_key(points.join(owners, "account"), ["customer_id"], "points", "points")


@query(card_sql(" + a * b"))
def card_defaulters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_points(spark, sf_dir, both_bonus=True)


@query(card_sql(""))
def card_defaulters_without_bonus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_points(spark, sf_dir, both_bonus=False)


LOAN_CTE = """
WITH flags AS (
  SELECT l_partkey AS customer_id,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'medical_loan' ELSE 'personal_loan' END AS tag,
         CAST(o_orderdate AS DATE) AS due_date, CAST(l_shipdate AS DATE) - 900 AS payment_date,
         CASE WHEN CAST(o_orderdate AS DATE) < CAST(l_shipdate AS DATE) - 900
              THEN 1 ELSE 0 END AS late
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
), medical AS (
  SELECT customer_id, CAST(sum(late) AS BIGINT) AS late FROM flags
  WHERE tag = 'medical_loan' GROUP BY 1 HAVING sum(late) >= 3
), monthly AS (
  SELECT customer_id, month(due_date) AS m, late,
         row_number() OVER (PARTITION BY customer_id, month(due_date)
                            ORDER BY due_date DESC, payment_date DESC) AS rn
  FROM flags WHERE tag = 'personal_loan'
), calendar AS (
  SELECT p.customer_id, c.m, coalesce(f.late, 1) AS missed
  FROM (SELECT DISTINCT customer_id FROM monthly) p
  CROSS JOIN (SELECT unnest(range(1, 13)) AS m) c
  LEFT JOIN (SELECT * FROM monthly WHERE rn = 1) f
    ON f.customer_id = p.customer_id AND f.m = c.m
), runs AS (
  SELECT customer_id, missed,
         missed + lag(missed, 1, 0) OVER (PARTITION BY customer_id ORDER BY m) AS pair
  FROM calendar
), personal AS (
  SELECT customer_id, CAST(sum(missed) AS INTEGER) AS n_missed FROM runs
  GROUP BY 1 HAVING sum(missed) >= {minimum} OR max(pair) = 2
)
"""


@query(LOAN_CTE.format(minimum=4) + "SELECT customer_id, tag, due_date, late FROM flags")
def loan_late_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = loans.late_flags(loan_records(spark, sf_dir), ["customer_id"])
    return flags.select("customer_id", "tag", "due_date", "late")


@query(LOAN_CTE.format(minimum=4) + "SELECT * FROM medical")
def loan_medical_defaulters(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the filter stands on the stored column, where the scan can use it
    records = loan_records(spark, sf_dir, URGENT)
    flags = loans.late_flags(records, ["customer_id"])
    return loans.medical_defaulters(flags, ["customer_id"])


@query(LOAN_CTE.format(minimum=4) + "SELECT * FROM personal")
def loan_personal_defaulters(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = loans.late_flags(loan_records(spark, sf_dir), ["customer_id"])
    return loans.personal_defaulters(flags, ["customer_id"])


@query(LOAN_CTE.format(minimum=5) + "SELECT * FROM personal")
def loan_personal_defaulters_from_five(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = loans.late_flags(loan_records(spark, sf_dir), ["customer_id"])
    return loans.personal_defaulters(flags, ["customer_id"], min_missed=5)


PAYMENTS_SQL = LOAN_CTE.format(minimum=4) + """
SELECT customer_id, count(*) AS n, CAST(sum(late) AS BIGINT) AS late FROM flags
WHERE tag = 'personal_loan' GROUP BY 1
"""


def personal_payments(spark: SparkSession, sf_dir: str, chunks: int) -> DataFrame:
    """Payments and late ones per person, from the lists."""
    flags = loans.late_flags(loan_records(spark, sf_dir), ["customer_id"])
    personal = flags.where(F.col("tag") == "personal_loan")
    lists = loans.payments_per_person(personal, ["customer_id"], chunks)
    zero = F.lit(0).cast("bigint")
    n = F.aggregate("payments", zero, lambda acc, p: acc + p["times"])
    late = F.aggregate("payments", zero, lambda acc, p: acc + p["value"]["late"] * p["times"])
    return lists.groupBy("customer_id").agg(F.sum(n).alias("n"), F.sum(late).alias("late"))


@query(PAYMENTS_SQL)
def loan_payments_per_person(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_payments(spark, sf_dir, 1)


@query(PAYMENTS_SQL)
def loan_payments_in_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_payments(spark, sf_dir, 5)


@query(LOAN_CTE.format(minimum=4) + """
SELECT CAST(customer_id AS VARCHAR) AS name FROM medical
UNION ALL SELECT CAST(customer_id AS VARCHAR) FROM personal
""")
def loan_defaulters(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = loans.late_flags(loan_records(spark, sf_dir), ["customer_id"])
    return loans.all_defaulters(flags, ["customer_id"])
