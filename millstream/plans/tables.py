"""The tables that the queries read, and how they stand in for the files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import to_cents


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as department records: the priority is the department."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("name"),
        F.col("o_orderpriority").alias("dept"))


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the value in cents; ``ts`` carries no zone."""
    return table(spark, sf_dir, "events").withColumn("cents", to_cents("value"))


def card_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as monthly card statements; the order is the card's account."""
    items = table(spark, sf_dir, "lineitem", "l_orderkey", "l_extendedprice", "l_discount")
    return items.select(
        F.col("l_orderkey").alias("account"),
        F.col("l_extendedprice").alias("total_spent"),
        (F.col("l_extendedprice") * (1 - 4 * F.col("l_discount"))).alias("cleared_amount"),
        F.lit(60000.0).alias("max_credit_limit"))


def loan_records(spark: SparkSession, sf_dir: str, priority: str | None = None) -> DataFrame:
    """Line items as loan payments of the part's buyer, with 900 days to pay; of all
    orders or those of one priority."""
    items = table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_shipdate")
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate", "o_orderpriority")
    if priority:
        orders = orders.where(F.col("o_orderpriority") == priority)
    return items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_partkey").alias("customer_id"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "Medical Loan")
        .otherwise("Personal Loan").alias("loan_category"),
        F.to_date("o_orderdate").alias("due_date"),
        F.date_sub(F.to_date("l_shipdate"), 900).alias("payment_date"))


def sale_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as sales: supplier = store, return flag = city, prices in cents."""
    items = table(spark, sf_dir, "lineitem", "l_partkey", "l_suppkey", "l_quantity",
                  "l_extendedprice", "l_returnflag")
    parts = table(spark, sf_dir, "part", "p_partkey", "p_retailprice")
    return items.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_suppkey").alias("store_id"),
        F.col("l_returnflag").alias("store_location"),
        F.col("l_quantity").cast("bigint").alias("pieces"),
        to_cents("p_retailprice").alias("buy_rate"),
        to_cents("l_extendedprice").alias("sell_price"))
