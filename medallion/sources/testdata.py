"""Bronze batches cut from the driver's TPC-H-like tables.

Mapping onto the sales ETL's bronze layout:

* customer: ``id`` = ``c_custkey``; ``first_name`` / ``last_name`` are the two
  halves of ``c_name`` around ``#``; ``state_id`` = ``n_name`` of the
  customer's nation (NULL if it has none); ``datetime_created`` /
  ``datetime_updated`` are the first and last ``o_orderdate`` of the customer's
  orders in the batch, ``NO_ORDERS`` without orders: a customer is known before
  its first order, and its first order makes a new version of it. (Without any
  version time a customer would be open twice once it has orders, and its orders
  would be counted twice.)
* orders: ``order_id`` = ``o_orderkey`` as text, ``customer_id`` =
  ``o_custkey``, ``item_id`` / ``item_name`` carry ``o_orderstatus`` /
  ``o_orderpriority``, both timestamps are ``o_orderdate``.

A batch is the state of the source as of a cut: all customers, and the orders
placed before it (no cut: the whole table). Batch 1 is as of 1996-01-01, batch 2 is everything, so
batch 2 holds new, changed and unchanged customers relative to batch 1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Cut of each fixture batch (None = whole table).
BATCH_CUTS = {1: "1996-01-01", 2: None}
# Fixed value: version time of a customer without orders.
NO_ORDERS = "1970-01-01 00:00:00"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one of the given (read-only) tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _orders_before(spark: SparkSession, sf_dir: str, cut: str | None) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders")
    if cut is not None:
        orders = orders.where(F.col("o_orderdate") < F.lit(cut).cast("timestamp_ntz"))
    return orders


def customer_batch(spark: SparkSession, sf_dir: str, cut: str | None = None) -> DataFrame:
    """One row per customer, with the dates of its orders before ``cut``."""
    # Aggregate the orders first (partial aggregation map-side, so a customer
    # with a huge share of the orders costs one row per task), then attach the
    # customer and its nation.
    per_customer = (
        _orders_before(spark, sf_dir, cut)
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(
            F.min("o_orderdate").alias("datetime_created"),
            F.max("o_orderdate").alias("datetime_updated"),
        )
    )
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        customer.join(per_customer, "c_custkey", "left")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            F.col("c_custkey").cast("bigint").alias("id"),
            F.split_part(F.col("c_name"), F.lit("#"), F.lit(1)).alias("first_name"),
            F.split_part(F.col("c_name"), F.lit("#"), F.lit(2)).alias("last_name"),
            F.col("n_name").alias("state_id"),
            *[
                F.coalesce(F.col(c).cast("timestamp_ntz"), F.lit(NO_ORDERS).cast("timestamp_ntz")).alias(c)
                for c in ("datetime_created", "datetime_updated")
            ],
        )
    )


def orders_batch(spark: SparkSession, sf_dir: str, cut: str | None = None) -> DataFrame:
    """Orders placed before ``cut``, in the bronze orders layout."""
    return _orders_before(spark, sf_dir, cut).select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("bigint").alias("customer_id"),
        F.col("o_orderstatus").alias("item_id"),
        F.col("o_orderpriority").alias("item_name"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("delivered_on"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("datetime_order_placed"),
    )


def batch_source(sf_dir: str, cut: str | None = None):
    """A bronze source for the sales ETL: (spark) -> (customer, orders)."""

    def source(spark: SparkSession):
        return customer_batch(spark, sf_dir, cut), orders_batch(spark, sf_dir, cut)

    return source
