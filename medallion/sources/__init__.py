"""Inputs: the given parquet tables, bronze batches cut from them, generated rows."""

from medallion.sources.generate import generate_bronze, generate_customers, generate_orders
from medallion.sources.testdata import (
    BATCH_CUTS,
    customer_batch,
    orders_batch,
    read_table,
    batch_source,
)

__all__ = [
    "BATCH_CUTS",
    "customer_batch",
    "generate_bronze",
    "generate_customers",
    "generate_orders",
    "orders_batch",
    "read_table",
    "batch_source",
]
