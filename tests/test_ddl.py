"""Catalog DDL: layouts, drops keep files."""

from medallion.plans.ddl import (
    create_all,
    drop_all,
    drop_bronze_tables,
    drop_interface_views,
)
from medallion.operators.publish import partition_columns, replace_partition


def test_layouts(spark, lake):
    cols = {t: spark.table(f"{lake.db}.{t}").columns for t in
            ("customer", "orders", "dim_customer", "fct_orders", "sales_mart", "run_metadata", "dq_results")}
    assert cols["dim_customer"][-1] == "partition" and "etl_inserted" not in cols["dim_customer"]
    assert cols["fct_orders"][-3:] == ["customer_sur_id", "etl_inserted", "partition"]
    assert cols["sales_mart"] == ["deliver_date", "state_id", "num_orders", "etl_inserted", "partition"]
    for t in ("customer", "orders", "dim_customer", "fct_orders", "sales_mart"):
        assert partition_columns(spark, f"{lake.db}.{t}") == (["key_bucket"] if t == "dim_customer" else []) + ["partition"]
    assert spark.table(f"{lake.bi}.sales_mart").columns == ["state_id", "delivery_date", "num_orders"]


def test_drop_keeps_files(spark, lake):
    t = f"{lake.db}.orders"
    frame = spark.createDataFrame(
        [("o1", 1, "i", "car", None, None)],
        "order_id STRING, customer_id BIGINT, item_id STRING, item_name STRING, "
        "delivered_on TIMESTAMP_NTZ, datetime_order_placed TIMESTAMP_NTZ",
    )
    staged = replace_partition(spark, t, frame, "p")
    drop_interface_views(spark, lake.bi)
    drop_bronze_tables(spark, lake.db)
    assert not spark.catalog.tableExists(t)
    assert staged.count() == 1  # the staged files are still there
    drop_all(spark, lake.db, lake.bi)
    assert not spark.catalog.databaseExists(lake.db)
    create_all(spark, lake.path, lake.db, lake.bi)  # the published partitions come back
    assert [r["order_id"] for r in spark.table(t).collect()] == ["o1"]
    create_all(spark, lake.path, lake.db, lake.bi)  # and a rerun changes nothing
    assert spark.table(t).count() == 1
