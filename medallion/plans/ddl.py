"""Catalog DDL of the sales ETL: databases, layer tables, the BI view.

Tables are external Parquet tables: dropping one keeps its files, and creating
it again finds them. Each table records its home folder (where new versions are
staged) as a table property. Databases get an explicit location under the same storage path, so
nothing is written to a machine-local warehouse folder.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from medallion.model import (
    DEFAULT_BI_DATABASE,
    DEFAULT_DATABASE,
    CUSTOMER_COLUMNS,
    DIM_CUSTOMER_COLUMNS,
    ETL_INSERTED,
    FCT_ORDERS_COLUMNS,
    ORDERS_COLUMNS,
    PARTITION,
    SALES_MART_COLUMNS,
    ddl_columns,
)
from medallion.operators.publish import BUCKET, BUCKET_KEYS_PROPERTY, BUCKETS_PROPERTY, HOME_PROPERTY, reattach, serve_latest
from medallion.session import sql_str

RUN_LOG_COLUMNS = (
    ("run_id", "STRING"),
    ("pipeline_id", "STRING"),
    ("run_params", "STRING"),
    ("ts_inserted", "TIMESTAMP"),
)
CHECK_RESULT_COLUMNS = (
    ("run_id", "STRING"),
    ("dataset", "STRING"),
    ("rule", "STRING"),
    ("column", "STRING"),
    ("element_count", "BIGINT"),
    ("unexpected_count", "BIGINT"),
    ("success", "BOOLEAN"),
    ("checked_at", "TIMESTAMP"),
)

BRONZE = {
    "customer": (CUSTOMER_COLUMNS + (ETL_INSERTED, PARTITION), True),
    "orders": (ORDERS_COLUMNS + (ETL_INSERTED, PARTITION), True),
}
SILVER = {
    # The dimension has no etl_inserted. Its files are laid out by the bucket
    # of their key and by ``partition`` (the run that last wrote a row), so an
    # upsert looks for its keys in their buckets only and rewrites there only
    # the partitions holding rows it replaces plus the run's own.
    "dim_customer": (DIM_CUSTOMER_COLUMNS + (PARTITION,), True),
    "fct_orders": (FCT_ORDERS_COLUMNS + (ETL_INSERTED, PARTITION), True),
}
GOLD = {"sales_mart": (SALES_MART_COLUMNS + (ETL_INSERTED, PARTITION), True)}
BUCKETED = {"dim_customer": ("customer_sur_id",)}
# Buckets of a bucketed table made here: for a dimension of terabytes give as
# many as make one bucket a few hundred megabytes.
DEFAULT_BUCKETS = 4
METADATA = {"run_metadata": (RUN_LOG_COLUMNS, False), "dq_results": (CHECK_RESULT_COLUMNS, False)}


def create_database(spark: SparkSession, database: str, path: str) -> None:
    spark.sql(
        f"CREATE DATABASE IF NOT EXISTS {database} LOCATION {sql_str(f'{path}/_databases/{database}.db')}"
    )


def create_table(
    spark: SparkSession, database: str, name: str, columns, partitioned: bool, path: str,
    bucket_keys=(), buckets: int = DEFAULT_BUCKETS,
) -> None:
    """Create the table if it does not exist. A table made anew over a folder
    that was published to before gets its partitions back from there. With
    ``bucket_keys`` it is laid out by the bucket of those columns first."""
    home = f"{path.rstrip('/')}/{name}"
    if spark.catalog.tableExists(f"{database}.{name}"):
        return
    layout, properties = [PARTITION[0]] if partitioned else [], {HOME_PROPERTY: home}
    if bucket_keys:
        columns = (*columns, (BUCKET, "INT"))
        layout.insert(0, BUCKET)
        properties |= {BUCKETS_PROPERTY: str(buckets), BUCKET_KEYS_PROPERTY: ",".join(bucket_keys)}
    spark.sql(
        f"CREATE TABLE {database}.{name} (\n  {ddl_columns(columns)}\n) USING parquet"
        + (f" PARTITIONED BY ({', '.join(f'`{c}`' for c in layout)})" if layout else "")
        + f" LOCATION {sql_str(home)}"
        + f" TBLPROPERTIES ({', '.join(f'{sql_str(k)} = {sql_str(v)}' for k, v in properties.items())})"
    )
    reattach(spark, f"{database}.{name}")


def _create_layer(spark, layer, path, database, buckets: int = DEFAULT_BUCKETS) -> None:
    create_database(spark, database, path)
    for name, (columns, partitioned) in layer.items():
        create_table(spark, database, name, columns, partitioned, path, BUCKETED.get(name, ()), buckets)


def create_bronze_tables(spark: SparkSession, path: str, database: str = DEFAULT_DATABASE) -> None:
    _create_layer(spark, BRONZE, path, database)


def create_silver_tables(
    spark: SparkSession, path: str, database: str = DEFAULT_DATABASE, buckets: int = DEFAULT_BUCKETS
) -> None:
    _create_layer(spark, SILVER, path, database, buckets)


def create_gold_tables(spark: SparkSession, path: str, database: str = DEFAULT_DATABASE) -> None:
    _create_layer(spark, GOLD, path, database)


def create_metadata_tables(spark: SparkSession, path: str, database: str = DEFAULT_DATABASE) -> None:
    _create_layer(spark, METADATA, path, database)


def create_interface_views(
    spark: SparkSession,
    path: str,
    database: str = DEFAULT_BI_DATABASE,
    src_database: str = DEFAULT_DATABASE,
) -> None:
    """The BI view: newest partition of the mart, renamed columns. Each publish
    of the mart renews it with that partition as a literal, so its readers list
    and open one partition, however many there are."""
    create_database(spark, database, path)
    serve_latest(spark, f"{src_database}.sales_mart", f"{database}.sales_mart", "state_id, deliver_date AS delivery_date, num_orders")


# The mart over all runs (operators.mart_state): counts by key and date of each
# run, and the cells. Made on request, not by ``create_all``.
TOTALS = {
    "mart_key_counts": ((("customer_sur_id", "STRING"), ("deliver_date", "DATE"), ("num_orders", "BIGINT"), PARTITION), True),
    "mart_totals": (SALES_MART_COLUMNS + (PARTITION,), True),
}
ALL_TABLES = {**BRONZE, **SILVER, **GOLD, **METADATA, **TOTALS}


def create_tables(spark: SparkSession, path: str, database: str, names, buckets: int = DEFAULT_BUCKETS) -> None:
    """Create only the named tables (of any layer) in ``database``."""
    create_database(spark, database, path)
    for name in names:
        columns, partitioned = ALL_TABLES[name]
        create_table(spark, database, name, columns, partitioned, path, BUCKETED.get(name, ()), buckets)


def create_all(
    spark: SparkSession,
    path: str,
    database: str = DEFAULT_DATABASE,
    bi_database: str = DEFAULT_BI_DATABASE,
    buckets: int = DEFAULT_BUCKETS,
) -> None:
    create_bronze_tables(spark, path, database)
    create_silver_tables(spark, path, database, buckets)
    create_gold_tables(spark, path, database)
    create_metadata_tables(spark, path, database)
    create_interface_views(spark, path, bi_database, database)


def _drop_layer(spark, layer, database) -> None:
    for name in layer:
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")


def drop_bronze_tables(spark: SparkSession, database: str = DEFAULT_DATABASE) -> None:
    _drop_layer(spark, BRONZE, database)


def drop_silver_tables(spark: SparkSession, database: str = DEFAULT_DATABASE) -> None:
    _drop_layer(spark, SILVER, database)


def drop_gold_tables(spark: SparkSession, database: str = DEFAULT_DATABASE) -> None:
    _drop_layer(spark, GOLD, database)


def drop_interface_views(spark: SparkSession, database: str = DEFAULT_BI_DATABASE) -> None:
    spark.sql(f"DROP VIEW IF EXISTS {database}.sales_mart")
    spark.sql(f"DROP DATABASE IF EXISTS {database}")


def drop_all(
    spark: SparkSession, database: str = DEFAULT_DATABASE, bi_database: str = DEFAULT_BI_DATABASE
) -> None:
    """Drop view, tables and databases (files stay: the tables are external)."""
    spark.sql(f"DROP VIEW IF EXISTS {bi_database}.sales_mart")
    spark.sql(f"DROP DATABASE IF EXISTS {bi_database}")
    for layer in (BRONZE, SILVER, GOLD, METADATA):
        _drop_layer(spark, layer, database)
    spark.sql(f"DROP DATABASE IF EXISTS {database}")


def main(argv: list[str] | None = None) -> None:
    """``spark-submit -m medallion.plans.ddl <storage path> [database] [--hive]``."""
    import sys

    from medallion.session import build_session

    args = list(sys.argv[1:] if argv is None else argv)
    hive = "--hive" in args
    args = [a for a in args if a != "--hive"]
    if not args:
        raise SystemExit("a storage path is required")
    create_all(build_session(None, None, app_name="medallion_ddl", enable_hive=hive), args[0], *args[1:2])


if __name__ == "__main__":
    main()
