"""Registered queries over the driver's tables, each with DuckDB oracle SQL.

Every query reads the given parquet tables (whole tables; batch 1 is the
source as of a date cut, batch 2 is all of it). Queries that publish create
their own databases and storage folder under the session's shared folder and
return a frame over the published table, without load-time columns.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.functions.columns import OPEN_END, with_surrogate_key
from medallion.model import Dataset, Publish
from medallion.operators import publish
from medallion.operators.checks import (
    SALES_SUITES,
    InvalidDataError,
    append_results,
    check_datasets,
    not_null,
    unique,
)
from medallion.operators.keys import repeated_keys, stage_unique
from medallion.operators.latest import latest_partition
from medallion.operators.lookup import lookup_current
from medallion.operators.mart import sales_mart as sales_mart_op
from medallion.operators.mart_state import update_mart
from medallion.operators.history import scd2_versions
from medallion.operators.profiles import PartProfiles
from medallion.operators.publish import materialize, published, replace_partition, upsert
from medallion.operators.sizing import observe_profile
from medallion.operators.scd2 import (
    current_rows,
    scd2_changes,
    scd2_closures,
    scd2_net_new,
    scd2_new_versions,
)
from medallion.operators.runlog import read_log
from medallion.plans.ddl import create_all, create_interface_views, create_tables, drop_all
from medallion.plans.etl import publish_datasets
from medallion.plans.sales import SalesMartETL
from medallion.session import scratch_path, shared_dir
from medallion.sources.testdata import (
    BATCH_CUTS,
    NO_ORDERS,
    customer_batch,
    orders_batch,
    read_table,
    batch_source,
)

# Partition strings of the runs in these queries.
RUN_PARTITIONS = ("2024-01-01-00-00-00", "2024-01-02-00-00-00", "2024-01-03-00-00-00")
P1, P2, P3 = RUN_PARTITIONS
DIM_KEYS = ("customer_sur_id",)
DIM_ONLY = ("dim_customer",)
# what bounds the broadcasts of later joins: the current rows' columns they take
DIM_PROFILE = PartProfiles(("id", "customer_sur_id", "state_id"), where="current")


class Lake:
    """Fresh databases and storage folder for one query call: the named
    tables only, or every table and the BI view."""

    def __init__(
        self, spark: SparkSession, tag: str, tables: Sequence[str] | None = None, view: bool = False
    ):
        token = uuid.uuid4().hex[:10]
        self.spark = spark
        self.path = f"{shared_dir(spark)}/queries/{tag}-{token}"
        self.db = f"q_{tag}_{token}"
        self.bi = f"q_{tag}_{token}_bi"
        if tables is None:
            create_all(spark, self.path, self.db, self.bi)
        else:
            create_tables(spark, self.path, self.db, tables)
            if view:
                create_interface_views(spark, self.path, self.bi, self.db)

    def t(self, name: str) -> str:
        return f"{self.db}.{name}"


def _source(spark: SparkSession, sf: str, batch: int) -> DataFrame:
    return with_surrogate_key(customer_batch(spark, sf, BATCH_CUTS[batch]))


def _changes(spark: SparkSession, sf: str, batch: int, dim: DataFrame) -> DataFrame:
    """SCD2 changes of a batch; its rows are written once, and the observed
    size decides how its ids meet the dimension."""
    observed, profile = observe_profile(_source(spark, sf, batch))
    source = materialize(observed, scratch_path(spark, "batches"))
    return scd2_changes(source, dim, broadcast_ids=profile().fits(source, ["id"]))


def _orders(spark: SparkSession, sf: str, batch: int) -> DataFrame:
    return orders_batch(spark, sf, BATCH_CUTS[batch])


def _dim_version(spark: SparkSession, sf: str, lake: Lake, batches: Sequence[int]):
    """Dimension after upserting the SCD2 changes of each batch in turn
    (batch i published as run partition i); the last published version, with
    its size profile."""
    table = lake.t("dim_customer")
    for i, b in enumerate(batches):
        staged = _upsert_batch(spark, sf, table, b, RUN_PARTITIONS[i])
    return staged


def _upsert_batch(spark, sf, table, batch, partition):
    changes = _changes(spark, sf, batch, spark.table(table)).withColumn("partition", F.lit(partition))
    return upsert(spark, table, changes, DIM_KEYS, sort_within=("current",), profile=DIM_PROFILE)


def _dim_after(spark: SparkSession, sf: str, lake: Lake, batches: Sequence[int]) -> DataFrame:
    _dim_version(spark, sf, lake, batches)
    return published(spark, lake.t("dim_customer"))


def _lookup_fits(staged) -> bool | None:
    """Broadcast decision from the observed size of the new version, or
    None (measure) when the write did not cover the whole table."""
    if staged.profile is None:
        return None
    return staged.profile.fits(staged.frame, ["id", "customer_sur_id"])


def _mart_fits(staged) -> bool | None:
    if staged.profile is None:
        return None
    return staged.profile.fits(staged.frame, ["customer_sur_id", "state_id"])


def _without_load_time(frame: DataFrame) -> DataFrame:
    return frame.drop("etl_inserted")


# ------------------------------------------------------------------ queries


def q_bronze_customer(spark, sf):
    return customer_batch(spark, sf, BATCH_CUTS[2])


def q_bronze_orders(spark, sf):
    return orders_batch(spark, sf, BATCH_CUTS[2])


def q_surrogate_key(spark, sf):
    return _source(spark, sf, 2).select("id", "datetime_updated", "customer_sur_id")


def _parts(spark, sf, tag):
    lake = Lake(spark, tag, DIM_ONLY)
    return _source(spark, sf, 2), _dim_after(spark, sf, lake, [1])


def q_scd2_net_new(spark, sf):
    return scd2_net_new(*_parts(spark, sf, "net_new"))


def q_scd2_new_versions(spark, sf):
    return scd2_new_versions(*_parts(spark, sf, "new_versions"))


def q_scd2_closures(spark, sf):
    return scd2_closures(*_parts(spark, sf, "closures"))


def q_scd2_batch(spark, sf):
    return _changes(spark, sf, 2, _dim_after(spark, sf, Lake(spark, "scd2_batch", DIM_ONLY), [1]))


def q_dim_current(spark, sf):
    dim = _dim_after(spark, sf, Lake(spark, "dim_current", DIM_ONLY), [1, 2])
    return current_rows(dim).select("customer_sur_id", "state_id")


def q_upsert_dim(spark, sf):
    return _dim_after(spark, sf, Lake(spark, "upsert_dim", DIM_ONLY), [1, 2])


def q_upsert_idempotent(spark, sf):
    return _dim_after(spark, sf, Lake(spark, "upsert_idem", DIM_ONLY), [1, 2, 2])


def q_scd2_late_rows(spark, sf):
    return _dim_after(spark, sf, Lake(spark, "late_rows", DIM_ONLY), [2, 1])


def q_scd2_reopen(spark, sf):
    return _dim_after(spark, sf, Lake(spark, "reopen", DIM_ONLY), [1, 2, 1])


def q_replace_partition(spark, sf):
    lake = Lake(spark, "replace", ("orders",))
    table = lake.t("orders")
    replace_partition(spark, table, _orders(spark, sf, 1), P1)
    replace_partition(spark, table, _orders(spark, sf, 1), P2)
    replace_partition(spark, table, _orders(spark, sf, 2), P2)
    return _without_load_time(spark.table(table))


def q_replace_partition_empty(spark, sf):
    lake = Lake(spark, "replace_empty", ("orders",))
    table = lake.t("orders")
    replace_partition(spark, table, _orders(spark, sf, 1), P1)
    replace_partition(spark, table, _orders(spark, sf, 2), P2)
    replace_partition(spark, table, _orders(spark, sf, 2).where(F.lit(False)), P2)
    return _without_load_time(spark.table(table))


def q_fct_orders(spark, sf):
    lake = Lake(spark, "fct", ("dim_customer", "fct_orders"))
    dim = _dim_version(spark, sf, lake, [1, 2])
    fct = lookup_current(_orders(spark, sf, 2), dim.frame, broadcast=_lookup_fits(dim))
    replace_partition(spark, lake.t("fct_orders"), fct, P2)
    return _without_load_time(spark.table(lake.t("fct_orders")))


def q_fct_orders_late(spark, sf):
    dim = _dim_version(spark, sf, Lake(spark, "fct_late", DIM_ONLY), [2, 1])
    return lookup_current(_orders(spark, sf, 2), dim.frame, broadcast=_lookup_fits(dim))


def q_sales_mart(spark, sf):
    dim = _dim_version(spark, sf, Lake(spark, "mart", DIM_ONLY), [1, 2])
    fct = lookup_current(_orders(spark, sf, 2), dim.frame, broadcast=_lookup_fits(dim))
    return sales_mart_op(fct, dim.frame, broadcast=_mart_fits(dim))


def _two_mart_partitions(spark, sf, tag) -> Lake:
    """Mart table with run 1 (batch 1) and run 2 (batch 2) partitions."""
    lake = Lake(spark, tag, ("dim_customer", "sales_mart"), view=True)
    table = lake.t("dim_customer")
    for i, b in enumerate((1, 2)):
        dim = _upsert_batch(spark, sf, table, b, RUN_PARTITIONS[i])
        fct = lookup_current(_orders(spark, sf, b), dim.frame, broadcast=_lookup_fits(dim))
        mart = sales_mart_op(fct, dim.frame, broadcast=_mart_fits(dim))
        replace_partition(spark, lake.t("sales_mart"), mart, RUN_PARTITIONS[i])
    return lake


def q_latest_partition(spark, sf):
    lake = _two_mart_partitions(spark, sf, "latest")
    return _without_load_time(latest_partition(spark, lake.t("sales_mart")))


def q_latest_partition_view(spark, sf):
    lake = _two_mart_partitions(spark, sf, "latest_view")
    return spark.table(f"{lake.bi}.sales_mart")


def _totals(spark, sf, tag, runs) -> tuple[Lake, DataFrame]:
    """The mart over all runs after (batch, partition) runs in turn."""
    lake = Lake(spark, tag, ("dim_customer", "fct_orders", "mart_key_counts", "mart_totals"))
    table = lake.t("dim_customer")
    for batch, partition in runs:
        before = publish.read_version(spark, table)
        changes = _changes(spark, sf, batch, before).withColumn("partition", F.lit(partition))
        changes = materialize(changes, scratch_path(spark, "batches"))
        dim = upsert(spark, table, changes, DIM_KEYS, sort_within=("current",), profile=DIM_PROFILE)
        fct = lookup_current(_orders(spark, sf, batch), dim.frame, broadcast=_lookup_fits(dim))
        facts = replace_partition(spark, lake.t("fct_orders"), fct, partition)
        cells = update_mart(
            spark, lake.path, lake.t("mart_key_counts"), lake.t("mart_totals"), facts, changes, before,
            publish.read_version(spark, table), partition)
    return lake, cells.select("deliver_date", "state_id", "num_orders")


def q_mart_totals(spark, sf):
    """The mart over the facts of two runs, kept by differences."""
    return _totals(spark, sf, "totals", [(1, P1), (2, P2)])[1]


def q_mart_totals_rerun(spark, sf):
    """The same after the second run was made again, and the first one replaced
    by the facts of batch 2."""
    return _totals(spark, sf, "totals_again", [(1, P1), (2, P2), (2, P2), (2, P1)])[1]


def _two_order_partitions(spark, sf, tag) -> str:
    lake = Lake(spark, tag, ("orders",))
    table = lake.t("orders")
    replace_partition(spark, table, _orders(spark, sf, 1), P1)
    replace_partition(spark, table, _orders(spark, sf, 2), P2)
    return table


def q_rows_per_partition(spark, sf):
    table = _two_order_partitions(spark, sf, "rows_per_part")
    return spark.table(table).groupBy("partition").agg(F.count(F.lit(1)).alias("num_rows"))


def q_distinct_partitions(spark, sf):
    table = _two_order_partitions(spark, sf, "distinct_parts")
    return spark.table(table).select("partition").distinct()


def q_check_not_null(spark, sf):
    dim1 = _dim_version(spark, sf, Lake(spark, "check_nn", DIM_ONLY), [1])
    fct = lookup_current(_orders(spark, sf, 2), dim1.frame, broadcast=_lookup_fits(dim1))
    mart = sales_mart_op(fct, dim1.frame, broadcast=_mart_fits(dim1))
    frames = {
        "customer": read_table(spark, sf, "customer"),
        "orders": read_table(spark, sf, "orders"),
        "events": read_table(spark, sf, "events"),
        "sales_mart": mart,
    }
    suites = {
        "customer": (not_null("c_custkey"), not_null("c_nationkey")),
        "orders": (not_null("o_custkey"),),
        "events": (not_null("user_id"),),
        "sales_mart": (not_null("state_id"),),
    }
    return check_datasets(frames, suites)


def q_check_unique(spark, sf):
    dim21 = _dim_version(spark, sf, Lake(spark, "check_unique", DIM_ONLY), [2, 1])
    frames = {
        "orders": read_table(spark, sf, "orders"),
        "events": read_table(spark, sf, "events"),
        "conversations": read_table(spark, sf, "conversations"),
        "documents": read_table(spark, sf, "documents"),
        "fct_orders": lookup_current(_orders(spark, sf, 2), dim21.frame, broadcast=_lookup_fits(dim21)),
    }
    suites = {
        "orders": (unique("o_orderkey"),),
        "events": (unique("event_id"),),
        "conversations": (unique("conv_id"),),
        "documents": (unique("text"),),
        "fct_orders": (unique("order_id"),),
    }
    return check_datasets(frames, suites)


def _unique_runs(spark, sf, tag) -> tuple[Lake, list]:
    """Orders as of the cut, then all orders, then the orders of the cut's year
    only in place of the first run, each staged with its key index and checked
    against the runs before; (lake, the results with their folders)."""
    lake = Lake(spark, tag, ("orders",))
    table = lake.t("orders")
    year = _orders(spark, sf, 2).where(F.year("datetime_order_placed") == 1996)
    out = []
    for frame, partition in ((_orders(spark, sf, 1), P1), (_orders(spark, sf, 2), P2), (year, P1)):
        folder, _, result = stage_unique(spark, table, frame, partition, "order_id")
        publish.publish_partition(spark, table, partition, folder)
        out.append((partition, folder, result))
    return lake, out


def q_check_unique_across_runs(spark, sf):
    """Result rows of the table-wide unique rule, one per run."""
    _, runs = _unique_runs(spark, sf, "unique_runs")
    rows = [(n + 1, p, r["element_count"], r["unexpected_count"], r["success"]) for n, (p, _, r) in enumerate(runs)]
    return spark.createDataFrame(rows, "run int, partition string, element_count long, unexpected_count long, success boolean")


def q_repeated_keys(spark, sf):
    """The keys of the last run that other partitions hold too."""
    lake, runs = _unique_runs(spark, sf, "repeated_keys")
    partition, folder, _ = runs[-1]
    return repeated_keys(spark, lake.t("orders"), "order_id", folder, partition)


def q_check_results(spark, sf):
    lake = Lake(spark, "check_results", ("dim_customer", "dq_results"))
    dim = _dim_version(spark, sf, lake, [1, 2])
    orders = _orders(spark, sf, 2)
    fct = lookup_current(orders, dim.frame, broadcast=_lookup_fits(dim))
    frames = {
        "customer": customer_batch(spark, sf, BATCH_CUTS[2]),
        "orders": orders,
        "dim_customer": dim.frame,
        "fct_orders": fct,
        "sales_mart": sales_mart_op(fct, dim.frame, broadcast=_mart_fits(dim)),
    }
    results = check_datasets(frames, SALES_SUITES).collect()
    append_results(spark, lake.t("dq_results"), results, "check_results")
    return spark.table(lake.t("dq_results")).drop("checked_at")


def q_run_log(spark, sf):
    lake = Lake(spark, "run_log")
    etl = SalesMartETL(spark, lake.path, lake.db, batch_source(sf, BATCH_CUTS[2]))
    etl.run(P1, run_id="run_log_1")
    return spark.table(lake.t("run_metadata")).drop("ts_inserted")


def q_upsert_after_crash(spark, sf):
    """The dimension after writers of batch 2 died between commit and the
    catalog calls, twice, and the batch was run again."""
    lake = Lake(spark, "after_crash", DIM_ONLY)
    table = lake.t("dim_customer")
    _upsert_batch(spark, sf, table, 1, P1)
    for _ in range(2):
        changes = _changes(spark, sf, 2, published(spark, table)).withColumn("partition", F.lit(P2))
        publish.commit(spark, publish.upsert_change(spark, table, publish.stage_upsert(spark, table, changes, DIM_KEYS)))
    _upsert_batch(spark, sf, table, 2, P2)
    return published(spark, table)


def q_read_version(spark, sf):
    """The dimension read while a publish of batch 2 is committed and none of
    its catalog calls is made: the catalog shows the version before."""
    lake = Lake(spark, "read_version", DIM_ONLY)
    table = lake.t("dim_customer")
    _upsert_batch(spark, sf, table, 1, P1)
    changes = _changes(spark, sf, 2, published(spark, table)).withColumn("partition", F.lit(P2))
    publish.commit(spark, publish.upsert_change(spark, table, publish.stage_upsert(spark, table, changes, DIM_KEYS)))
    return publish.read_version(spark, table)


def q_upsert_conflict(spark, sf):
    """The dimension after two writers staged batch 2 from the same version:
    the second is refused and changes nothing."""
    lake = Lake(spark, "conflict", DIM_ONLY)
    table = lake.t("dim_customer")
    _upsert_batch(spark, sf, table, 1, P1)
    staged = [
        publish.stage_upsert(
            spark, table, _changes(spark, sf, 2, spark.table(table)).withColumn("partition", F.lit(p)), DIM_KEYS)
        for p in (P2, P3)
    ]
    publish.publish_upsert(spark, table, staged[0])
    try:
        publish.publish_upsert(spark, table, staged[1])
    except publish.ConflictError:
        return published(spark, table)
    raise RuntimeError("the second writer was not refused")


def _version_rows(spark, sf, batch):
    """Every order of a batch as a version of its customer, valid from the day
    of the order, with its status and priority as attributes."""
    rows = _orders(spark, sf, batch).groupBy(
        F.col("customer_id").alias("id"), F.col("datetime_order_placed").alias("datetime_updated")
    ).agg(F.max("item_id").alias("first_name"), F.max("item_name").alias("last_name"), F.count(F.lit(1)).alias("_n"))
    return with_surrogate_key(rows.select(
        "id", "first_name", "last_name", F.col("_n").cast("string").alias("state_id"),
        F.col("datetime_updated").alias("datetime_created"), "datetime_updated"))


def _history(spark, sf, tag, rows, late_rows):
    """The dimension after the given batches of versions."""
    lake = Lake(spark, tag, DIM_ONLY)
    table = lake.t("dim_customer")
    for frame, partition in zip(rows, RUN_PARTITIONS):
        observed, profile = observe_profile(frame)
        source = materialize(observed, scratch_path(spark, "batches"))
        changes = scd2_versions(source, spark.table(table), late_rows=late_rows, broadcast_ids=profile().fits(source, ["id"]))
        upsert(spark, table, changes.withColumn("partition", F.lit(partition)), DIM_KEYS, sort_within=("current",))
    return published(spark, table)


def q_scd2_late_splice(spark, sf):
    """Batch 2, then batch 1, whose older versions go where they belong."""
    return _history(spark, sf, "late_splice", [_source(spark, sf, 2), _source(spark, sf, 1)], "splice")


def q_scd2_late_drop(spark, sf):
    """Batch 2, then batch 1, whose older versions are left out."""
    return _history(spark, sf, "late_drop", [_source(spark, sf, 2), _source(spark, sf, 1)], "drop")


def q_scd2_version_chain(spark, sf):
    """All orders as customer versions in one batch, each closing the one before."""
    return _history(spark, sf, "chain", [_version_rows(spark, sf, 2)], "drop")


def q_scd2_chain_resumed(spark, sf):
    """The recent half of the versions, then all of them: the older half is spliced in."""
    recent = _version_rows(spark, sf, 2).where(F.col("datetime_updated") >= F.lit(BATCH_CUTS[1]).cast("timestamp_ntz"))
    return _history(spark, sf, "chain2", [recent, _version_rows(spark, sf, 2)], "splice")


def _counts(spark, lake, names=("customer", "orders", "dim_customer", "fct_orders", "sales_mart")) -> DataFrame:
    """(table_name, partition, num_rows) of the named tables."""
    frames = [
        spark.table(lake.t(name)).groupBy("partition").agg(F.count(F.lit(1)).alias("num_rows"))
        .select(F.lit(name).alias("table_name"), "partition", "num_rows")
        for name in names
    ]
    return reduce(DataFrame.unionByName, frames)


def q_ddl_rerun(spark, sf):
    lake = _two_runs(spark, sf, "ddl_rerun")
    create_all(spark, lake.path, lake.db, lake.bi)
    return _counts(spark, lake)


def q_ddl_drop_recreate(spark, sf):
    lake = _two_runs(spark, sf, "drop_recreate")
    drop_all(spark, lake.db, lake.bi)
    create_all(spark, lake.path, lake.db, lake.bi)
    return _counts(spark, lake)


def q_publish_datasets(spark, sf):
    """Orders of both batches and the dimension, published without checks."""
    lake = Lake(spark, "publish", ("orders", "dim_customer"))
    dim = _changes(spark, sf, 2, spark.table(lake.t("dim_customer")))
    for batch, partition in ((1, P1), (2, P2)):
        publish_datasets(spark, {
            "orders": Dataset("orders", _orders(spark, sf, batch), lake.t("orders")),
            "dim_customer": Dataset("dim_customer", dim, lake.t("dim_customer"), Publish.UPSERT, DIM_KEYS),
            "aside": Dataset("aside", dim, lake.t("missing"), Publish.SKIP),
        }, partition)
    return _counts(spark, lake, ("orders", "dim_customer"))


def q_gate_blocks_publish(spark, sf):
    """A run whose orders are line items, so that their keys repeat: the gate
    stops it. Rows of every table, and the results it left."""
    def source(session):
        lines = read_table(session, sf, "lineitem").select(
            F.col("l_orderkey").cast("string").alias("order_id"), F.col("l_partkey").cast("bigint").alias("customer_id"),
            F.col("l_returnflag").alias("item_id"), F.col("l_linestatus").alias("item_name"),
            F.col("l_shipdate").cast("timestamp_ntz").alias("delivered_on"),
            F.col("l_shipdate").cast("timestamp_ntz").alias("datetime_order_placed"))
        return customer_batch(session, sf, BATCH_CUTS[2]), lines

    lake = Lake(spark, "gate")
    try:
        SalesMartETL(spark, lake.path, lake.db, source).run(P1, run_id="gate_1")
        raise RuntimeError("the gate was to stop the run")
    except InvalidDataError:
        pass
    counts = [
        spark.table(lake.t(name)).agg(F.count(F.lit(1)).alias("num_rows")).select(
            F.lit(f"rows of {name}").alias("what"), "num_rows", F.lit(0).cast("long").alias("unexpected_count"))
        for name in ("customer", "orders", "dim_customer", "fct_orders", "sales_mart")
    ]
    results = spark.table(lake.t("dq_results")).select(
        F.concat(F.lit("check of "), "dataset", F.lit(" "), "column").alias("what"),
        F.col("element_count").alias("num_rows"), "unexpected_count")
    return reduce(DataFrame.unionByName, [*counts, results])


def q_log_tail(spark, sf):
    """The last five rows of the log of a run, newest first."""
    lake = Lake(spark, "log_tail")
    SalesMartETL(spark, lake.path, lake.db, batch_source(sf, BATCH_CUTS[2])).run(P1, run_id="run_log_1")
    return read_log(spark, lake.t("run_metadata"), 5).drop("ts_inserted")


def _two_runs(spark, sf, tag) -> Lake:
    lake = Lake(spark, tag)
    for i, b in enumerate((1, 2)):
        etl = SalesMartETL(spark, lake.path, lake.db, batch_source(sf, BATCH_CUTS[b]))
        etl.run(RUN_PARTITIONS[i], run_id=f"{tag}_{i + 1}")
    return lake


def q_two_run_view(spark, sf):
    lake = _two_runs(spark, sf, "two_run_view")
    return spark.table(f"{lake.bi}.sales_mart")


def q_two_run_counts(spark, sf):
    return _counts(spark, _two_runs(spark, sf, "two_run_counts"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "bronze_customer": q_bronze_customer,
    "bronze_orders": q_bronze_orders,
    "surrogate_key": q_surrogate_key,
    "scd2_net_new": q_scd2_net_new,
    "scd2_new_versions": q_scd2_new_versions,
    "scd2_closures": q_scd2_closures,
    "scd2_batch": q_scd2_batch,
    "dim_current": q_dim_current,
    "upsert_dim": q_upsert_dim,
    "upsert_idempotent": q_upsert_idempotent,
    "scd2_late_rows": q_scd2_late_rows,
    "scd2_reopen": q_scd2_reopen,
    "replace_partition": q_replace_partition,
    "replace_partition_empty": q_replace_partition_empty,
    "fct_orders": q_fct_orders,
    "fct_orders_late": q_fct_orders_late,
    "sales_mart": q_sales_mart,
    "mart_totals": q_mart_totals,
    "mart_totals_rerun": q_mart_totals_rerun,
    "latest_partition": q_latest_partition,
    "latest_partition_view": q_latest_partition_view,
    "rows_per_partition": q_rows_per_partition,
    "distinct_partitions": q_distinct_partitions,
    "check_not_null": q_check_not_null,
    "check_unique": q_check_unique,
    "check_unique_across_runs": q_check_unique_across_runs,
    "repeated_keys": q_repeated_keys,
    "check_results": q_check_results,
    "run_log": q_run_log,
    "log_tail": q_log_tail,
    "upsert_after_crash": q_upsert_after_crash,
    "upsert_conflict": q_upsert_conflict,
    "read_version": q_read_version,
    "scd2_late_splice": q_scd2_late_splice,
    "scd2_late_drop": q_scd2_late_drop,
    "scd2_version_chain": q_scd2_version_chain,
    "scd2_chain_resumed": q_scd2_chain_resumed,
    "ddl_rerun": q_ddl_rerun,
    "ddl_drop_recreate": q_ddl_drop_recreate,
    "publish_datasets": q_publish_datasets,
    "gate_blocks_publish": q_gate_blocks_publish,
    "two_run_view": q_two_run_view,
    "two_run_counts": q_two_run_counts,
}


# ------------------------------------------------------------- oracle SQL
# DuckDB SQL over the same parquet tables, written from the semantics (not
# from the Spark code): anti / inner joins for the SCD2 parts, NOT EXISTS for
# the upsert, one CTE per published table state.


def _cut(cut):
    return f"WHERE o_orderdate < TIMESTAMP '{cut}'" if cut else ""


def _customer_batch_sql(batch: int) -> str:
    return f"""SELECT c.c_custkey AS id, split_part(c.c_name, '#', 1) AS first_name,
    split_part(c.c_name, '#', 2) AS last_name, n.n_name AS state_id,
    coalesce(o.datetime_created, TIMESTAMP '{NO_ORDERS}') AS datetime_created,
    coalesce(o.datetime_updated, TIMESTAMP '{NO_ORDERS}') AS datetime_updated
  FROM customer c
  LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS datetime_created, max(o_orderdate) AS datetime_updated
        FROM orders {_cut(BATCH_CUTS[batch])} GROUP BY o_custkey) o ON c.c_custkey = o.o_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey"""


def _orders_batch_sql(batch: int) -> str:
    return f"""SELECT CAST(o_orderkey AS VARCHAR) AS order_id, o_custkey AS customer_id,
    o_orderstatus AS item_id, o_orderpriority AS item_name,
    o_orderdate AS delivered_on, o_orderdate AS datetime_order_placed
  FROM orders {_cut(BATCH_CUTS[batch])}"""


_OPEN = (
    "s.id, s.customer_sur_id, s.first_name, s.last_name, s.state_id, s.datetime_created, "
    f"s.datetime_updated, TRUE AS current, s.datetime_updated AS valid_from, "
    f"TIMESTAMP '{OPEN_END}' AS valid_to"
)
_CLOSE = (
    "d.id, d.customer_sur_id, d.first_name, d.last_name, d.state_id, d.datetime_created, "
    "s.datetime_updated AS datetime_updated, FALSE AS current, d.valid_from, "
    "s.datetime_updated AS valid_to"
)
_MATCH = "d.id = s.id AND d.datetime_updated < s.datetime_updated"
_EMPTY_DIM = (
    "SELECT CAST(NULL AS BIGINT) AS id, CAST(NULL AS VARCHAR) AS customer_sur_id, "
    "CAST(NULL AS VARCHAR) AS first_name, CAST(NULL AS VARCHAR) AS last_name, "
    "CAST(NULL AS VARCHAR) AS state_id, CAST(NULL AS TIMESTAMP) AS datetime_created, "
    "CAST(NULL AS TIMESTAMP) AS datetime_updated, CAST(NULL AS BOOLEAN) AS current, "
    "CAST(NULL AS TIMESTAMP) AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, "
    "CAST(NULL AS VARCHAR) AS partition WHERE FALSE"
)


def _net_new_sql(src: str, dim: str) -> str:
    return (
        f"SELECT {_OPEN} FROM {src} s WHERE NOT EXISTS "
        f"(SELECT 1 FROM {dim} d WHERE d.current AND {_MATCH})"
    )


def _new_versions_sql(src: str, dim: str) -> str:
    return f"SELECT {_OPEN} FROM {src} s JOIN (SELECT * FROM {dim} WHERE current) d ON {_MATCH}"


def _closures_sql(src: str, dim: str) -> str:
    return f"SELECT {_CLOSE} FROM (SELECT * FROM {dim} WHERE current) d JOIN {src} s ON {_MATCH}"


def _changes_sql(src: str, dim: str) -> str:
    return " UNION ALL ".join(
        f"({q})" for q in (_net_new_sql(src, dim), _new_versions_sql(src, dim), _closures_sql(src, dim))
    )


def _upsert_sql(target: str, batch: str, partition: str) -> str:
    return (
        f"SELECT b.*, '{partition}' AS partition FROM {batch} b UNION ALL "
        f"SELECT t.* FROM {target} t WHERE NOT EXISTS "
        f"(SELECT 1 FROM {batch} b WHERE b.customer_sur_id = t.customer_sur_id)"
    )


def _source_ctes(batches: Sequence[int]) -> list[str]:
    ctes = []
    for b in sorted(set(batches)):
        ctes.append(f"b{b} AS ({_customer_batch_sql(b)})")
        ctes.append(f"s{b} AS (SELECT *, md5(CAST(id AS VARCHAR) || CAST(datetime_updated AS VARCHAR)) AS customer_sur_id FROM b{b})")
        ctes.append(f"ob{b} AS ({_orders_batch_sql(b)})")
    return ctes


def _dim_ctes(batches: Sequence[int], name: str, partitions: Sequence[str] = RUN_PARTITIONS) -> list[str]:
    """CTEs ending in ``name``: the dim after upserting each batch's changes."""
    ctes = [f"{name}_0 AS ({_EMPTY_DIM})"]
    for i, b in enumerate(batches):
        prev, cur = f"{name}_{i}", f"{name}_{i + 1}"
        ctes.append(f"{name}_ch{i + 1} AS ({_changes_sql(f's{b}', prev)})")
        ctes.append(f"{cur} AS ({_upsert_sql(prev, f'{name}_ch{i + 1}', partitions[i])})")
    ctes.append(f"{name} AS (SELECT * FROM {name}_{len(batches)})")
    return ctes


def _with(ctes: Sequence[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


_VERSION_COLUMNS = "id, customer_sur_id, first_name, last_name, state_id, datetime_created"


def _version_rows_sql(orders: str) -> str:
    return (
        "SELECT *, md5(CAST(id AS VARCHAR) || CAST(datetime_updated AS VARCHAR)) AS customer_sur_id FROM ("
        "SELECT customer_id AS id, max(item_id) AS first_name, max(item_name) AS last_name, "
        "CAST(count(*) AS VARCHAR) AS state_id, datetime_order_placed AS datetime_created, "
        f"datetime_order_placed AS datetime_updated FROM {orders} GROUP BY customer_id, datetime_order_placed)"
    )


def _history_sql(versions: str) -> str:
    """The dimension over (``_VERSION_COLUMNS``, since): each version valid until the next."""
    return (
        f"SELECT {_VERSION_COLUMNS}, coalesce(lead(since) OVER w, since) AS datetime_updated, lead(since) OVER w IS NULL AS current, "
        f"since AS valid_from, coalesce(lead(since) OVER w, TIMESTAMP '{OPEN_END}') AS valid_to "
        f"FROM {versions} WINDOW w AS (PARTITION BY id ORDER BY since)"
    )


def _stamped_sql(before: str, after: str) -> str:
    """Rows of ``after`` with the run that last wrote them: the first if ``before`` has them."""
    return (
        f"SELECT a.*, CASE WHEN b.id IS NULL THEN '{P2}' ELSE '{P1}' END AS partition FROM {after} a "
        f"LEFT JOIN {before} b ON a.id = b.id AND a.customer_sur_id = b.customer_sur_id AND a.valid_to = b.valid_to"
    )


def _fct_sql(orders: str, dim: str) -> str:
    return (
        f"SELECT o.*, d.customer_sur_id FROM {orders} o "
        f"LEFT JOIN (SELECT * FROM {dim} WHERE current) d ON o.customer_id = d.id"
    )


def _mart_sql(fct: str, dim: str) -> str:
    return (
        f"SELECT CAST(f.delivered_on AS DATE) AS deliver_date, d.state_id, count(*) AS num_orders "
        f"FROM {fct} f LEFT JOIN (SELECT * FROM {dim} WHERE current) d "
        f"ON f.customer_sur_id = d.customer_sur_id GROUP BY 1, 2"
    )


def _check_nn_sql(dataset: str, table: str, column: str) -> str:
    return (
        f"SELECT '{dataset}' AS dataset, 'expect_column_values_to_not_be_null' AS rule, "
        f"'{column}' AS \"column\", count(*) AS element_count, "
        f"count(*) FILTER (WHERE {column} IS NULL) AS unexpected_count, "
        f"count(*) FILTER (WHERE {column} IS NULL) = 0 AS success FROM {table}"
    )


def _check_unique_sql(dataset: str, table: str, column: str) -> str:
    bad = "CAST(coalesce(sum(CASE WHEN v IS NOT NULL AND c > 1 THEN c END), 0) AS BIGINT)"
    return (
        f"SELECT '{dataset}' AS dataset, 'expect_column_values_to_be_unique' AS rule, "
        f"'{column}' AS \"column\", CAST(coalesce(sum(c), 0) AS BIGINT) AS element_count, "
        f"{bad} AS unexpected_count, {bad} = 0 AS success "
        f"FROM (SELECT {column} AS v, count(*) AS c FROM {table} GROUP BY 1) g"
    )


def _union(parts: Sequence[str]) -> str:
    return "\nUNION ALL\n".join(f"({p})" for p in parts)


def _run_log_sql(run_id: str, partition: str) -> str:
    """The log of one run over the given tables: (n, run_params) in order."""
    steps = [
        ("run", None, None, "started"), ("bronze", None, None, None),
        ("validate", '[["customer", "orders"]]', None, None),
        ("staged", None, "customer", "b2"), ("staged", None, "orders", "ob2"),
        ("silver", '[["customer", "orders"]]', None, None), ("dim_customer", '["customer"]', None, None),
        ("fct_orders", '[["customer", "dim_customer", "orders"]]', None, None),
        ("validate", '[["dim_customer", "fct_orders"]]', None, None),
        ("staged", None, "dim_customer", "d2"), ("staged", None, "fct_orders", "f"),
        ("gold", '[["dim_customer", "fct_orders"]]', None, None), ("sales_mart", '[["dim_customer", "fct_orders"]]', None, None),
        ("validate", '[["sales_mart"]]', None, None), ("staged", None, "sales_mart", "m"),
        ("run", None, None, "succeeded"),
    ]
    rows = []
    for n, (function, args, dataset, extra) in enumerate(steps):
        if dataset:
            text = (f"""'{{"dataset": "{dataset}", "function": "staged", "partition": "{partition}", "rows": ' || """
                    f"""(SELECT count(*) FROM {extra}) || '}}'""")
        else:
            parts = ([f'"args": {args}'] if args else []) + [f'"function": "{function}"', f'"partition": "{partition}"']
            text = "'{" + ", ".join(parts + ([f'"status": "{extra}"'] if extra else [])) + "}'"
        rows.append(f"SELECT {n} AS n, '{run_id}' AS run_id, 'sales_mart' AS pipeline_id, {text} AS run_params")
    return "\nUNION ALL\n".join(rows)


def _oracle() -> dict[str, str]:
    src12 = _source_ctes([1, 2])
    o: dict[str, str] = {}
    o["bronze_customer"] = _customer_batch_sql(2)
    o["bronze_orders"] = _orders_batch_sql(2)
    o["surrogate_key"] = _with(src12, "SELECT id, datetime_updated, customer_sur_id FROM s2")
    d1 = src12 + _dim_ctes([1], "d1")
    o["scd2_net_new"] = _with(d1, _net_new_sql("s2", "d1"))
    o["scd2_new_versions"] = _with(d1, _new_versions_sql("s2", "d1"))
    o["scd2_closures"] = _with(d1, _closures_sql("s2", "d1"))
    o["scd2_batch"] = _with(d1, _changes_sql("s2", "d1"))
    d12 = src12 + _dim_ctes([1, 2], "d12")
    o["dim_current"] = _with(d12, "SELECT customer_sur_id, state_id FROM d12 WHERE current")
    o["upsert_dim"] = _with(d12, "SELECT * FROM d12")
    o["upsert_idempotent"] = _with(src12 + _dim_ctes([1, 2, 2], "d122"), "SELECT * FROM d122")
    d21 = src12 + _dim_ctes([2, 1], "d21")
    o["scd2_late_rows"] = _with(d21, "SELECT * FROM d21")
    o["scd2_reopen"] = _with(src12 + _dim_ctes([1, 2, 1], "d121"), "SELECT * FROM d121")
    o["replace_partition"] = _with(
        src12, f"SELECT *, '{P1}' AS partition FROM ob1 UNION ALL SELECT *, '{P2}' AS partition FROM ob2"
    )
    o["replace_partition_empty"] = _with(src12, f"SELECT *, '{P1}' AS partition FROM ob1")
    o["fct_orders"] = _with(d12, f"SELECT f.*, '{P2}' AS partition FROM ({_fct_sql('ob2', 'd12')}) f")
    o["fct_orders_late"] = _with(d21, _fct_sql("ob2", "d21"))
    o["sales_mart"] = _with(d12 + [f"f AS ({_fct_sql('ob2', 'd12')})"], _mart_sql("f", "d12"))
    o["mart_totals"] = _with(
        src12 + _dim_ctes([1], "d1") + _dim_ctes([1, 2], "d12")
        + [f"f AS ({_fct_sql('ob1', 'd1')} UNION ALL {_fct_sql('ob2', 'd12')})"], _mart_sql("f", "d12"))
    o["mart_totals_rerun"] = _with(
        src12 + _dim_ctes([1, 2, 2, 2], "d", (P1, P2, P2, P1))
        + [f"f AS ({_fct_sql('ob2', 'd')} UNION ALL {_fct_sql('ob2', 'd')})"], _mart_sql("f", "d"))
    two = src12 + _dim_ctes([1], "d1") + _dim_ctes([1, 2], "d12") + [
        f"f1 AS ({_fct_sql('ob1', 'd1')})",
        f"f2 AS ({_fct_sql('ob2', 'd12')})",
        f"m1 AS ({_mart_sql('f1', 'd1')})",
        f"m2 AS ({_mart_sql('f2', 'd12')})",
    ]
    o["latest_partition"] = _with(two, f"SELECT *, '{P2}' AS partition FROM m2")
    o["latest_partition_view"] = _with(
        two, "SELECT state_id, deliver_date AS delivery_date, num_orders FROM m2"
    )
    o["rows_per_partition"] = _with(
        src12,
        f"SELECT '{P1}' AS partition, count(*) AS num_rows FROM ob1 "
        f"UNION ALL SELECT '{P2}' AS partition, count(*) AS num_rows FROM ob2",
    )
    o["distinct_partitions"] = _with(
        src12,
        f"SELECT DISTINCT partition FROM (SELECT '{P1}' AS partition FROM ob1 "
        f"UNION ALL SELECT '{P2}' AS partition FROM ob2)",
    )
    o["check_not_null"] = _with(
        d1 + [f"f AS ({_fct_sql('ob2', 'd1')})", f"m AS ({_mart_sql('f', 'd1')})"],
        _union([
            _check_nn_sql("customer", "customer", "c_custkey"),
            _check_nn_sql("customer", "customer", "c_nationkey"),
            _check_nn_sql("orders", "orders", "o_custkey"),
            _check_nn_sql("events", "events", "user_id"),
            _check_nn_sql("sales_mart", "m", "state_id"),
        ]),
    )
    o["check_unique"] = _with(
        d21 + [f"f AS ({_fct_sql('ob2', 'd21')})"],
        _union([
            _check_unique_sql("orders", "orders", "o_orderkey"),
            _check_unique_sql("events", "events", "event_id"),
            _check_unique_sql("conversations", "conversations", "conv_id"),
            _check_unique_sql("documents", "documents", "text"),
            _check_unique_sql("fct_orders", "f", "order_id"),
        ]),
    )
    year = "SELECT * FROM ob2 WHERE year(datetime_order_placed) = 1996"
    runs = [(1, P1, "ob1", "SELECT NULL AS order_id WHERE FALSE"), (2, P2, "ob2", "SELECT order_id FROM ob1"), (3, P1, f"({year})", "SELECT order_id FROM ob2")]
    o["check_unique_across_runs"] = _with(src12, _union([
        f"SELECT {n} AS run, '{p}' AS partition, count(*) AS element_count, "
        "count(*) FILTER (WHERE c > 1 OR again) AS unexpected_count, count(*) FILTER (WHERE c > 1 OR again) = 0 AS success "
        f"FROM (SELECT order_id, count(*) OVER (PARTITION BY order_id) AS c, order_id IN ({others}) AS again FROM {now}) r"
        for n, p, now, others in runs
    ]))
    o["repeated_keys"] = _with(
        src12, f"SELECT a.order_id AS key, count(DISTINCT a.o) AS n, '{P2}' AS partition, count(DISTINCT b.o) AS n_there "
        f"FROM (SELECT order_id, row_number() OVER () AS o FROM ({year})) a JOIN (SELECT order_id, row_number() OVER () AS o FROM ob2) b "
        "ON a.order_id = b.order_id GROUP BY a.order_id")
    o["check_results"] = _with(
        d12 + [f"f AS ({_fct_sql('ob2', 'd12')})", f"m AS ({_mart_sql('f', 'd12')})"],
        "SELECT 'check_results' AS run_id, * FROM (" + _union([
            _check_nn_sql("customer", "b2", "id"),
            _check_unique_sql("orders", "ob2", "order_id"),
            _check_nn_sql("dim_customer", "d12", "id"),
            _check_unique_sql("fct_orders", "f", "order_id"),
            _check_nn_sql("sales_mart", "m", "state_id"),
        ]) + ")",
    )
    one = src12 + _dim_ctes([2], "d2") + [f"f AS ({_fct_sql('ob2', 'd2')})", f"m AS ({_mart_sql('f', 'd2')})",
                                          f"log AS ({_run_log_sql('run_log_1', P1)})"]
    o["run_log"] = _with(one, "SELECT run_id, pipeline_id, run_params FROM log")
    o["log_tail"] = _with(one, "SELECT run_id, pipeline_id, run_params FROM log ORDER BY n DESC LIMIT 5")
    o["upsert_after_crash"] = _with(src12 + _dim_ctes([1, 2, 2, 2], "dx", (P1, P2, P2, P2)), "SELECT * FROM dx")
    o["upsert_conflict"] = o["read_version"] = o["upsert_dim"]
    of = f"SELECT {_VERSION_COLUMNS}, datetime_updated AS since FROM"
    o["scd2_late_splice"] = _with(
        src12 + [f"v2 AS ({of} s2)", f"v12 AS ({of} s2 UNION {of} s1 WHERE NOT EXISTS (SELECT 1 FROM s2 "
                 "WHERE s2.customer_sur_id = s1.customer_sur_id))",
                 f"h1 AS ({_history_sql('v2')})", f"h2 AS ({_history_sql('v12')})"],
        _stamped_sql("h1", "h2"),
    )
    o["scd2_late_drop"] = _with(src12 + [f"v2 AS ({of} s2)"], f"SELECT *, '{P1}' AS partition FROM ({_history_sql('v2')})")
    chain = src12 + [f"r AS ({_version_rows_sql('ob2')})", f"v AS ({of} r)"]
    o["scd2_version_chain"] = _with(chain, f"SELECT *, '{P1}' AS partition FROM ({_history_sql('v')})")
    o["scd2_chain_resumed"] = _with(
        chain + [f"late AS (SELECT * FROM v WHERE since >= TIMESTAMP '{BATCH_CUTS[1]}')",
                 f"h1 AS ({_history_sql('late')})", f"h2 AS ({_history_sql('v')})"],
        _stamped_sql("h1", "h2"),
    )
    o["two_run_view"] = o["latest_partition_view"]
    o["two_run_counts"] = _with(
        two,
        _union([
            f"SELECT 'customer' AS table_name, '{P1}' AS partition, count(*) AS num_rows FROM b1",
            f"SELECT 'customer', '{P2}', count(*) FROM b2",
            f"SELECT 'orders', '{P1}', count(*) FROM ob1",
            f"SELECT 'orders', '{P2}', count(*) FROM ob2",
            "SELECT 'dim_customer', partition, count(*) FROM d12 GROUP BY partition",
            f"SELECT 'fct_orders', '{P1}', count(*) FROM f1",
            f"SELECT 'fct_orders', '{P2}', count(*) FROM f2",
            f"SELECT 'sales_mart', '{P1}', count(*) FROM m1",
            f"SELECT 'sales_mart', '{P2}', count(*) FROM m2",
        ]),
    )
    o["ddl_rerun"] = o["ddl_drop_recreate"] = o["two_run_counts"]
    o["publish_datasets"] = _with(
        src12 + [f"ch AS ({_changes_sql('s2', '(' + _EMPTY_DIM + ')')})", f"e AS ({_EMPTY_DIM})",
                 f"p1 AS ({_upsert_sql('e', 'ch', P1)})", f"p2 AS ({_upsert_sql('p1', 'ch', P2)})"],
        f"SELECT 'orders' AS table_name, '{P1}' AS partition, count(*) AS num_rows FROM ob1 "
        f"UNION ALL SELECT 'orders', '{P2}', count(*) FROM ob2 "
        "UNION ALL SELECT 'dim_customer', partition, count(*) FROM p2 GROUP BY partition",
    )
    o["gate_blocks_publish"] = _union([
        *[f"SELECT 'rows of {t}' AS what, 0 AS num_rows, 0 AS unexpected_count"
          for t in ("customer", "orders", "dim_customer", "fct_orders", "sales_mart")],
        "SELECT 'check of customer id', count(*), count(*) FILTER (c_custkey IS NULL) FROM customer",
        "SELECT 'check of orders order_id', CAST(sum(n) AS BIGINT), CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) "
        "FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey)",
    ])
    return o


ORACLE_SQL: dict[str, str] = _oracle()
