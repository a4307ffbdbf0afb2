"""The sales ETL end to end over the sf0.001 fixture batches."""

import pytest
from pyspark.sql import functions as F

from medallion.operators.checks import InvalidDataError
from medallion.plans.etl import check_required_inputs
from medallion.plans.sales import SalesMartETL
from medallion.sources.testdata import BATCH_CUTS, NO_ORDERS, customer_batch, orders_batch, batch_source
from tests.conftest import SF_SMALL

P1, P2 = "2024-01-01-00-00-00", "2024-01-02-00-00-00"


def _etl(spark, lake, source):
    return SalesMartETL(spark, lake.path, lake.db, source)


def _counts(spark, lake, table):
    return {r["partition"]: r["n"] for r in spark.sql(
        f"SELECT partition, count(*) AS n FROM {lake.db}.{table} GROUP BY 1").collect()}


def test_two_runs(spark, lake):
    _etl(spark, lake, batch_source(SF_SMALL, BATCH_CUTS[1])).run(P1, "r1")
    _etl(spark, lake, batch_source(SF_SMALL, BATCH_CUTS[2])).run(P2, "r2")
    n_b1 = customer_batch(spark, SF_SMALL, BATCH_CUTS[1]).count()
    n_b2 = customer_batch(spark, SF_SMALL, BATCH_CUTS[2]).count()
    assert _counts(spark, lake, "customer") == {P1: n_b1, P2: n_b2}
    assert _counts(spark, lake, "orders") == {
        P1: orders_batch(spark, SF_SMALL, BATCH_CUTS[1]).count(),
        P2: orders_batch(spark, SF_SMALL, BATCH_CUTS[2]).count(),
    }
    assert _counts(spark, lake, "fct_orders") == _counts(spark, lake, "orders")
    dim = spark.table(f"{lake.db}.dim_customer")
    assert dim.where("current").count() == n_b2
    # one open row per id; every id of batch 1 was changed by batch 2 here
    assert dim.where("current").select("id").distinct().count() == n_b2
    assert set(_counts(spark, lake, "sales_mart")) == {P1, P2}
    view = spark.table(f"{lake.bi}.sales_mart") if spark.catalog.databaseExists(lake.bi) else None
    assert view is not None and view.columns == ["state_id", "delivery_date", "num_orders"]
    assert view.agg(F.sum("num_orders")).first()[0] == _counts(spark, lake, "orders")[P2]
    log = spark.table(f"{lake.db}.run_metadata")
    assert log.where("run_id = 'r1'").count() == 16 and log.where("run_id IS NULL").count() == 0
    results = spark.table(f"{lake.db}.dq_results")
    assert results.count() == 10 and results.where("NOT success").count() == 0


def test_rerun_same_partition_is_idempotent(spark, lake):
    etl = _etl(spark, lake, batch_source(SF_SMALL, BATCH_CUTS[2]))
    etl.run(P1, "a")
    first = {t: sorted(map(tuple, spark.table(f"{lake.db}.{t}").drop("etl_inserted").collect()), key=repr)
             for t in ("customer", "orders", "dim_customer", "fct_orders", "sales_mart")}
    etl.run(P1, "b")
    again = {t: sorted(map(tuple, spark.table(f"{lake.db}.{t}").drop("etl_inserted").collect()), key=repr)
             for t in first}
    assert first == again


def test_failed_check_publishes_nothing(spark, lake):
    def bad_source(s):
        customer = customer_batch(s, SF_SMALL, BATCH_CUTS[1])
        orders = orders_batch(s, SF_SMALL, BATCH_CUTS[1])
        return customer, orders.unionByName(orders.limit(1))  # a repeated order_id

    with pytest.raises(InvalidDataError, match="orders"):
        _etl(spark, lake, bad_source).run(P1, "bad")
    for t in ("customer", "orders", "dim_customer", "fct_orders", "sales_mart"):
        assert spark.table(f"{lake.db}.{t}").count() == 0
    log = spark.table(f"{lake.db}.run_metadata").where("run_id = 'bad'")
    assert log.where("run_params LIKE '%\"status\": \"failed\"%'").count() == 1
    failed = spark.table(f"{lake.db}.dq_results").where("NOT success").collect()
    assert [(r["dataset"], r["column"]) for r in failed] == [("orders", "order_id")]


def test_gold_check_fails_on_null_state(spark, lake):
    # orders of customers missing from the batch have no current dim row:
    # their mart group has a NULL state and the gold check stops the run
    known = lambda s: customer_batch(s, SF_SMALL, BATCH_CUTS[1]).where(F.col("datetime_updated") > NO_ORDERS)
    source = lambda s: (known(s), orders_batch(s, SF_SMALL, BATCH_CUTS[2]))
    with pytest.raises(InvalidDataError, match="sales_mart"):
        _etl(spark, lake, source).run(P1, "g")
    assert spark.table(f"{lake.db}.sales_mart").count() == 0
    # silver was published before gold ran
    assert spark.table(f"{lake.db}.fct_orders").count() > 0


def test_partition_required(spark, lake):
    with pytest.raises(ValueError):
        _etl(spark, lake, batch_source(SF_SMALL)).run(None)


def test_required_inputs():
    with pytest.raises(ValueError):
        check_required_inputs({"customer": None}, ["customer", "orders"])
    check_required_inputs({"customer": None, "orders": None}, ["customer", "orders"])


def test_unpartitioned_dimension_gives_same_tables(spark, lake):
    """A dimension created without partitions (as in the original DDL) takes
    the whole-version upsert path; the published tables are the same."""
    from medallion.model import DIM_CUSTOMER_COLUMNS, PARTITION
    from medallion.operators.publish import published
    from medallion.plans.ddl import create_table
    from medallion.plans.queries import Lake

    other = Lake(spark, "unpart")
    spark.sql(f"DROP TABLE {other.db}.dim_customer")
    create_table(spark, other.db, "dim_customer", DIM_CUSTOMER_COLUMNS + (PARTITION,), False, other.path + "/flat")
    for target in (lake, other):
        _etl(spark, target, batch_source(SF_SMALL, BATCH_CUTS[1])).run(P1, "u1")
        _etl(spark, target, batch_source(SF_SMALL, BATCH_CUTS[2])).run(P2, "u2")
    for t in ("dim_customer", "fct_orders", "sales_mart"):
        a = sorted(map(tuple, published(spark, f"{lake.db}.{t}").drop("etl_inserted").collect()), key=repr)
        b = sorted(map(tuple, published(spark, f"{other.db}.{t}").drop("etl_inserted").collect()), key=repr)
        assert a == b, t
    results = spark.table(f"{other.db}.dq_results").where("dataset = 'dim_customer'").collect()
    assert all(r["success"] for r in results) and len(results) == 2
