"""The layered template on its own: any layers, check-only datasets."""

import pytest

from medallion.model import Dataset, Publish
from medallion.operators.checks import InvalidDataError, not_null, unique
from medallion.plans.etl import LayeredETL
from medallion.sources.testdata import orders_batch
from tests.conftest import SF_SMALL


class TinyETL(LayeredETL):
    pipeline_id = "tiny"

    def __init__(self, spark, lake, suites, bad=False):
        super().__init__(spark, lake.path, lake.db, suites)
        self.bad = bad

    def bronze(self, ctx):
        orders = orders_batch(self.spark, SF_SMALL)
        if self.bad:
            orders = orders.unionByName(orders.limit(3))
        return {"orders": Dataset("orders", orders, self.table("orders"))}

    def silver(self, ctx, inputs):
        frame = inputs["orders"].frame.select("order_id", "customer_id")
        return {"check_only": Dataset("check_only", frame, "", Publish.SKIP)}

    def gold(self, ctx, inputs):
        return {}


SUITES = {"orders": (unique("order_id"),), "check_only": (not_null("customer_id"),)}


def test_template_runs_any_layers(spark, lake):
    published = TinyETL(spark, lake, SUITES).run("p1", "t1")
    assert set(published) == {"orders", "check_only"}
    n = spark.table(f"{lake.db}.orders").count()
    assert n == orders_batch(spark, SF_SMALL).count()
    results = {r["dataset"]: r for r in spark.table(f"{lake.db}.dq_results").collect()}
    assert results["check_only"]["element_count"] == n and results["check_only"]["success"]
    log = [r["run_params"] for r in spark.table(f"{lake.db}.run_metadata").collect()]
    assert sum('"function": "validate"' in p for p in log) == 3  # one per layer, the empty one too


def test_template_stops_at_first_failed_layer(spark, lake):
    with pytest.raises(InvalidDataError, match="orders"):
        TinyETL(spark, lake, SUITES, bad=True).run("p1", "t2")
    assert spark.table(f"{lake.db}.orders").count() == 0
    assert {r["dataset"] for r in spark.table(f"{lake.db}.dq_results").collect()} == {"orders"}


def test_publish_datasets_directly(spark, lake):
    from pyspark.sql import functions as F

    from medallion.plans.etl import publish_datasets

    orders = orders_batch(spark, SF_SMALL)
    dim_rows = spark.createDataFrame(
        [(1, "k1", "a", "b", "S", None, None, True, None, None)],
        "id BIGINT, customer_sur_id STRING, first_name STRING, last_name STRING, state_id STRING, "
        "datetime_created TIMESTAMP_NTZ, datetime_updated TIMESTAMP_NTZ, current BOOLEAN, "
        "valid_from TIMESTAMP_NTZ, valid_to TIMESTAMP_NTZ",
    )
    datasets = {
        "orders": Dataset("orders", orders, f"{lake.db}.orders"),
        "dim_customer": Dataset("dim_customer", dim_rows, f"{lake.db}.dim_customer", Publish.UPSERT, ("customer_sur_id",)),
        "skipped": Dataset("skipped", orders, "", Publish.SKIP),
    }
    out = publish_datasets(spark, datasets, "p9")
    assert spark.table(f"{lake.db}.orders").where("partition = 'p9'").count() == orders.count()
    assert spark.table(f"{lake.db}.orders").where(F.col("etl_inserted").isNull()).count() == 0
    assert [tuple(r) for r in spark.table(f"{lake.db}.dim_customer").select("id", "partition").collect()] == [(1, "p9")]
    assert out["skipped"] is datasets["skipped"]
