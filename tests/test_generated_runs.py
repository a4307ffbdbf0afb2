"""Runs over generated data reproduce the documented row counts:
partitions = runs, 59 rows in the BI view (one delivery date x 59 state
codes), 1,000 dimension rows and 10,000 fact rows per run."""

from datetime import datetime, timezone

import pytest

from medallion.plans.sales import SalesMartETL
from medallion.sources.generate import generate_bronze


def test_two_generated_runs(spark, lake):
    if datetime.now(timezone.utc).strftime("%H:%M") >= "23:58":
        pytest.skip("a run across midnight has two delivery dates")
    etl = SalesMartETL(spark, lake.path, lake.db, generate_bronze(seed=7))
    etl.run("2024-01-01-00-00-00", "g1")
    etl.run("2024-01-02-00-00-00", "g2")
    q = lambda sql: spark.sql(sql.format(db=lake.db, bi=lake.bi)).collect()
    assert len(q("SELECT partition FROM {db}.sales_mart GROUP BY 1")) == 2
    assert q("SELECT count(*) FROM {bi}.sales_mart")[0][0] == 59
    assert q("SELECT count(*) FROM {db}.dim_customer")[0][0] == 1000 * 2
    assert q("SELECT count(*) FROM {db}.dim_customer WHERE current")[0][0] == 1000
    assert q("SELECT count(*) FROM {db}.fct_orders")[0][0] == 10000 * 2
    # the dimension's layout: run 1's rows were all replaced by closed versions
    # written by run 2, so only run 2's partition is left
    assert [r[0] for r in q("SELECT DISTINCT partition FROM {db}.dim_customer")] == ["2024-01-02-00-00-00"]
