"""Newest-partition reads."""

from medallion.operators.latest import latest_partition
from medallion.operators.publish import replace_partition


def test_latest_partition_and_pruning(spark, lake):
    t = f"{lake.db}.sales_mart"
    assert latest_partition(spark, t).count() == 0  # empty table: no rows
    rows = lambda n: spark.createDataFrame(
        [(None, "S", i) for i in range(n)], "deliver_date DATE, state_id STRING, num_orders BIGINT"
    )
    replace_partition(spark, t, rows(2), "2024-01-01-00-00-00")
    replace_partition(spark, t, rows(3), "2024-01-02-00-00-00")
    latest = latest_partition(spark, t)
    assert latest.count() == 3
    assert {r["partition"] for r in latest.collect()} == {"2024-01-02-00-00-00"}
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan or "partition#" in plan
    view = spark.table(f"{lake.bi}.sales_mart")
    assert view.count() == 3 and view.columns == ["state_id", "delivery_date", "num_orders"]
    # a newer partition replaced with nothing no longer counts as newest
    replace_partition(spark, t, rows(0), "2024-01-02-00-00-00")
    view = spark.table(f"{lake.bi}.sales_mart")  # renewed by the publish
    assert view.count() == 2 and len(view.inputFiles()) == len(spark.table(t).where("partition = '2024-01-01-00-00-00'").inputFiles())
    assert "2024-01-01-00-00-00" in view._jdf.queryExecution().optimizedPlan().toString()
