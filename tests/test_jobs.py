"""The job entries: separate jobs over one storage path, without a common catalog."""

import pytest

from medallion.model import DEFAULT_BI_DATABASE, DEFAULT_DATABASE
from medallion.plans import ddl, sales
from medallion.plans.sales import SalesMartETL
from medallion.session import scratch_path

P1, P2 = "2024-01-01-00-00-00", "2024-01-02-00-00-00"


def test_jobs_find_what_earlier_jobs_published(spark):
    path = scratch_path(spark, "jobs")
    try:
        ddl.main([path])
        sales.main([path, P1])
        # what a new process with a catalog of its own starts from
        ddl.drop_all(spark)
        sales.main([path, P2])
        for name in ("customer", "orders", "fct_orders", "sales_mart"):
            got = {r["partition"]: r["count"] for r in spark.table(f"{DEFAULT_DATABASE}.{name}").groupBy("partition").count().collect()}
            assert set(got) == {P1, P2}, name
        assert spark.table(f"{DEFAULT_DATABASE}.run_metadata").select("run_id").distinct().count() == 2
        assert spark.table(f"{DEFAULT_BI_DATABASE}.sales_mart").count() > 0
    finally:
        ddl.drop_all(spark)


def test_storage_path_is_required_and_decides(spark, lake):
    for main in (ddl.main, sales.main):
        with pytest.raises(SystemExit):
            main([])
    with pytest.raises(ValueError):
        SalesMartETL(spark, "", lake.db)
    with pytest.raises(ValueError, match="not under"):
        SalesMartETL(spark, "/somewhere/else", lake.db).run(P1)
