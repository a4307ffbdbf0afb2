"""The sales ETL: customers and orders in, a customer dimension (SCD2), an
orders fact with surrogate keys, and a mart of orders per day and state."""

from __future__ import annotations

import sys
from collections.abc import Callable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from medallion.functions.columns import with_surrogate_key
from medallion.model import DEFAULT_DATABASE, Dataset, Publish
from medallion.operators.checks import SALES_SUITES
from medallion.operators.history import scd2_versions
from medallion.operators.lookup import lookup_current
from medallion.operators.mart import sales_mart
from medallion.operators.runlog import logged, logged_layer
from medallion.operators.scd2 import scd2_changes
from medallion.plans.etl import LayeredETL, RunContext, check_required_inputs
from medallion.sources.generate import generate_bronze

Source = Callable[[SparkSession], tuple[DataFrame, DataFrame]]


class SalesMartETL(LayeredETL):
    pipeline_id = "sales_mart"
    profile_columns = {"dim_customer": ["id", "customer_sur_id", "state_id"]}
    profile_rows = {"dim_customer": "current"}

    def __init__(
        self,
        spark: SparkSession,
        storage_path: str,
        database: str = DEFAULT_DATABASE,
        source: Source | None = None,
        metadata_database: str | None = None,
        late_rows: str = "keep",
    ):
        """``late_rows``: customers older than the version the dimension has are
        kept as a second current row (as the original job does), or ``"drop"``ped,
        or ``"splice"``d into the history; the latter two also take several
        versions of a customer in one batch."""
        super().__init__(spark, storage_path, database, SALES_SUITES, metadata_database)
        if late_rows not in ("keep", "drop", "splice"):
            raise ValueError(f"unknown late_rows {late_rows!r}")
        self.source = source or generate_bronze()
        self.late_rows = late_rows

    @logged_layer
    def bronze(self, ctx: RunContext) -> dict[str, Dataset]:
        customer, orders = self.source(self.spark)
        return {
            "customer": Dataset("customer", customer, self.table("customer")),
            "orders": Dataset("orders", orders, self.table("orders")),
        }

    @logged
    def dim_customer(self, ctx: RunContext, customer: Dataset) -> DataFrame:
        """This run's dimension rows: new versions and closed old ones."""
        dim = self.spark.table(self.table("dim_customer"))
        source = with_surrogate_key(customer.frame)
        if self.late_rows != "keep":
            return scd2_versions(source, dim, late_rows=self.late_rows, broadcast_ids=_fits(customer, ["id"]))
        return scd2_changes(source, dim, broadcast_ids=_fits(customer, ["id"]))

    @logged
    def fct_orders(self, ctx: RunContext, inputs: Mapping[str, Dataset]) -> DataFrame:
        dim = inputs["dim_customer"]
        return lookup_current(
            inputs["orders"].frame, dim.frame, broadcast=_fits(dim, ["id", "customer_sur_id"])
        )

    @logged_layer
    def silver(self, ctx: RunContext, inputs: Mapping[str, Dataset]) -> dict[str, Dataset]:
        check_required_inputs(inputs, ["customer", "orders"])
        # The fact needs the dimension as it will be after this run: stage
        # the upserted dimension first and look keys up in that snapshot.
        dim = self.stage(
            ctx,
            Dataset(
                "dim_customer",
                self.dim_customer(ctx, inputs["customer"]),
                self.table("dim_customer"),
                Publish.UPSERT,
                ("customer_sur_id",),
                # closed history and current rows in separate row groups:
                # reads of current rows skip the history by statistics
                sort_within=("current",),
            ),
        )
        fct = Dataset(
            "fct_orders",
            self.fct_orders(ctx, {**inputs, "dim_customer": dim}),
            self.table("fct_orders"),
        )
        return {"dim_customer": dim, "fct_orders": fct}

    @logged
    def sales_mart(self, ctx: RunContext, inputs: Mapping[str, Dataset]) -> DataFrame:
        dim = inputs["dim_customer"]
        return sales_mart(
            inputs["fct_orders"].frame, dim.frame, broadcast=_fits(dim, ["customer_sur_id", "state_id"])
        )

    @logged_layer
    def gold(self, ctx: RunContext, inputs: Mapping[str, Dataset]) -> dict[str, Dataset]:
        check_required_inputs(inputs, ["dim_customer", "fct_orders"])
        return {"sales_mart": Dataset("sales_mart", self.sales_mart(ctx, inputs), self.table("sales_mart"))}


def _fits(ds: Dataset, cols) -> bool | None:
    """Broadcast decision from the size profiled when ``ds`` was staged (of a
    dimension, its current rows); None (measure) if it was not profiled."""
    return ds.profile.fits(ds.frame, cols) if ds.profile is not None else None


def main(argv: list[str] | None = None) -> None:
    """``spark-submit -m medallion.plans.sales <storage path> [partition]``.

    Tables that the session's catalog does not have are made over the storage
    path and get back what was published there, so this job and the DDL job
    need share no catalog; with a Hive catalog (``--hive``) they do."""
    from medallion.plans.ddl import create_all
    from medallion.session import build_session

    args = list(sys.argv[1:] if argv is None else argv)
    hive = "--hive" in args
    args = [a for a in args if a != "--hive"]
    if not args:
        raise SystemExit("a storage path is required")
    spark = build_session(None, None, app_name="sales_mart", enable_hive=hive)
    create_all(spark, args[0])
    partition = args[1] if len(args) > 1 else datetime.now().strftime("%Y-%m-%d-%H-%M-%S")
    SalesMartETL(spark, args[0]).run(partition)


if __name__ == "__main__":
    main()
