"""Whole jobs: catalog DDL, the layered ETL template, the sales ETL."""

from medallion.plans.etl import LayeredETL, RunContext, check_required_inputs, publish_datasets
from medallion.plans.sales import SalesMartETL

__all__ = ["LayeredETL", "RunContext", "SalesMartETL", "check_required_inputs", "publish_datasets"]
