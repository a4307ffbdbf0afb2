"""Datasets handed between layers, and the table schemas of the sales ETL."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from enum import Enum

from pyspark.sql import DataFrame


# The databases' names.
DEFAULT_DATABASE = "sales"
DEFAULT_BI_DATABASE = "businessintelligence"


class Publish(Enum):
    """How a dataset reaches its table."""

    REPLACE_PARTITION = "replace_partition"  # overwrite one partition of the table
    UPSERT = "upsert"  # match on keys: update all columns, else insert
    SKIP = "skip"  # checked, never published


@dataclass(frozen=True)
class Dataset:
    """A named frame bound for a catalog table.

    ``keys`` matter only for ``Publish.UPSERT``. ``staged`` is the folder the
    frame was written to before checks; a staged dataset's ``frame`` reads that
    folder, so downstream work never recomputes the plan that produced it.
    """

    name: str
    frame: DataFrame
    table: str
    publish: Publish = Publish.REPLACE_PARTITION
    keys: tuple[str, ...] = field(default_factory=tuple)
    staged: str | None = None
    observed: tuple = field(default_factory=tuple)  # check results computed by the staging write
    profile: object = None  # SizeProfile observed by the staging write, when known
    version: object = None  # for upserts: the staged version (publish.Staged)
    sort_within: tuple[str, ...] = field(default_factory=tuple)  # order inside written files

    def with_frame(self, frame: DataFrame, staged: str | None = None, observed: tuple = ()) -> "Dataset":
        return replace(self, frame=frame, staged=staged, observed=observed)


# Column layouts of the sales ETL tables (fixed; ``partition`` is the run's
# partition string). Business timestamps are TIMESTAMP_NTZ so that surrogate
# keys built from their text do not depend on the session time zone; ids are
# BIGINT so that keys past 2^31 fit.
CUSTOMER_COLUMNS = (
    ("id", "BIGINT"),
    ("first_name", "STRING"),
    ("last_name", "STRING"),
    ("state_id", "STRING"),
    ("datetime_created", "TIMESTAMP_NTZ"),
    ("datetime_updated", "TIMESTAMP_NTZ"),
)
ORDERS_COLUMNS = (
    ("order_id", "STRING"),
    ("customer_id", "BIGINT"),
    ("item_id", "STRING"),
    ("item_name", "STRING"),
    ("delivered_on", "TIMESTAMP_NTZ"),
    ("datetime_order_placed", "TIMESTAMP_NTZ"),
)
DIM_CUSTOMER_COLUMNS = (
    ("id", "BIGINT"),
    ("customer_sur_id", "STRING"),
    ("first_name", "STRING"),
    ("last_name", "STRING"),
    ("state_id", "STRING"),
    ("datetime_created", "TIMESTAMP_NTZ"),
    ("datetime_updated", "TIMESTAMP_NTZ"),
    ("current", "BOOLEAN"),
    ("valid_from", "TIMESTAMP_NTZ"),
    ("valid_to", "TIMESTAMP_NTZ"),
)
FCT_ORDERS_COLUMNS = ORDERS_COLUMNS + (("customer_sur_id", "STRING"),)
SALES_MART_COLUMNS = (
    ("deliver_date", "DATE"),
    ("state_id", "STRING"),
    ("num_orders", "BIGINT"),
)
ETL_INSERTED = ("etl_inserted", "TIMESTAMP")
PARTITION = ("partition", "STRING")


def ddl_columns(columns) -> str:
    return ",\n  ".join(f"`{name}` {kind}" for name, kind in columns)
