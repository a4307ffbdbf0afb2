"""Table-pipeline operators, each a Spark job over DataFrames."""

from medallion.operators.checks import (
    SALES_SUITES,
    InvalidDataError,
    Rule,
    check_datasets,
    check_frame,
    gate,
    not_null,
    unique,
)
from medallion.operators.history import scd2_versions
from medallion.operators.keys import repeated_keys, stage_unique
from medallion.operators.latest import latest_partition
from medallion.operators.layer import finish_layers, publish_layer
from medallion.operators.lookup import lookup_current
from medallion.operators.mart import sales_mart
from medallion.operators.mart_state import update_mart
from medallion.operators.profiles import PartProfiles
from medallion.operators.publish import (
    ConflictError,
    DuplicateKeyError,
    finish_publish,
    merge_rows,
    publish_partition,
    publish_upsert,
    published,
    read_version,
    remove_unreferenced,
    replace_partition,
    stage_partition,
    stage_partitions,
    stage_snapshot,
    stage_upsert,
    upsert,
)
from medallion.operators.sizing import SizeProfile, fits_broadcast, profile_of, small_side
from medallion.operators.scd2 import (
    current_rows,
    scd2_changes,
    scd2_changes_three_joins,
    scd2_closures,
    scd2_net_new,
    scd2_new_versions,
)

__all__ = [
    "ConflictError", "DuplicateKeyError", "InvalidDataError", "Rule", "SALES_SUITES", "check_datasets",
    "check_frame", "current_rows", "gate", "latest_partition", "lookup_current",
    "merge_rows", "not_null", "publish_partition", "publish_upsert",
    "finish_publish", "remove_unreferenced",
    "replace_partition", "sales_mart", "scd2_changes", "scd2_changes_three_joins",
    "scd2_closures", "scd2_net_new", "scd2_new_versions", "stage_partition",
    "stage_partitions", "stage_snapshot", "stage_upsert", "unique", "upsert",
    "PartProfiles", "finish_layers", "publish_layer", "published", "read_version", "repeated_keys", "scd2_versions",
    "stage_unique", "update_mart",
    "SizeProfile", "fits_broadcast", "profile_of", "small_side",
]
