"""The newest partition of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.operators.publish import filled_partitions


def newest_partition(spark: SparkSession, table: str) -> str | None:
    """Lexicographically largest partition value that has rows.

    The table's published version tells which partitions have rows, as their
    writes counted them: no data file is opened and no job runs."""
    return max(filled_partitions(spark, table), default=None)


def latest_partition(spark: SparkSession, table: str, col: str = "partition") -> DataFrame:
    """Rows of the newest partition that has rows, by a literal partition
    filter: older partitions are neither listed for it nor read. An empty
    table gives no rows."""
    newest = newest_partition(spark, table)
    return spark.table(table).where(F.lit(False) if newest is None else F.col(col) == newest)
