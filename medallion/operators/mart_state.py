"""The mart over all runs, kept by signed differences.

``sales_mart`` counts one run's facts. Over all runs the counts change in two ways:
a run brings facts, and it closes (or opens) dimension rows, which moves the facts
that carry those keys to another state. Both are differences that need no fact of an
older run, given the counts of every run by key and date:

* the run's facts, counted by key and date, at the states their keys have now;
* minus what the same run had counted before (a run again replaces itself);
* for keys whose state moved: the counts of other runs, out of the state before and
  into the state now.

The differences are summed per cell and merged into the stored cells; cells that
come to zero go. Counts and cells are published as one unit (``operators.layer``),
so a run that dies leaves them in step. Facts without a key, or whose key has no
current row, are in the NULL state, as in ``sales_mart``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.functions.columns import deliver_date
from medallion.operators.layer import publish_layer
from medallion.operators.publish import read_version, replacement, stage_partition
from medallion.operators.scd2 import current_rows
from medallion.operators.sizing import shuffled_side, small_side

ALL_RUNS = "all"  # the one partition of the cells' table


def key_counts(facts: DataFrame, key: str = "customer_sur_id", date_col: str = "delivered_on") -> DataFrame:
    """Facts counted per key and date: one row per pair and task is shuffled,
    whatever share of the facts a hot or NULL key holds."""
    return facts.select(F.col(key), deliver_date(date_col).alias("deliver_date")).groupBy(key, "deliver_date").agg(
        F.count(F.lit(1)).alias("num_orders"))


def moved_keys(changes: DataFrame, before: DataFrame, after: DataFrame, key: str, attr: str) -> DataFrame:
    """(key, was, now): changed keys whose state is another one now; NULL where
    the key has no current row. The dimension is reduced to the changed keys."""
    ids = changes.where(F.col(key).isNotNull()).select(F.col(key).alias("_m_key")).distinct()
    side = small_side(ids, None)

    def states(dim: DataFrame, name: str) -> DataFrame:
        cur = current_rows(dim).join(side, F.col(key) == F.col("_m_key"), "left_semi")
        return cur.groupBy(key).agg(F.max(attr).alias(name))

    both = states(before, "was").join(states(after, "now"), key, "full_outer")
    return both.where(~F.col("was").eqNullSafe(F.col("now")))


def mart_differences(
    counts: DataFrame, own_before: DataFrame, others: DataFrame, moved: DataFrame, before: DataFrame, after: DataFrame,
    key: str = "customer_sur_id", attr: str = "state_id",
) -> DataFrame:
    """(deliver_date, attr, num_orders): what to add to the cells, signed.
    ``counts`` / ``own_before``: the run's counts now and before; ``others``: those of
    the other runs."""
    def placed(rows: DataFrame, dim: DataFrame, sign: int) -> DataFrame:
        cur = current_rows(dim).where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_k")).agg(F.max(attr).alias(attr))
        return rows.join(shuffled_side(cur), F.col(key) == F.col("_k"), "left").select("deliver_date", attr, (F.col("num_orders") * sign).alias("num_orders"))

    shifted = others.join(shuffled_side(moved), key)
    out = shifted.select("deliver_date", F.col("was").alias(attr), (-F.col("num_orders")).alias("num_orders"))
    into = shifted.select("deliver_date", F.col("now").alias(attr), "num_orders")
    parts = placed(counts, after, 1).unionByName(placed(own_before, before, -1)).unionByName(out).unionByName(into)
    return parts.groupBy("deliver_date", attr).agg(F.sum("num_orders").alias("num_orders")).where("num_orders <> 0")


def merged_cells(cells: DataFrame, differences: DataFrame, attr: str = "state_id") -> DataFrame:
    both = cells.select("deliver_date", attr, "num_orders").unionByName(differences)
    return both.groupBy("deliver_date", attr).agg(F.sum("num_orders").alias("num_orders")).where("num_orders <> 0")


def update_mart(
    spark: SparkSession, root: str, counts_table: str, cells_table: str, facts: DataFrame, changes: DataFrame,
    before: DataFrame, after: DataFrame, partition: str, key: str = "customer_sur_id", attr: str = "state_id",
) -> DataFrame:
    """Bring counts and cells up to a run; returns the new cells.

    ``facts``: the run's facts. ``changes``: its dimension rows (``before`` and
    ``after`` are the dimension's versions around them, as frames over files)."""
    folder, counts = stage_partition(spark, counts_table, key_counts(facts, key), partition)
    own = read_version(spark, counts_table, keep=lambda p: p == partition)
    others = read_version(spark, counts_table, keep=lambda p: p != partition)
    moved = moved_keys(changes, before, after, key, attr)
    # one state per key, so the same run again sees its keys where they are
    differences = mart_differences(counts, own, others, moved, before, after, key, attr)
    cells = merged_cells(read_version(spark, cells_table), differences, attr)
    cells_folder, staged = stage_partition(spark, cells_table, cells, ALL_RUNS)
    publish_layer(spark, root, [
        replacement(spark, counts_table, partition, folder), replacement(spark, cells_table, ALL_RUNS, cells_folder)])
    return staged
