"""History of a type-2 dimension, rebuilt for the ids of a batch.

``scd2_changes`` compares a batch with the current rows only and expects one
version of an id per batch. Here a version is (id, version time), a batch may
hold any number of them, and they are put where they belong in time:

* the batch and the touched ids' history, current and closed, are one set of
  versions; one that is in both is the batch's (its attributes win, its place
  in time is the same);
* each version is valid until the next one of its id, the newest is current and
  open. A closed row carries the time it was closed as ``datetime_updated``,
  as ``scd2_changes`` writes it;
* only rows that are new or differ from the history are returned, keyed by
  their surrogate key, for an upsert.

``late_rows`` says what to do with versions older than the newest known one of
their id: ``"splice"`` puts them into the history, ``"drop"`` leaves them out.
(``scd2_changes`` keeps them as a second current row, like the original job.)

Rows with a NULL id or version have no place in time: they become open versions
and touch no history. Equal rows count once; of several rows with one id and
version, the one with the largest attributes (compared in order, NULL counts as
largest) is taken.

The next version is found without collecting an id's versions in one task: the
versions are range-sorted by (id, version), so an id with very many of them
spans partitions, and only the first version of an id in each partition is
passed on to the partition before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medallion.functions.columns import open_end
from medallion.operators.publish import materialize
from medallion.operators.scd2 import CUSTOMER_ATTRS
from medallion.operators.sizing import small_side
from medallion.session import scratch_path

LATE_ROWS = ("splice", "drop")


def with_next(frame: DataFrame, key: str, order: str, into: str) -> DataFrame:
    """``frame`` with the next larger ``order`` of the row's ``key`` (NULL for
    the last). Pairs (key, order) must be distinct."""
    placed = frame.repartitionByRange(F.col(key), F.col(order)).withColumn("_part", F.spark_partition_id())
    placed = materialize(placed, scratch_path(frame.sparkSession, "history"))
    inside = placed.withColumn("_next", F.lead(order).over(Window.partitionBy("_part", key).orderBy(order)))
    # one row per key and partition it lies in
    firsts = placed.groupBy(F.col(key).alias("_key"), F.col("_part").alias("_of")).agg(F.min(order).alias("_first"))
    after = firsts.withColumn("_after", F.lead("_first").over(Window.partitionBy("_key").orderBy("_of")))
    after = after.where(F.col("_after").isNotNull()).select("_key", "_of", "_after")
    joined = inside.join(after, (F.col("_part") == F.col("_of")) & (F.col(key) == F.col("_key")), "left")
    return joined.withColumn(into, F.coalesce("_next", "_after")).drop("_part", "_next", "_key", "_of", "_after")


def scd2_versions(
    source: DataFrame,
    dim: DataFrame,
    *,
    late_rows: str = "splice",
    id_col: str = "id",
    key_col: str = "customer_sur_id",
    version_col: str = "datetime_updated",
    attrs: Sequence[str] = CUSTOMER_ATTRS,
    broadcast_ids: bool | None = None,
) -> DataFrame:
    """New and changed dimension rows after a batch of versions.

    ``source`` carries ``key_col`` and should be a scan or a staged table. The
    dimension is reduced to the batch's ids before anything is shuffled; they
    are broadcast when their measured size fits (``broadcast_ids=None``)."""
    if late_rows not in LATE_ROWS:
        raise ValueError(f"late_rows must be one of {LATE_ROWS}")
    base = [id_col, key_col, *attrs, version_col]
    columns = [*base, "current", "valid_from", "valid_to"]
    src = source.select(*base)
    timed = F.col(id_col).isNotNull() & F.col(version_col).isNotNull()

    one = F.struct(*[F.struct(F.col(a).isNull().alias("n"), F.col(a).alias("v")) for a in attrs], F.col(key_col))
    batch = src.where(timed).groupBy(id_col, version_col).agg(F.max_by(F.struct(*base), one).alias("_r")).select("_r.*")

    ids = small_side(batch.select(F.col(id_col).alias("_b_id")).distinct(), broadcast_ids)
    known = dim.select(*columns).where(F.col(id_col).isNotNull() & F.col("valid_from").isNotNull())
    known = known.join(ids, F.col(id_col) == F.col("_b_id"), "left_semi")

    if late_rows == "drop":
        newest = known.groupBy(F.col(id_col).alias("_k_id")).agg(F.max("valid_from").alias("_k_version"))
        batch = batch.join(newest, F.col(id_col) == F.col("_k_id"), "left")
        batch = batch.where(F.col("_k_version").isNull() | (F.col(version_col) >= F.col("_k_version"))).select(*base)

    before = F.struct(*[F.col(c) for c in columns])
    theirs = known.select(F.col(id_col), F.col("valid_from").alias("_at"), before.alias("_before"), F.lit(None).alias("_now"))
    ours = batch.select(F.col(id_col), F.col(version_col).alias("_at"), F.lit(None).alias("_before"), F.struct(*base).alias("_now"))
    # a version in both is one row; late rows kept twice by scd2_changes have one key, so one row too
    versions = theirs.unionByName(ours).groupBy(id_col, "_at").agg(
        F.max("_before").alias("_before"), F.max("_now").alias("_now"))
    chained = with_next(versions, id_col, "_at", "_until")

    attr = {c: F.when(F.col("_now").isNotNull(), F.col(f"_now.{c}")).otherwise(F.col(f"_before.{c}")) for c in [key_col, *attrs]}
    rows = chained.select(
        F.col(id_col), *[attr[c].alias(c) for c in [key_col, *attrs]],
        F.coalesce("_until", "_at").alias(version_col), F.col("_until").isNull().alias("current"),
        F.col("_at").alias("valid_from"), F.coalesce("_until", open_end()).alias("valid_to"), "_before",
    ).select(*columns, "_before")
    changed = rows.where(~F.struct(*[F.col(c) for c in columns]).eqNullSafe(F.col("_before"))).select(*columns)
    untimed = src.where(~timed | timed.isNull()).select(
        *base, F.lit(True).alias("current"), F.col(version_col).alias("valid_from"), open_end().alias("valid_to"))
    return changed.unionByName(untimed)
