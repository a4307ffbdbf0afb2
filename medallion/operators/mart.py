"""Aggregate facts into a mart: orders per delivery date and state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.functions.columns import deliver_date
from medallion.operators.scd2 import current_rows
from medallion.operators.sizing import fits_broadcast, shuffled_side


def sales_mart(
    fct: DataFrame,
    dim: DataFrame,
    *,
    key: str = "customer_sur_id",
    date_col: str = "delivered_on",
    group_attr: str = "state_id",
    broadcast: bool | None = None,
) -> DataFrame:
    """``num_orders`` per (deliver_date, state_id); NULL keys form groups.

    Facts whose key has no current dim row land in the NULL state group. Only
    the key and the date are read from the fact. The current dim side is
    broadcast when its measured size fits (``broadcast=None`` measures it): the
    facts are then joined where they are and only partial counts are shuffled.
    Otherwise the facts are counted per key and date first, so what is
    shuffled to the join is one row per key and date, whatever share of the
    facts a hot or NULL key holds.
    """
    cur = current_rows(dim).where(F.col(key).isNotNull()).select(F.col(key).alias("_m_key"), F.col(group_attr))
    if broadcast is None:
        broadcast = fits_broadcast(cur)
    facts = fct.select(F.col(key), deliver_date(date_col).alias("deliver_date"))
    if broadcast:
        joined = facts.join(F.broadcast(cur), F.col(key) == F.col("_m_key"), "left")
        return joined.groupBy("deliver_date", group_attr).agg(F.count(F.lit(1)).alias("num_orders"))
    counted = facts.groupBy(key, "deliver_date").agg(F.count(F.lit(1)).alias("_n"))
    joined = counted.join(shuffled_side(cur), F.col(key) == F.col("_m_key"), "left")
    return joined.groupBy("deliver_date", group_attr).agg(F.sum("_n").alias("num_orders"))
