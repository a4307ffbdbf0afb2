"""Attach the surrogate key of the current dimension row to fact rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.operators.scd2 import current_rows
from medallion.operators.sizing import fits_broadcast, shuffled_side

SPREAD = 1024  # salts of facts without a key


def lookup_current(
    fact: DataFrame,
    dim: DataFrame,
    *,
    fact_key: str = "customer_id",
    dim_key: str = "id",
    take: Sequence[str] = ("customer_sur_id",),
    broadcast: bool | None = None,
) -> DataFrame:
    """Left join of facts to current dim rows; facts without one get NULLs.

    A fact matching several current rows (late rows left two open versions)
    fans out, as a left join does; the fact's unique check reports it.

    The current dim side (key + taken columns) is broadcast when its measured
    size fits (``broadcast=None`` measures it): one scan of the fact, no
    shuffle of it. Else both sides shuffle on the key and a salt that is 0 for
    keyed facts, so facts with a NULL key, which cannot match, spread over all
    partitions instead of meeting in one.
    """
    cur = current_rows(dim).where(F.col(dim_key).isNotNull()).select(F.col(dim_key).alias("_lk_key"), *take)
    if broadcast is None:
        broadcast = fits_broadcast(cur)
    if broadcast:
        return fact.join(F.broadcast(cur), F.col(fact_key) == F.col("_lk_key"), "left").drop("_lk_key")
    spread = F.when(F.col(fact_key).isNull(), F.pmod(F.xxhash64(*fact.columns), F.lit(SPREAD))).otherwise(0)
    return (
        fact.withColumn("_lk_salt", spread.cast("int"))
        .join(
            shuffled_side(cur.withColumn("_lk_zero", F.lit(0))),
            (F.col(fact_key) == F.col("_lk_key")) & (F.col("_lk_salt") == F.col("_lk_zero")), "left",
        )
        .drop("_lk_key", "_lk_salt", "_lk_zero")
    )
