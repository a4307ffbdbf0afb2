"""Generated bronze rows, made by Spark itself.

Every value is a function of the row number and a seed (``xxhash64``), not of
``rand()`` or ``uuid()``: a task that is re-run after an executor loss produces
the same rows, and the generator scales with ``spark.range`` partitions rather
than with driver memory.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The items an order can hold.
ITEMS = ["chair", "car", "toy"]

# US state and territory postal codes (50 states, DC, and the
# territories / freely associated states).
STATE_CODES = [
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "DC", "FL", "GA", "HI",
    "ID", "IL", "IN", "IA", "KS", "KY", "LA", "ME", "MD", "MA", "MI", "MN",
    "MS", "MO", "MT", "NE", "NV", "NH", "NJ", "NM", "NY", "NC", "ND", "OH",
    "OK", "OR", "PA", "RI", "SC", "SD", "TN", "TX", "UT", "VT", "VA", "WA",
    "WV", "WI", "WY", "AS", "FM", "GU", "MH", "MP", "PW", "PR", "VI",
]

# Name parts are built from syllables (a rule, not a list of names).
_SYLLABLES = ["al", "be", "cor", "da", "el", "fi", "ga", "ho", "is", "ja", "ka", "lo",
              "mi", "no", "or", "pe", "ra", "si", "ta", "vi"]


def _pick(values: list[str], *salt: Column | str) -> Column:
    arr = F.array(*[F.lit(v) for v in values])
    idx = F.pmod(F.xxhash64(*[F.lit(s) if isinstance(s, str) else s for s in salt]), F.lit(len(values)))
    return F.element_at(arr, (idx + 1).cast("int"))


def _name(row: Column, seed: int, tag: str) -> Column:
    parts = [_pick(_SYLLABLES, row, F.lit(seed), F.lit(f"{tag}{i}")) for i in range(3)]
    return F.initcap(F.concat(*parts))


def _uuid_text(*salt: Column) -> Column:
    h = F.md5(F.concat_ws(":", *[s.cast("string") for s in salt]))
    return F.concat_ws(
        "-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
        F.substring(h, 17, 4), F.substring(h, 21, 12),
    )


def generate_customers(
    spark: SparkSession, n: int = 1000, seed: int = 0, now: datetime | None = None
) -> DataFrame:
    """Customers ``0..n-1`` with names, a state code and ``now`` as both times."""
    ts = F.lit(now or datetime.now()).cast("timestamp_ntz")
    row = F.col("id")
    return spark.range(n).select(
        row.alias("id"),
        _name(row, seed, "first").alias("first_name"),
        _name(row, seed, "last").alias("last_name"),
        _pick(STATE_CODES, row, F.lit(seed), "state").alias("state_id"),
        ts.alias("datetime_created"),
        ts.alias("datetime_updated"),
    )


def generate_orders(
    spark: SparkSession,
    n: int = 10000,
    n_customers: int = 1000,
    seed: int = 0,
    now: datetime | None = None,
) -> DataFrame:
    """``n`` orders over customers ``0..n_customers-1``, uniformly."""
    ts = F.lit(now or datetime.now()).cast("timestamp_ntz")
    row = F.col("id")
    return spark.range(n).select(
        _uuid_text(F.lit(seed), F.lit("order"), row).alias("order_id"),
        F.pmod(F.xxhash64(row, F.lit(seed), F.lit("customer")), F.lit(n_customers)).alias("customer_id"),
        _uuid_text(F.lit(seed), F.lit("item"), row).alias("item_id"),
        _pick(ITEMS, row, F.lit(seed), "item").alias("item_name"),
        ts.alias("delivered_on"),
        ts.alias("datetime_order_placed"),
    )


def generate_bronze(n_customers: int = 1000, n_orders: int = 10000, seed: int = 0):
    """A bronze source for the sales ETL: (spark) -> (customer, orders)."""

    def source(spark: SparkSession):
        now = datetime.now()
        return (
            generate_customers(spark, n_customers, seed, now),
            generate_orders(spark, n_orders, n_customers, seed, now),
        )

    return source
