"""Scalar column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the end of the validity interval of an open (current) version.
OPEN_END = "2099-01-01 12:00:00"


def open_end() -> Column:
    """``valid_to`` of a current row, as a timestamp (not a string)."""
    return F.lit(OPEN_END).cast("timestamp_ntz")


def surrogate_key(id_col: str = "id", version_col: str = "datetime_updated") -> Column:
    """``md5(concat(id, version))``: the text of both, no separator.

    NULL in either gives a NULL key. With a TIMESTAMP_NTZ version the text,
    and so the key, does not depend on the session time zone.
    """
    return F.md5(F.concat(F.col(id_col).cast("string"), F.col(version_col).cast("string")))


def with_surrogate_key(
    frame: DataFrame,
    key_col: str = "customer_sur_id",
    id_col: str = "id",
    version_col: str = "datetime_updated",
) -> DataFrame:
    return frame.withColumn(key_col, surrogate_key(id_col, version_col))


def deliver_date(col: str = "delivered_on") -> Column:
    """Calendar date of a delivery timestamp.

    Only timestamps are taken: for those a date pattern has no effect, so none
    is given (a pattern would change the result for string input).
    """
    return F.to_date(F.col(col))
