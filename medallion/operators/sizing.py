"""Size-checked broadcast: measure a join side, broadcast it only if it fits.

Spark's planner guesses a side's size from file sizes, and AQE measures it
only after both sides have been shuffled, so a large side may be shuffled for
a join that ends up broadcast. Here the small side is measured first, in one
column-pruned pass: its exact row count and the exact bytes of its variable-
length values give an upper bound of its in-memory size. Only a side under
the limit is broadcast; any other side is joined by shuffle (sort-merge, with
AQE's skew splitting).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

LIMIT_CONF = "spark.medallion.broadcastMaxBytes"
# Bytes of the hashed relation built from the side. Every broadcast passes through
# the driver, and a run makes dozens of them: the limit bounds their sum as well.
DEFAULT_LIMIT = 8 << 20
# The same for a side that a job broadcasts once.
ONE_SIDE_LIMIT = 256 << 20
_HASH_FACTOR = 1.5  # hashed relation vs. its rows: pointer array and entry headers
_ROW_OVERHEAD = 16  # null bitset word plus hash-map slot, per row
_VAR_SLACK = 8  # 8-byte rounding of each variable-length value


def broadcast_limit(frame: DataFrame, default: int = DEFAULT_LIMIT) -> int:
    conf = frame.sparkSession.conf
    if conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760").strip() == "-1":
        return -1  # broadcasting disabled for the session
    return int(conf.get(LIMIT_CONF, str(default)))


def measured_size(frame: DataFrame) -> tuple[int, int]:
    """(rows, upper bound of the rows' in-memory bytes), from one pass."""
    fields = frame.schema.fields
    var = [f.name for f in fields if isinstance(f.dataType, (StringType, BinaryType))]
    fixed = sum(8 for f in fields if f.name not in var) + 8 * len(var)
    aggs = [F.count(F.lit(1)).alias("_rows")]
    aggs += [F.sum(F.coalesce(F.octet_length(F.col(c)), F.lit(0))).alias(f"_v{i}") for i, c in enumerate(var)]
    row = frame.agg(*aggs).first()
    rows = int(row["_rows"])
    var_bytes = sum(int(row[f"_v{i}"] or 0) for i in range(len(var)))
    return rows, rows * (_ROW_OVERHEAD + fixed + _VAR_SLACK * len(var)) + var_bytes


def fits_broadcast(frame: DataFrame) -> bool:
    limit = broadcast_limit(frame)
    if limit < 0:
        return False
    _, size = measured_size(frame)
    return _HASH_FACTOR * size <= limit


def small_side(frame: DataFrame, broadcast: bool | None) -> DataFrame:
    """``frame`` with a broadcast hint when ``broadcast`` is True, or when it
    is None and the measured size fits; otherwise with a hint to shuffle it."""
    if broadcast is None:
        broadcast = fits_broadcast(frame)
    return F.broadcast(frame) if broadcast else shuffled_side(frame)


def shuffled_side(frame: DataFrame) -> DataFrame:
    """``frame`` joined by shuffle. Without the hint the planner broadcasts a side
    whose *files* are under its threshold, many times larger in memory."""
    return frame.hint("merge")


class SizeProfile:
    """Exact row count and bytes of each variable-length column of a frame,
    observed while the frame was written. Bounds the in-memory size of any
    projection of the frame (or of a subset of its rows)."""

    def __init__(self, rows: int, var_bytes: dict[str, int], columns: list[str]):
        self.rows = rows
        self.var_bytes = var_bytes
        self.columns = columns

    def bound(self, cols) -> int:
        var = [c for c in cols if c in self.var_bytes]
        fixed = 8 * len(cols)
        return self.rows * (_ROW_OVERHEAD + fixed + _VAR_SLACK * len(var)) + sum(
            self.var_bytes[c] for c in var
        )

    def fits(self, frame: DataFrame, cols, default: int = DEFAULT_LIMIT) -> bool:
        """``default``: the limit of a session that sets none."""
        limit = broadcast_limit(frame, default)
        return limit >= 0 and _HASH_FACTOR * self.bound(cols) <= limit

    def __repr__(self) -> str:
        return f"SizeProfile(rows={self.rows}, var_bytes={self.var_bytes})"


def profile_exprs(frame: DataFrame, where=None) -> tuple[list, list[str]]:
    """Aggregates of a size profile; ``where`` profiles the rows it holds for."""
    var = [f.name for f in frame.schema.fields if isinstance(f.dataType, (StringType, BinaryType))]
    counted = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    exprs = [F.count_if(counted).alias("_rows")]
    exprs += [
        F.sum(F.when(counted, F.coalesce(F.octet_length(F.col(c)), F.lit(0))).otherwise(0)).alias(f"_v{i}")
        for i, c in enumerate(var)
    ]
    return exprs, var


def profile_from(row, var: list[str], columns: list[str]) -> SizeProfile:
    return SizeProfile(int(row["_rows"]), {c: int(row[f"_v{i}"] or 0) for i, c in enumerate(var)}, columns)


def profile_of(frame: DataFrame) -> SizeProfile:
    """Size profile of ``frame`` from one pass (reads only its columns)."""
    exprs, var = profile_exprs(frame)
    return profile_from(frame.agg(*exprs).first(), var, list(frame.columns))


def observe_profile(frame: DataFrame):
    """(observed frame, profile()) — ``profile()`` is valid once an action
    (a write) has run on the observed frame. No extra pass over the data."""
    import uuid

    from pyspark.sql import Observation

    exprs, var = profile_exprs(frame)
    obs = Observation(f"size_{uuid.uuid4().hex[:8]}")
    observed = frame.observe(obs, *exprs)
    return observed, lambda: profile_from(obs.get, var, list(frame.columns))
