"""Column expressions shared by the operators (all built-in, JVM-side)."""

from medallion.functions.columns import (
    OPEN_END,
    deliver_date,
    open_end,
    surrogate_key,
    with_surrogate_key,
)

__all__ = ["OPEN_END", "deliver_date", "open_end", "surrogate_key", "with_surrogate_key"]
