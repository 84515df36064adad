"""Column-level helpers (all JVM-side built-ins, no Python UDFs)."""

from stockledger.functions.scalar import (
    all_of,
    any_of,
    days_since_epoch,
    iff,
    nvl,
    ratio6,
    repeated,
    week_start_sk,
    zero_if_null,
)

__all__ = [
    "all_of",
    "any_of",
    "days_since_epoch",
    "iff",
    "nvl",
    "ratio6",
    "repeated",
    "week_start_sk",
    "zero_if_null",
]
