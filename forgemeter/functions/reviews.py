"""What counts as merged, dropped or open, and how long a merge took."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_HOUR = 3_600_000_000
MICROS_PER_DAY = 24 * MICROS_PER_HOUR


def is_merged() -> Column:
    return (F.col("state") == "closed") & F.col("merged_at").isNotNull()


def is_dropped() -> Column:
    """Closed without a merge."""
    return (F.col("state") == "closed") & F.col("merged_at").isNull()


def is_open() -> Column:
    return F.col("state") == "open"


def merge_micros() -> Column:
    """Microseconds from creation to merge; set whenever ``merged_at`` is, whatever the state."""
    return F.timestamp_diff("MICROSECOND", F.col("created_at"), F.col("merged_at"))


def in_days(micros: Column) -> Column:
    return micros.cast("double") / F.lit(float(MICROS_PER_DAY))


def in_hours(micros: Column) -> Column:
    return micros.cast("double") / F.lit(float(MICROS_PER_HOUR))
