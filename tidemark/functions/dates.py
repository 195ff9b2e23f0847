"""Calendar arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_diff(start: Column | str, end: Column | str) -> Column:
    """Midnights crossed between two timestamps (not elapsed 24-hour periods)."""
    return F.datediff(_col(end).cast("date"), _col(start).cast("date"))


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
