"""Raw retention: rows older than twelve months are dropped, whole days at a time."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import clock

# Fixed value: how long raw rows are kept. Derived tables are kept for good.
RETENTION_MONTHS = 12


def oldest_day(reference_time: datetime | str, months: int = RETENTION_MONTHS) -> str:
    """First day kept: the day holding the instant ``months`` before the reference."""
    ref = clock.from_us(clock.to_us(reference_time)).astimezone(timezone.utc)
    count = ref.year * 12 + ref.month - 1 - months
    year, month = divmod(count, 12)
    day = ref.day
    while True:
        try:
            return ref.replace(year=year, month=month + 1, day=day).date().isoformat()
        except ValueError:  # e.g. 29 February
            day -= 1


def within_retention(
    rows: DataFrame,
    time_column: str,
    reference_time: datetime | str,
    months: int = RETENTION_MONTHS,
    date_column: str | None = None,
) -> DataFrame:
    """Rows on or after the first day kept; prunes partitions by ``date_column``."""
    day = oldest_day(reference_time, months)
    kept = rows.where(F.col(time_column) >= clock.instant_lit(clock.to_us(day)))
    if date_column is not None:
        kept = kept.where(F.col(date_column) >= F.lit(day).cast("date"))
    return kept
