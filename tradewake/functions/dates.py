"""Date handling that never aborts a job and does not depend on the session zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_day(text: str | Column, pattern: str = "yyyy-MM-dd") -> Column:
    """Text to date; text that does not fit the pattern gives NULL."""
    return F.try_to_date(text, pattern)


def utc_day(epoch_seconds: str) -> Column:
    """UTC calendar day of an epoch second."""
    return F.date_from_unix_date(F.floor(F.col(epoch_seconds) / 86400).cast("int"))


def iso_weekday(day: str | Column) -> Column:
    """Monday 1 to Sunday 7."""
    return F.weekday(day) + 1
