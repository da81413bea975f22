"""Dates and times as the change log encodes them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = ["age_in_years", "as_date", "birth_date", "days_before", "from_micros"]

AsOf = dt.date | Column | str | None

# Fixed value.
DAYS_PER_YEAR = 365.25


def as_date(as_of: AsOf) -> Column:
    """A date column from a date, an ISO text or a column; today when None."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of.cast("date")
    return F.lit(str(as_of)).cast("date")


def days_before(as_of: AsOf, days: int) -> Column:
    """Midnight ``days`` before ``as_of``. A timestamp, so that a comparison leaves the
    time column bare and parquet statistics can still skip row groups."""
    return F.date_sub(as_date(as_of), days).cast("timestamp")


def from_micros(value: Column | str) -> Column:
    """Epoch microseconds (number or text) to a timestamp; unreadable text gives NULL."""
    micros = F.col(value) if isinstance(value, str) else value
    return F.timestamp_micros(micros.try_cast("bigint"))


def birth_date(value: Column | str) -> Column:
    """Birth dates come as epoch days or as ISO dates; anything else is NULL."""
    text = F.col(value) if isinstance(value, str) else value
    days = text.try_cast("int")
    return F.when(days.isNotNull(), F.date_add(F.lit("1970-01-01").cast("date"), days)).otherwise(
        text.try_cast("date")
    )


def age_in_years(born: Column | str, as_of: AsOf = None) -> Column:
    """Whole years of 365.25 days between birth and ``as_of``."""
    years = F.datediff(as_date(as_of), born) / F.lit(DAYS_PER_YEAR)
    return F.floor(years).cast("bigint")
