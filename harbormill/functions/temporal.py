"""Dates and times. The session time zone is UTC."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from harbormill.functions.text import first_match


def day_first_date(c: Column) -> Column:
    """'7/03/2025' or '07/03/2025' to a date; other text is null."""
    return F.try_to_date(c, "d/M/yyyy")


def embedded_date(c: Column, pattern: str = r"\d{1,2}/\d{2}/\d{4}") -> Column:
    """First day/month/year found inside a longer text."""
    return day_first_date(first_match(c, pattern))


def epoch_ms_date(c: Column) -> Column:
    return F.to_date(F.timestamp_millis(c))


def utc_timestamp(c: Column) -> Column:
    """ISO text to an instant; text without an offset means UTC."""
    return F.to_timestamp(c)


def month_key(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")


def year_range(c: Column, year: int) -> Column:
    """Rows of one calendar year, written as a range so that it reaches the file scan."""
    return (c >= F.lit(dt.date(year, 1, 1))) & (c < F.lit(dt.date(year + 1, 1, 1)))


def epoch_seconds(c: Column) -> Column:
    """Whole seconds since 1970, for plain and zoned timestamps alike."""
    return F.unix_seconds(c.cast("timestamp"))


def epoch_micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))
