"""Date and time-of-day helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed output formats of the reports: month/day/year, 24-hour clock.
US_DATE = "MM/dd/yyyy"
US_DATETIME = "MM/dd/yyyy HH:mm:ss"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def us_date(x) -> Column:
    """date -> 'mm/dd/yyyy' text."""
    return F.date_format(_c(x), US_DATE)


def us_datetime_of_date(x) -> Column:
    """timestamp -> its date -> 'mm/dd/yyyy 00:00:00' text (the date cast
    drops the time of day before formatting)."""
    return F.date_format(F.to_date(_c(x)), US_DATETIME)


def parse_us_date(x) -> Column:
    """'mm/dd/yyyy' text -> date (NULL for malformed text)."""
    return F.try_to_date(_c(x), US_DATE)


def week_start(x) -> Column:
    """Monday of the ISO week containing the date."""
    return F.trunc(_c(x), "week")


def month_start(x) -> Column:
    """first day of the month."""
    return F.trunc(_c(x), "month")


def hour_of_time_text(x) -> Column:
    """hour of an 'HH:mm:ss' (or 'H:mm:ss') time-of-day text, as bigint."""
    return F.substring_index(_c(x), ":", 1).try_cast("bigint")


def seconds_of_day(x) -> Column:
    """'HH:mm:ss' (or 'HH:mm') time-of-day text -> seconds since midnight (bigint); malformed text gives NULL."""
    parts = F.split(_c(x), ":")
    part = lambda i: F.get(parts, i).try_cast("bigint")
    return F.when(F.size(parts) == 3, part(0) * 3600 + part(1) * 60 + part(2)).when(F.size(parts) == 2, part(0) * 3600 + part(1) * 60)


def days_between(later, earlier) -> Column:
    """F8: whole days from ``earlier`` to ``later`` (date - date)."""
    return F.datediff(_c(later), _c(earlier)).cast("bigint")
