"""Date and time column expressions. All are native and null in, null out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# National holidays that fall on the same date each year, MM-dd.
FIXED_HOLIDAYS = ("01-01", "04-21", "05-01", "09-07", "10-12", "11-02", "11-15", "12-25")

WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def parse_timestamp(value: Column | str) -> Column:
    """Timestamp without zone; text that is no timestamp becomes null."""
    return F.col(value).try_cast("timestamp_ntz") if isinstance(value, str) else value.try_cast("timestamp_ntz")


def calendar_days_between(later: Column, earlier: Column) -> Column:
    """Whole calendar days from ``earlier`` to ``later``, time of day ignored."""
    return F.datediff(F.to_date(later), F.to_date(earlier))


def elapsed_seconds(later: Column, earlier: Column) -> Column:
    """Seconds between two zone-free timestamps; no session zone is involved."""
    return (later - earlier).cast("interval second").cast("decimal(20,6)").cast("double")


def elapsed_days(later: Column, earlier: Column) -> Column:
    return elapsed_seconds(later, earlier) / F.lit(86400.0)


def elapsed_hours(later: Column, earlier: Column) -> Column:
    return elapsed_seconds(later, earlier) / F.lit(3600.0)


def month_of_year(ts: Column) -> Column:
    """Month number as text without padding, such as '9'."""
    return F.month(ts).cast("string")


def year_month(ts: Column) -> Column:
    """Calendar month such as '2018-03'."""
    return F.date_format(ts, "yyyy-MM")


def weekday_name(ts: Column) -> Column:
    return F.date_format(ts, "EEEE")


def fixed_holiday_flag(ts: Column) -> Column:
    """1 on a fixed national holiday, 0 on other days, null without a date."""
    return F.date_format(ts, "MM-dd").isin(*FIXED_HOLIDAYS).cast("double")


def fixed_holiday_flag_or_zero(ts: Column) -> Column:
    """As :func:`fixed_holiday_flag` but 0 without a date; used in the profile tables."""
    return F.coalesce(fixed_holiday_flag(ts), F.lit(0.0)).cast("tinyint")
