"""Dates as `yyyyMMdd` text, the form partition columns use."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN_DATE = "19000101"


def ymd(value) -> Column:
    """Text day of a date or timestamp."""
    return F.date_format(F.to_date(value), "yyyyMMdd")


def parse_ymd(value) -> Column:
    """Date of a text day; null when the text is no date."""
    return F.try_to_timestamp(value, F.lit("yyyyMMdd")).cast("date")


def shift_ymd(value, days) -> Column:
    """Text day moved by a number of days."""
    return F.date_format(F.date_add(parse_ymd(value), days), "yyyyMMdd")


def on_days(stamp, start: str, end: str) -> Column:
    """Whether a timestamp lies on the text days start..end; written on the bare column, so
    that the test reaches the scan."""
    first = datetime.strptime(start, "%Y%m%d")
    after = datetime.strptime(end, "%Y%m%d") + timedelta(days=1)
    stamp = F.col(stamp) if isinstance(stamp, str) else stamp
    literal = lambda d: F.lit(d.strftime("%Y-%m-%d")).cast("timestamp_ntz")
    return (stamp >= literal(first)) & (stamp < literal(after))


def reformat_date(value, source: str, target: str) -> Column:
    """Text date from one pattern to another; null when it does not parse."""
    return F.date_format(F.try_to_timestamp(value, F.lit(source)), target)


def month_of(value) -> Column:
    return F.date_format(F.to_date(value), "yyyyMM")


def day_before_month(month, months_back: int = 0) -> Column:
    """Last day of the month before `month` (text yyyyMM), or further back."""
    first = parse_ymd(F.concat(month, F.lit("01")))
    return F.date_format(F.date_sub(F.add_months(first, -months_back), 1), "yyyyMMdd")


def days_since(value, as_of) -> Column:
    """Signed days from `as_of` to a text day (negative for the past); unknown days give 0."""
    known = value.isNotNull() & (value != UNKNOWN_DATE)
    return F.when(known, F.datediff(parse_ymd(value), as_of)).otherwise(F.lit(0))
