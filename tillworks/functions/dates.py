"""Calendar expressions. Timestamps carry no time zone, so results do not depend on the session."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_timestamp(text: Column) -> Column:
    return text.try_cast("timestamp_ntz")


def quarter_bucket(moment: Column) -> Column:
    """Calendar quarter; an unknown moment falls into quarter 4, as the reports define it."""
    return F.coalesce(F.quarter(moment), F.lit(4))


def ship_date(order_date: Column, days: Column) -> Column:
    """Midnight ``days`` days after the order's day."""
    return F.date_add(order_date.cast("date"), days.cast("int")).cast("timestamp_ntz")


def quarter_name(quarter: Column) -> Column:
    return F.concat(F.lit("Q"), quarter.cast("string"))


def month_name(moment: Column) -> Column:
    return F.date_format(moment, "MMMM")


def weekday_name(moment: Column) -> Column:
    return F.date_format(moment, "EEEE")


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start.cast("date"))
