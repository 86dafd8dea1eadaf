"""Date and time scalar functions (F1-F5).  All are built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hhmm(acq_time: Column) -> Column:
    """acquisition time as a 4-character HHMM string (leading zeros restored)."""
    return F.lpad(acq_time.cast("string"), 4, "0")


def detection_timestamp(acq_date: Column, acq_time: Column) -> Column:
    """date string + HHMM -> timestamp in the session zone (UTC).

    Unparseable input gives null (checked by the coercion contract).
    """
    t = hhmm(acq_time)
    text = F.concat_ws(" ", acq_date.cast("string"), F.concat(F.substring(t, 1, 2), F.lit(":"), F.substring(t, 3, 2)))
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm"))


def detection_day(acq_date: Column, acq_time: Column) -> Column:
    """the UTC calendar day of a detection."""
    return F.to_date(detection_timestamp(acq_date, acq_time))


def naive_day(ts: Column) -> Column:
    """a timestamp (zone-aware or not) to its calendar day in the session zone."""
    return F.to_date(ts)


def month_key(date: Column) -> Column:
    """``yyyy-MM``."""
    return F.date_format(date, "yyyy-MM")


def month_day(date: Column) -> Column:
    """``MM-dd``."""
    return F.date_format(date, "MM-dd")


def next_day(date: Column, days: int = 1) -> Column:
    """date + n days."""
    return F.date_add(date, days)
