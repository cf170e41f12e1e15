"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_from_int(c: Column | str) -> Column:
    """yyyymmdd integer to date; null when it names no calendar day.

    Arithmetic instead of a text pattern: several times cheaper per row. Counting days
    on from the first of the month leaves the month exactly when the day is not in it.
    """
    n = _col(c)
    year, month, day = F.floor(n / 10000).cast("int"), F.floor(n / 100).cast("int") % 100, n % 100
    known = year.between(1000, 9999) & month.between(1, 12) & day.between(1, 31)
    counted = F.when(known, F.date_add(F.make_date(year, month, F.lit(1)), (day - 1).cast("int")))
    return F.when(F.month(counted) == month, counted)


def int_from_date(c: Column | str) -> Column:
    c = _col(c)
    return F.year(c) * 10000 + F.month(c) * 100 + F.day(c)


def utc_timestamp(c: Column | str) -> Column:
    """Zone-less timestamp read as UTC, whatever the session zone (watermarks need an instant)."""
    c = _col(c)
    minutes = (F.unix_date(c.cast("date")).cast("long") * 24 + F.hour(c)) * 60 + F.minute(c)
    seconds = F.date_part(F.lit("SECOND"), c)
    return F.timestamp_micros((minutes * 60000000 + seconds * 1000000).cast("long"))


def utc_midnight(c: Column | str) -> Column:
    """Date to the instant at which it starts in UTC."""
    return F.timestamp_seconds(F.unix_date(_col(c)).cast("long") * 86400)


def utc_date(c: Column | str) -> Column:
    """Calendar day in UTC of an instant, whatever the session zone."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(_col(c)) / 86400).cast("int"))
