"""Dates in many formats, ages and windows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Formats met in the sources, in the order they are tried (fixed values).
FORMATS = ["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "dd/MM/yyyy", "yyyy MM dd HH mm ss", "dd-MM-yyyy"]


def parse_date(c: Column) -> Column:
    """DATE by the first format that fits; the placeholder 1900-01-01 and anything else is NULL."""
    day = F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in FORMATS]).cast("date")
    return F.nullif(day, F.lit("1900-01-01").cast("date"))


def age_by_days(day: Column, as_of: Column) -> Column:
    """Whole years as days over 365."""
    return F.floor(F.datediff(as_of, day) / 365).cast("int")


def age_by_year(day: Column, as_of: Column) -> Column:
    """Difference of the calendar years."""
    return F.year(as_of) - F.year(day)


def within(day: Column, as_of: Column, days: int) -> Column:
    """Whether a day lies at most so many days before ``as_of``; a missing day doesn't."""
    return F.coalesce(F.datediff(as_of, day).between(0, days), F.lit(False))


def french(day: Column) -> Column:
    return F.date_format(day, "dd/MM/yyyy")
