"""Date parsing, ages and calendar keys as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgermill.functions.bands import as_column


def dmy_parts(text: Column | str) -> Column:
    """``D/M/Y`` text cut at the slashes."""
    return F.split(F.trim(as_column(text)), "/")


def date_from_parts(parts: Column | str, last_2000: int) -> Column:
    """Date of the cut parts; two-digit years up to ``last_2000`` are 20xx.

    Works on a column of parts so that a cleaning job cuts each text once.
    """
    parts = as_column(parts)
    raw_year = F.get(parts, F.lit(2))
    year = raw_year.try_cast("int")
    full = F.when(F.length(raw_year) != 2, year).when(year <= last_2000, year + 2000).otherwise(
        year + 1900
    )
    iso = F.concat(
        F.lpad(full.cast("string"), 4, "0"),
        F.lit("-"),
        F.lpad(F.get(parts, F.lit(1)).try_cast("int").cast("string"), 2, "0"),
        F.lit("-"),
        F.lpad(F.get(parts, F.lit(0)).try_cast("int").cast("string"), 2, "0"),
    )
    return F.when(F.size(parts) == 3, iso.try_cast("date"))


TRANSACTION_PIVOT = 49
BIRTH_PIVOT = 50


def parse_dmy(text: Column | str) -> Column:
    """Transaction date: years 00-49 are 20xx, 50-99 are 19xx; bad text is NULL."""
    return date_from_parts(dmy_parts(text), TRANSACTION_PIVOT)


def usable_birth(born: Column | str, text: Column | str, as_of: Column | str) -> Column:
    """A birth date that is no placeholder, after 1900 and before ``as_of``."""
    born, text = as_column(born), as_column(text)
    usable = ~text.contains("1800") & (F.year(born) > 1900) & (born < as_column(as_of))
    return F.when(usable, born)


def parse_dob(text: Column | str, as_of: Column | str) -> Column:
    """Birth date: years 00-50 are 20xx, 51-99 are 19xx; an unusable one is NULL."""
    return usable_birth(date_from_parts(dmy_parts(text), BIRTH_PIVOT), text, as_of)


def _calendar_number(day: Column) -> Column:
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def age_years(born: Column | str, as_of: Column | str) -> Column:
    """Whole years at ``as_of``; the birthday itself counts."""
    gap = _calendar_number(as_column(as_of)) - _calendar_number(as_column(born))
    return F.floor(gap / F.lit(10000)).cast("int")


def day_of(value: Column | str) -> Column:
    """Date of a date, timestamp or text column; unreadable text is NULL."""
    return as_column(value).try_cast("date")


def month_start(day: Column | str) -> Column:
    """First day of the month: the cheap grouping key behind every monthly mart."""
    return F.trunc(as_column(day), "month")


def month_key(day: Column | str) -> Column:
    """``yyyy-MM`` label."""
    return F.date_format(as_column(day), "yyyy-MM")


def shift_days(day: Column | str, offset: Column | int) -> Column:
    return F.date_add(as_column(day), offset)
