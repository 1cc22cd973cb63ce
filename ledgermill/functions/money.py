"""Money, ratios and means whose value does not depend on row order.

A sum of doubles changes in its last digits with the order of the rows, so two
runs of one job would differ. Money is therefore summed as whole paise in a
BIGINT (as cheap as a double sum, and combined on the map side), and turned
back into rupees once per group. Amounts are held to the paisa: a finer amount
is rounded in its row. One group holds up to 92 quadrillion rupees; beyond that
ANSI mode raises.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgermill.functions.bands import as_column

RATE_UNITS = 1_000_000
MEAN_UNITS = 1_000_000_000


def whole(value: Column, kind: str) -> Column:
    """Rounded to a whole number of the given type; NULL only for NULL and NaN."""
    return F.rint(F.nanvl(value.cast("double"), F.lit(None).cast("double"))).cast(kind)


def paise(amount: Column | str) -> Column:
    """Whole paise; NaN counts as missing, an amount beyond the range raises."""
    return whole(as_column(amount) * 100, "bigint")


def rupees(units: Column | str) -> Column:
    return as_column(units) / F.lit(100)


def sum_money(amount: Column | str) -> Column:
    """Exact sum of an amount, in rupees."""
    return rupees(F.sum(paise(amount)))


def mean_money(amount: Column | str) -> Column:
    """Exact mean of an amount, in rupees, over its non-null values."""
    units = paise(amount)
    return F.sum(units).cast("double") / (F.count(units) * 100)


def mean_rate(rate: Column | str) -> Column:
    """Mean of an interest rate held to six decimals."""
    units = whole(as_column(rate) * RATE_UNITS, "bigint")
    return F.sum(units).cast("double") / (F.count(units) * RATE_UNITS)


def mean_ratio(ratio: Column | str) -> Column:
    """Mean of a computed ratio held to nine decimals."""
    units = whole(as_column(ratio) * MEAN_UNITS, "decimal(28,0)")
    return F.sum(units).cast("double") / (F.count(units) * MEAN_UNITS)


def safe_ratio(
    numerator: Column | str, denominator: Column | str, default: float | None = 0.0
) -> Column:
    """``numerator / denominator`` where the denominator is positive, else the default."""
    below = as_column(denominator)
    return F.when(below > 0, as_column(numerator) / below).otherwise(
        F.lit(default).cast("double")
    )


def plain_ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Unguarded ratio; a zero denominator gives NULL."""
    return F.try_divide(as_column(numerator), as_column(denominator))


def number_or(value: Column | str, default: float | None = 0.0) -> Column:
    """Text to double; unreadable text takes the default."""
    number = F.nanvl(as_column(value).try_cast("double"), F.lit(None).cast("double"))
    return number if default is None else F.coalesce(number, F.lit(float(default)))


def as_crore(amount: Column | str) -> Column:
    """Display text in crore, two decimals; NULL stays NULL."""
    crore = as_column(amount) / F.lit(10000000.0)
    return F.when(crore.isNotNull(), F.format_string("₹%.2f Cr", crore))


def as_rupees(amount: Column | str) -> Column:
    """Display text with thousands separators, two decimals."""
    return F.concat(F.lit("₹"), F.format_number(as_column(amount), 2))


def as_percent(ratio: Column | str, decimals: int = 1) -> Column:
    """Display text in percent; NULL stays NULL."""
    percent = as_column(ratio) * F.lit(100.0)
    return F.when(percent.isNotNull(), F.format_string(f"%.{decimals}f%%", percent))
