"""Engagement arithmetic.

There are two engagement rates on purpose. The batch reports use
:func:`percent_of` over likes + dislikes + comments, NULL at zero views. The model
uses the smoothed form, likes + comments over views + 1, which is never NULL for
known counters.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent_of(part: Column, whole: Column) -> Column:
    return F.try_divide(part, whole) * 100


def smoothed_percent(part: Column, views: Column) -> Column:
    return F.try_divide(part, views + 1) * 100


def ratio_plus_one(part: Column, whole: Column) -> Column:
    return F.try_divide(part, whole + 1)


def log_scale(c: Column) -> Column:
    return F.log10(c + 1)


def power_of_ten(c: Column) -> Column:
    return F.pow(F.lit(10.0), c)


def growth_percent(predicted: Column, now: Column) -> Column:
    return F.try_divide(predicted - now, now) * 100


def display(c: Column, digits: int) -> Column:
    """Rounding for reports, half to even; operators return unrounded values."""
    return F.bround(c, digits)
