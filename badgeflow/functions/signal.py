"""Signal strength and numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from badgeflow.constants import MEDIUM_BELOW, MISSING_SIGNAL, SIGNAL_LIMIT, WEAK_BELOW


def whole_signal(text: Column) -> Column:
    """Signal text as a whole number, half away from zero; null when it is not a number."""
    return text.try_cast("decimal(38,0)")


def signal_fits(number: Column) -> Column:
    return F.abs(number) < SIGNAL_LIMIT


def stored_signal(number: Column, missing: int = MISSING_SIGNAL) -> Column:
    return F.coalesce(number, F.lit(missing)).try_cast("decimal(5,2)")


def signal_bucket(number: Column) -> Column:
    """WEAK, MEDIUM or STRONG. A missing signal counts as STRONG, as -60 itself does."""
    return (
        F.when(number < WEAK_BELOW, "WEAK")
        .when(number < MEDIUM_BELOW, "MEDIUM")
        .otherwise("STRONG")
    )


def mean_of_decimal(column: Column, scale: int = 2) -> Column:
    """Average of a decimal as a double.

    Sums scaled longs: exact and order-independent, kept in a hash aggregate, and it does not
    overflow where the sum of a decimal(5,2) column would.
    """
    factor = 10**scale
    return F.sum((column * factor).cast("bigint")).cast("double") / (F.count(column) * F.lit(float(factor)))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """``100 * part / whole`` rounded; null when ``whole`` is 0."""
    return F.round(F.try_divide(F.lit(100.0) * part, whole.cast("double")), digits)
