"""Aggregate expressions shared by rollups, profiles and KPI tables.

All are algebraic (sum, count, min, max), so Spark combines them map-side before the
shuffle; a group that holds a third of the rows costs one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Below this a double still holds every whole number, and its floor fits a long.
_WHOLE = 2.0 ** 53
_SUM = "decimal(37,9)"


def rows() -> Column:
    return F.count(F.lit(1))


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def _value(amount: str | Column) -> Column:
    return (F.col(amount) if isinstance(amount, str) else amount).cast("double")


def _in_range(value: Column) -> Column:
    return F.abs(value) < _WHOLE


def exact_sum(amount: str | Column) -> Column:
    """Sum of the amounts below 2^53 in size, as a decimal with nine places.

    Sums of doubles depend on the order in which partial sums meet, which differs from run to
    run; on a rounding boundary that shows in the result. So an amount is taken apart into its
    floor and its fraction, the fraction in as many decimal places as a double of its size holds
    (nine below 4 million, six below 4 billion, else three). Both parts are summed as decimals,
    which hold 10^13 rows of the largest amounts. What is left over is in `rest_sum`.
    """
    value = _value(amount)
    floor = F.floor(F.when(_in_range(value), value))
    fraction = value - floor
    size = F.abs(value)
    units = (F.when(size < 4e6, F.rint(fraction * 1e9))
             .when(size < 4e9, F.rint(fraction * 1e6) * 1e3)
             .otherwise(F.rint(fraction * 1e3) * 1e6))
    units = F.when(floor.isNotNull(), units).cast("bigint")
    wholes = F.sum(floor.cast("decimal(20,0)")).cast(_SUM)
    billionths = F.sum(units.cast("decimal(10,0)")).cast("decimal(28,0)")
    return (wholes + (billionths * F.lit("0.000000001").cast("decimal(9,9)")).cast(_SUM)).cast(
        "decimal(38,9)")


def rest_sum(amount: str | Column) -> Column:
    """Sum, as a double, of the amounts that `exact_sum` leaves out: 2^53 and above, infinite
    or not a number. NULL if there are none, as is usual."""
    value = _value(amount)
    return F.sum(F.when(value.isNotNull() & ~_in_range(value), value))


def money_total(exact: Column, rest: Column, digits: int = 2) -> Column:
    """Both sums put together and rounded."""
    return F.when(rest.isNull(), F.round(exact, digits).cast("double")).otherwise(
        F.round(F.coalesce(exact.cast("double"), F.lit(0.0)) + rest, digits))


def money_ratio(exact: Column, rest: Column, count: Column, digits: int = 2) -> Column:
    """The sum of both over a count; NULL if nothing was counted."""
    total = F.when(rest.isNull(), exact.cast("double")).otherwise(
        F.coalesce(exact.cast("double"), F.lit(0.0)) + rest)
    return F.round(total / F.nullif(count, F.lit(0)), digits)


def money_sum(amount: str | Column, digits: int = 2) -> Column:
    return money_total(exact_sum(amount), rest_sum(amount), digits)


def money_mean(amount: str | Column, digits: int = 2) -> Column:
    return money_ratio(exact_sum(amount), rest_sum(amount), F.count(_value(amount)), digits)


def rounded_mean(value: str | Column, digits: int = 2) -> Column:
    """Mean of whole numbers, whose sum is exact as it is."""
    return F.round(F.avg(value), digits)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """100 * part / whole as a double, whatever integer types the two counts have."""
    return F.round(part.cast("double") * 100.0 / whole, digits)
