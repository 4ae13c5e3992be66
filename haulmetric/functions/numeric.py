"""Rounding and averaging that give the same digits whatever the order of the rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(value: Column, digits: int = 2) -> Column:
    """Half-up rounding; adding zero turns -0.0 into 0.0."""
    return F.round(value, digits) + F.lit(0.0)


def present(reading: Column) -> Column:
    """The reading, with NaN taken as missing."""
    return F.nanvl(reading, F.lit(None).cast("double"))


#: Decimal digits of a reading that count in an average.
MEAN_DIGITS = 9


def parts(reading: Column) -> tuple[Column, Column]:
    """A reading as whole units and 10^-9 units of the rest, both as longs.

    A double sum depends on the order in which partial results meet, so its rounded average
    flips at midpoints from run to run. Whole numbers add up the same in every order, and without
    the cost of decimals. NaN, and what no long holds, count as missing.
    """
    known = F.when(F.abs(reading) < F.lit(2.0**63), reading)
    whole = F.floor(known)
    rest = F.rint((known - whole) * F.lit(10.0**MEAN_DIGITS)).cast("bigint")
    return whole, rest


def units(whole: Column, rest: Column) -> Column:
    """Sums of both parts as one decimal in 10^-9 units; null beyond 28 digits before the point."""
    scale = F.lit(10**MEAN_DIGITS).cast("decimal(10,0)")
    return whole.try_cast("decimal(28,0)") * scale + rest.cast("decimal(19,0)")


def total_units(reading: Column) -> Column:
    """Exact sum in 10^-9 units, as an aggregate.

    Whole units are added up as doubles: exact below 2^53, and a broken sensor's 9e18 can stop no
    job, as it would by the overflow of a long.
    """
    whole, rest = parts(reading)
    return units(F.sum(whole.cast("double")), F.sum(rest))


def counted(reading: Column) -> Column:
    return F.count(parts(reading)[0])


def mean_of(total: Column, rows: Column, digits: int = 2) -> Column:
    """Half-up rounded mean of `rows` readings that add up to `total` units; null for none."""
    rows = F.nullif(rows.cast("decimal(19,0)"), F.lit(0))
    return F.round(F.try_divide(total, rows), digits - MEAN_DIGITS).cast("double") / F.lit(10.0**MEAN_DIGITS) + F.lit(0.0)


def exact_mean(reading: Column, digits: int = 2) -> Column:
    """`round(avg(reading), digits)`, half-up, as one order-independent aggregate."""
    return mean_of(total_units(reading), counted(reading), digits)
