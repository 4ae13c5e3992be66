"""Derived physical measures of a reading."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from haulmetric.functions.numeric import rounded

# Magnus coefficients over water.
MAGNUS_A = 17.27
MAGNUS_B = 237.7


def temperature_delta(cargo: Column, ambient: Column) -> Column:
    return rounded(cargo - ambient)


def dew_point(temperature: Column, humidity: Column) -> Column:
    """Magnus dew point in °C; NULL where the formula has no value (humidity 0, divisor 0)."""
    a, b = F.lit(MAGNUS_A), F.lit(MAGNUS_B)
    gamma = F.try_divide(a * temperature, b + temperature) + F.ln(humidity / F.lit(100.0))
    return rounded(F.try_divide(b * gamma, a - gamma))


def condensation_risk(temperature: Column, dew: Column, gap: float) -> Column:
    return (temperature - dew) < F.lit(gap)
