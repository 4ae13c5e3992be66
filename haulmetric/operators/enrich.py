"""Derived measures of clean events. Works on batch frames and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmetric.functions.physics import condensation_risk, dew_point, temperature_delta
from haulmetric.settings import DEFAULTS, Settings


def add_temp_delta(events: DataFrame) -> DataFrame:
    return events.withColumn(
        "temp_delta", temperature_delta(F.col("cargo_temp"), F.col("ambient_temp"))
    )


def add_dew_point(events: DataFrame) -> DataFrame:
    return events.withColumn("dew_point", dew_point(F.col("cargo_temp"), F.col("humidity")))


def add_condensation_risk(events: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """On the rounded dew point, which the frame must already have."""
    return events.withColumn(
        "condensation_risk",
        condensation_risk(F.col("cargo_temp"), F.col("dew_point"), settings.condensation_gap),
    )


def enrich(events: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return add_condensation_risk(add_dew_point(add_temp_delta(events)), settings)
