"""Thresholds as boolean columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from haulmetric.settings import DEFAULTS, Settings

DOOR_OPEN = "OPEN"


def above(reading: Column, limit: float) -> Column:
    """Strictly above; a NaN reading is not (Spark alone would order NaN above everything)."""
    return ~F.isnan(reading) & (reading > F.lit(limit))


def event_anomaly(settings: Settings = DEFAULTS) -> Column:
    """Anomaly of a single event: warm cargo, open door or strong vibration."""
    return (
        above(F.col("cargo_temp"), settings.cargo_limit)
        | (F.col("door_status") == DOOR_OPEN)
        | above(F.col("vibration"), settings.vibration_limit)
    )


def window_anomaly(settings: Settings = DEFAULTS) -> Column:
    """Anomaly of a window, on the rounded aggregates; NULL when undecided."""
    return (
        (F.col("avg_cargo_temp") > F.lit(settings.cargo_limit))
        | (F.col("door_open_count") > 0)
        | (F.col("max_vibration") > F.lit(settings.vibration_limit))
    )
