"""Sliding event-time windows per vehicle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmetric.functions.numeric import exact_mean, present, rounded
from haulmetric.functions.predicates import DOOR_OPEN, window_anomaly
from haulmetric.schemas import FLAT_GOLD, GOLD
from haulmetric.settings import DEFAULTS, Settings

AVERAGED = {
    "avg_cargo_temp": "cargo_temp",
    "avg_ambient_temp": "ambient_temp",
    "avg_dew_point": "dew_point",
}


def _averaged(events: DataFrame) -> dict[str, str]:
    return {name: source for name, source in AVERAGED.items() if source in events.columns}


def _finish(grouped: DataFrame, gold_columns: Sequence[str], settings: Settings) -> DataFrame:
    return (
        grouped.withColumn("window_start", F.col("window.start"))
        .withColumn("window_end", F.col("window.end"))
        .withColumn("anomaly_flag", window_anomaly(settings))
        .select(*gold_columns)
    )


def _gold_columns(events: DataFrame) -> list[str]:
    return GOLD.names if "dew_point" in events.columns else FLAT_GOLD.names


def _max_vibration() -> Column:
    return rounded(F.max(present(F.col("vibration"))))


def window_metrics(events: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Window aggregates straight from events; on a stream, set the watermark first.

    Events of the flat payload have no dew point; their windows end at `anomaly_flag`.
    """
    aggregates = [
        exact_mean(F.col(source)).alias(name)
        for name, source in _averaged(events).items()
    ]
    aggregates += [
        _max_vibration().alias("max_vibration"),
        F.count_if(F.col("door_status") == DOOR_OPEN).alias("door_open_count"),
    ]
    if "condensation_risk" in events.columns:
        aggregates.append(F.count_if("condensation_risk").alias("condensation_risk_count"))
    window = F.window("timestamp", settings.window_length, settings.window_slide)
    grouped = events.groupBy(window.alias("window"), "vehicle_id").agg(*aggregates)
    return _finish(grouped, _gold_columns(events), settings)


def anomaly_windows(gold: DataFrame) -> DataFrame:
    return gold.filter(F.col("anomaly_flag"))
