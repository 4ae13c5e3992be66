"""Fleet status: latest state, KPIs, alerts, trails and series over clean events.

The functions take any frame of clean events and look at all of its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulmetric.functions.numeric import MEAN_DIGITS, counted, exact_mean, total_units
from haulmetric.functions.predicates import DOOR_OPEN, event_anomaly
from haulmetric.functions.text import (
    anomaly_message,
    condensation_message,
    vehicle_colour,
    vehicle_slot,
)
from haulmetric.schemas import SILVER
from haulmetric.settings import DEFAULTS, Settings

_STATE = [name for name in SILVER.names if name not in ("timestamp", "vehicle_id", "door_status")]


def _state_with_counts(events: DataFrame) -> DataFrame:
    """Last known value per column and vehicle, and the vehicle's number of events.

    Two levels, so that the pass over the events is a hash aggregate: Spark sorts its input
    when an aggregation buffer holds a string. Door status is therefore a grouping key of
    the first level and becomes a value only in the second, over a few rows per vehicle.
    """
    first = ["count(*) AS events", "max(timestamp) AS timestamp"]
    second = ["sum(events) AS events", "max(timestamp) AS timestamp"]
    for name in _STATE:
        reading = name if name == "condensation_risk" else f"nanvl({name}, null)"
        known_at = f"if({reading} IS NULL, null, timestamp)"
        first += [f"max_by({name}, {known_at}) AS {name}", f"max({known_at}) AS {name}_at"]
        second.append(f"max_by({name}, {name}_at) AS {name}")
    second.append("max_by(door_status, if(door_status IS NULL, null, timestamp)) AS door_status")

    by_door = events.groupBy("vehicle_id", "door_status").agg(*map(F.expr, first))
    return by_door.groupBy("vehicle_id").agg(*map(F.expr, second))


def latest_per_vehicle(events: DataFrame) -> DataFrame:
    """Per vehicle, the newest value of each column that is neither NULL nor NaN."""
    state = _state_with_counts(events).filter(F.col("vehicle_id").isNotNull())
    return state.select(SILVER.names)


def fleet_kpis(events: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """One row: sample size, mean of the latest cargo temperatures, and status counts."""
    has_vehicle = F.col("vehicle_id").isNotNull()
    reading = F.when(has_vehicle, F.col("cargo_temp"))
    # The limit is compared with the unrounded mean.
    limit = F.lit(round(settings.fleet_temp_limit * 10**MEAN_DIGITS)).cast("decimal(19,0)")
    warm = F.coalesce(total_units(reading) > limit * counted(reading), F.lit(False))
    kpis = _state_with_counts(events).agg(
        F.coalesce(F.sum("events"), F.lit(0)).alias("sample_events"),
        exact_mean(reading).alias("avg_cargo_temp"),
        F.count_if(has_vehicle & event_anomaly(settings)).alias("active_anomalies"),
        F.count_if(has_vehicle & F.col("condensation_risk")).alias("condensation_risks"),
        F.count_if(has_vehicle & (F.col("door_status") == DOOR_OPEN)).alias("open_doors"),
        F.when(warm, "alert").otherwise("ok").alias("cargo_temp_status"),
    )

    def status(name: str) -> Column:
        return F.when(F.col(name) > 0, "alert").otherwise("ok").alias(f"{name}_status")

    return kpis.select(
        "*", status("active_anomalies"), status("condensation_risks"), status("open_doors")
    )


def active_anomalies(latest: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return latest.filter(event_anomaly(settings))


def active_condensation(latest: DataFrame) -> DataFrame:
    return latest.filter(F.col("condensation_risk"))


def anomaly_events(events: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Events that are anomalous or at risk of condensation."""
    return events.filter(event_anomaly(settings) | F.col("condensation_risk"))


def alert_feed(latest: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Up to two messages per vehicle, from one pass over the latest states."""
    def alert(kind: str, raised: Column, message: Column) -> Column:
        entry = F.struct(F.lit(kind).alias("kind"), "vehicle_id", message.alias("message"))
        return F.when(raised, entry)

    alerts = F.array_compact(
        F.array(
            alert("anomaly", event_anomaly(settings), anomaly_message()),
            alert("condensation", F.col("condensation_risk"), condensation_message()),
        )
    )
    return latest.select(F.inline(alerts))


def vehicle_totals(events: DataFrame) -> DataFrame:
    return events.groupBy("vehicle_id").agg(
        F.count(F.lit(1)).alias("total_events"), F.max("cargo_temp").alias("max_cargo_temp")
    )


def vehicle_ids(events: DataFrame) -> DataFrame:
    return events.select("vehicle_id").dropna().distinct().orderBy("vehicle_id")


def vehicle_slots(events: DataFrame) -> DataFrame:
    slots = events.select("vehicle_id").dropna().distinct()
    slots = slots.withColumn("slot", vehicle_slot(F.col("vehicle_id")))
    return slots.withColumn("color", vehicle_colour(F.col("slot")))


def select_vehicles(events: DataFrame, vehicles: Sequence[str] | DataFrame | None) -> DataFrame:
    """Keep the given vehicles; no selection, or an empty list, keeps all."""
    if isinstance(vehicles, DataFrame):
        return events.join(vehicles, "vehicle_id", "left_semi")
    return events.filter(F.col("vehicle_id").isin(list(vehicles))) if vehicles else events


def route_trail(
    events: DataFrame,
    vehicles: Sequence[str] | DataFrame | None = None,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """The newest positions of each selected vehicle.

    Rows with a missing value are dropped after the cut, so they use up places in it.
    """
    newest_first = Window.partitionBy("vehicle_id").orderBy(F.col("timestamp").desc())
    trail = (
        select_vehicles(events, vehicles)
        .withColumn("_rank", F.row_number().over(newest_first))
        .filter(F.col("_rank") <= settings.trail_length)
        .select(
            "latitude", "longitude", "vehicle_id", "cargo_temp", "door_status", "vibration",
            "condensation_risk", "timestamp",
        )
        .dropna("any")
    )
    return (
        trail.withColumnsRenamed({"latitude": "lat", "longitude": "lon"})
        .withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))
        .withColumn("color", vehicle_colour(vehicle_slot(F.col("vehicle_id"))))
    )


def map_center(trail: DataFrame, digits: int = 4) -> DataFrame:
    return trail.agg(
        exact_mean(F.col("lat"), digits).alias("lat"), exact_mean(F.col("lon"), digits).alias("lon")
    )


def timeline(events: DataFrame, metric: str) -> DataFrame:
    """One reading per vehicle over time, in plotting order."""
    return events.select("timestamp", "vehicle_id", metric).orderBy("timestamp", "vehicle_id")
