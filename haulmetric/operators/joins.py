"""Joins along time: windows with the events that flagged them, and rows with the last known state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulmetric.functions.numeric import rounded
from haulmetric.functions.predicates import DOOR_OPEN, above, event_anomaly
from haulmetric.operators.fleet import anomaly_events
from haulmetric.settings import DEFAULTS, Settings


def raised_by(settings: Settings = DEFAULTS) -> Column:
    """Which parts of a window's flag an event raised, as text; empty if none.

    Expects a window's aggregates beside the event's readings: a warm event did not raise a flag
    that only an open door explains.
    """
    warm = above(F.col("cargo_temp"), settings.cargo_limit) & above(F.col("avg_cargo_temp"), settings.cargo_limit)
    shaken = above(rounded(F.col("vibration")), settings.vibration_limit)
    parts = (("cargo", warm), ("door", F.col("door_status") == DOOR_OPEN), ("vibration", shaken))
    return F.concat_ws("+", *(F.when(part, F.lit(name)) for name, part in parts))


def flagged_events(gold: DataFrame, silver: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Flagged windows with each event that raised the flag. Batch frames or two streams.

    An event is put beside the starts of its windows, so that the join is on equal (vehicle, start)
    and never compares ranges. Only events that are anomalous by themselves are multiplied. The
    keys spread a busy vehicle over as many tasks as it has windows. The bounds on the event's time
    follow from equal starts; a stream needs them to know which rows can find no partner any more.
    """
    cut = F.window("timestamp", settings.window_length, settings.window_slide).alias("window")
    readings = ("timestamp", "cargo_temp", "vibration", "door_status")
    events = silver.filter(event_anomaly(settings)).select("vehicle_id", cut, *readings)
    events = events.select(F.col("vehicle_id").alias("_vehicle"), F.col("window.start").alias("_start"), *readings)
    windows = gold.filter("anomaly_flag").select("vehicle_id", "window_start", "window_end", "avg_cargo_temp")
    length = F.expr(f"INTERVAL {settings.window_length}")
    met = (
        (F.col("vehicle_id") == F.col("_vehicle"))
        & (F.col("window_start") == F.col("_start"))
        & (F.col("timestamp") >= F.col("window_end") - length)
        & (F.col("timestamp") < F.col("window_end"))
    )
    joined = windows.join(events, met).drop("_vehicle", "_start")
    return joined.withColumn("cause", raised_by(settings)).filter("cause <> ''")


def window_causes(gold: DataFrame, silver: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Per flagged window, the first event that raised the flag and how many did.

    The aggregate has the join's keys, so it needs no shuffle of its own. Of events at one time
    (clean events have none) the least by readings counts.
    """
    readings = ("timestamp", "cause", "cargo_temp", "vibration", "door_status")
    return (
        flagged_events(gold, silver, settings)
        .groupBy("vehicle_id", "window_start", "window_end")
        .agg(F.min(F.struct(*readings)).alias("first"), F.count(F.lit(1)).alias("raising_events"))
        .select(
            "vehicle_id", "window_start", "window_end", F.col("first.timestamp").alias("event_time"),
            *(F.col(f"first.{name}").alias(name) for name in readings[1:]), "raising_events",
        )
    )


def as_of(
    left: DataFrame,
    right: DataFrame,
    key: str,
    time: str,
    values: Sequence[str],
    *,
    found_at: str,
    bucket: str = "1 hour",
) -> DataFrame:
    """Every row of `left` with `values` of the newest row of `right` not later than it.

    Both sides meet in one union, ordered by time within (key, bucket), where the last value is
    carried forward. What was known before a bucket comes from its predecessors' last values: one row
    for each (key, bucket), found by a second pass over these few. So a key with most of the rows
    is dealt to as many tasks as it has buckets, no range is joined, and only equal times compare.

    Rows of `left` without a predecessor get nulls. Null keys are a key; rows of `right` without
    a time are never found, those of `left` find nothing. Of several right rows at one time the
    greatest by `values` counts. `found_at` names the time of the row found.
    """
    value = F.struct(F.col(time).alias(found_at), *values)
    names = left.columns
    row = F.struct(*(F.col(f"`{n}`") for n in names))
    asked = left.select(F.col(key).alias("_key"), F.col(time).alias("_at"), row.alias("_row"))
    known = right.filter(F.col(time).isNotNull()).select(
        F.col(key).alias("_key"), F.col(time).alias("_at"), value.alias("_value")
    )
    both = asked.unionByName(known, allowMissingColumns=True).withColumn(
        "_bucket", F.unix_micros("_at") - F.pmod(F.unix_micros("_at"), _micros(bucket))
    )
    # Only the buckets that ask or know something: as many rows as there are (key, bucket).
    per_bucket = both.groupBy("_key", "_bucket").agg(F.max("_value").alias("_last"))
    earlier = Window.partitionBy("_key").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_bucket.select(
        F.col("_key").alias("_k"), F.col("_bucket").alias("_b"),
        F.last("_last", ignorenulls=True).over(earlier).alias("_carried"),
    )
    here = F.col("_key").eqNullSafe(F.col("_k")) & F.col("_bucket").eqNullSafe(F.col("_b"))
    # Right rows first at equal times, in the order of their values.
    order = (
        Window.partitionBy("_key", "_bucket")
        .orderBy("_at", F.col("_value").isNull(), "_value")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    found = F.coalesce(F.last("_value", ignorenulls=True).over(order), F.col("_carried"))
    return (
        both.join(carried, here)
        .withColumn("_found", F.when(F.col("_at").isNotNull(), found))
        .filter(F.col("_row").isNotNull())
        .select(
            *(F.col("_row").getField(n).alias(n) for n in names),
            *(F.col("_found").getField(n).alias(n) for n in (found_at, *values)),
        )
    )


def _micros(bucket: str) -> Column:
    origin = F.timestamp_seconds(F.lit(0))
    return F.unix_micros(origin + F.expr(f"INTERVAL {bucket}"))


def alert_positions(events: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Alerts with the last known position of their vehicle, and its age in seconds.

    An event may come without a position; the newest one before it then stands in.
    """
    alerts = anomaly_events(events, settings).select(
        "vehicle_id", "timestamp", "cargo_temp", "vibration", "door_status", "condensation_risk"
    )
    positions = events.dropna("any", subset=["latitude", "longitude"])
    found = as_of(
        alerts, positions, "vehicle_id", "timestamp", ("latitude", "longitude"), found_at="position_time"
    )
    age = F.unix_seconds("timestamp") - F.unix_seconds("position_time")
    return found.withColumn("position_age", age)
