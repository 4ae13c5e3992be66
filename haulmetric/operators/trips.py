"""Trips and door episodes: stretches of a vehicle's events that belong together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulmetric.functions.numeric import present, rounded
from haulmetric.functions.predicates import DOOR_OPEN
from haulmetric.settings import DEFAULTS, Settings


def trip_sessions(events: DataFrame, settings: Settings = DEFAULTS, bucket: str = "1 hour") -> DataFrame:
    """Trips: events of a vehicle with at most `trip_gap` between neighbours. Batch or stream.

    Sessions are merged state: an event opens one of its own, and those that touch become one. On
    a stream, set the watermark first; a trip is then emitted once the watermark has passed
    `trip_gap` after its last event.

    A stored table would bring all events of a vehicle to one task that way. There, stretches are
    found within (vehicle, bucket) first, and only these are merged as sessions, each as long as its
    stretch and the gap. Events without a time belong to no trip; those without a vehicle are one vehicle.
    """
    readings = events.select(
        "vehicle_id", "timestamp", F.col("timestamp").alias("last"), F.lit(1).cast("long").alias("events"),
        present(F.col("cargo_temp")).alias("low"), present(F.col("cargo_temp")).alias("high"),
        present(F.col("vibration")).alias("vibration"),
        F.when(F.col("door_status") == DOOR_OPEN, 1).otherwise(0).cast("long").alias("open"),
    )
    gap: Column | str = settings.trip_gap
    if not events.isStreaming:
        readings, gap = _stretches(readings, settings.trip_gap, bucket), F.col("gap")
    return (
        readings.groupBy("vehicle_id", F.session_window("timestamp", gap).alias("session"))
        .agg(
            F.max("last").alias("trip_end"),
            F.sum("events").alias("events"),
            F.min("low").alias("min_cargo_temp"),
            F.max("high").alias("max_cargo_temp"),
            rounded(F.max("vibration")).alias("max_vibration"),
            F.sum("open").alias("door_open_count"),
        )
        .select(
            "vehicle_id", F.col("session.start").alias("trip_start"), "trip_end", "events",
            "min_cargo_temp", "max_cargo_temp", "max_vibration", "door_open_count",
        )
    )


def _stretches(readings: DataFrame, gap: str, bucket: str) -> DataFrame:
    """Readings with no more than `gap` between them as one row, within (vehicle, bucket)."""
    cut = F.window("timestamp", bucket).getField("start").alias("bucket")
    within = Window.partitionBy("vehicle_id", "bucket").orderBy("timestamp")
    late = F.col("timestamp") > F.lag("timestamp").over(within) + F.expr(f"INTERVAL {gap}")
    numbered = (
        readings.filter(F.col("timestamp").isNotNull())
        .select("*", cut)
        .withColumn("starts", F.coalesce(late, F.lit(True)).cast("int"))
        .withColumn("stretch", F.sum("starts").over(within))
    )
    merged = numbered.groupBy("vehicle_id", "bucket", "stretch").agg(
        F.min("timestamp").alias("timestamp"), F.max("last").alias("last"), F.sum("events").alias("events"),
        F.min("low").alias("low"), F.max("high").alias("high"), F.max("vibration").alias("vibration"),
        F.sum("open").alias("open"),
    )
    end = F.unix_micros(F.col("last") + F.expr(f"INTERVAL {gap}"))
    length = (end - F.unix_micros("timestamp")).cast("string")
    return merged.withColumn("gap", F.concat(length, F.lit(" microseconds")))


def door_episodes(events: DataFrame, bucket: str = "1 hour") -> DataFrame:
    """Stretches of events with the door open: start, last open event, close, length, warmest cargo.

    Gaps and islands in two levels. Within (vehicle, bucket) a running sum of changes of status
    numbers the runs; all but the first and last run of a bucket are final. Those at the edges, two
    for each (vehicle, bucket) at most, are joined across buckets by vehicle. A vehicle with most of
    the events is thus dealt to as many tasks as it has buckets.

    Events without a door status, vehicle or time say nothing and are left out. At one time an open
    door counts as before a closed one. `closed_at` is the first closed event after the episode,
    null while there is none, and `seconds` then runs to the last open event.
    """
    known = events.dropna("any", subset=["vehicle_id", "timestamp", "door_status"]).select(
        "vehicle_id", "timestamp", present(F.col("cargo_temp")).alias("cargo_temp"),
        (F.col("door_status") == DOOR_OPEN).alias("open"),
        F.window("timestamp", bucket).getField("start").alias("bucket"),
    )
    within = Window.partitionBy("vehicle_id", "bucket")
    by_time = within.orderBy("timestamp", F.col("open").desc())
    changed = F.coalesce(F.col("open") != F.lag("open").over(by_time), F.lit(True))
    runs = (
        known.withColumn("changed", changed.cast("int"))
        .withColumn("run", F.sum("changed").over(by_time.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("vehicle_id", "bucket", "run")
        .agg(
            F.first("open").alias("open"),
            F.min("timestamp").alias("opened_at"),
            F.max("timestamp").alias("last_open"),
            F.count(F.lit(1)).alias("events"),
            F.max("cargo_temp").alias("max_cargo_temp"),
        )
        .withColumn("closed_at", F.lead("opened_at").over(within.orderBy("run")))
        .withColumn("is_first", F.col("run") == 1)
        .withColumn("is_last", F.col("closed_at").isNull())
    )
    edge = F.col("is_first") | F.col("is_last")
    inner = runs.filter(~edge & F.col("open"))

    # Runs at edges continue across a border of buckets only, never past a run between them.
    line = Window.partitionBy("vehicle_id").orderBy("bucket", "run")
    continues = F.col("is_first") & F.lag("is_last").over(line) & (F.col("open") == F.lag("open").over(line))
    following = F.coalesce(F.col("closed_at"), F.lead("opened_at").over(line))
    edges = (
        runs.filter(edge)
        .withColumn("starts", (~F.coalesce(continues, F.lit(False))).cast("int"))
        .withColumn("next_at", following)
        .withColumn("run", F.sum("starts").over(line.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("vehicle_id", "run")
        .agg(
            F.first("open").alias("open"),
            F.min("opened_at").alias("opened_at"),
            F.max("last_open").alias("last_open"),
            F.sum("events").alias("events"),
            F.max("max_cargo_temp").alias("max_cargo_temp"),
            # The last run of the stretch knows what follows.
            F.max_by("next_at", "last_open").alias("closed_at"),
        )
        .filter("open")
    )
    columns = ("vehicle_id", "opened_at", "last_open", "closed_at", "events", "max_cargo_temp")
    found = inner.select(*columns).unionByName(edges.select(*columns))
    return found.withColumn("seconds", _seconds(F.coalesce("closed_at", "last_open")) - _seconds(F.col("opened_at")))


def _seconds(time: Column) -> Column:
    return F.unix_seconds(time)
