"""The three streams bronze -> silver -> gold, which meet only in storage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from haulmetric.operators.decode import decode_flat, decode_nested
from haulmetric.operators.enrich import add_temp_delta, enrich
from haulmetric.operators.joins import flagged_events
from haulmetric.operators.quality import ARRIVAL, dedup_stream, valid_events
from haulmetric.operators.trips import trip_sessions
from haulmetric.operators.windows import window_metrics
from haulmetric.schemas import ENVELOPE, FLAT_SILVER, LAYER_PARTITIONS, SILVER
from haulmetric.settings import DEFAULTS, Settings
from haulmetric.sources.tables import stream_table
from haulmetric.streaming.sinks import append_to_path, drain


def silver_stream(bronze: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    decoded = decode_nested(bronze, keep=ARRIVAL, settings=settings)
    events = dedup_stream(valid_events(decoded, settings.dedup_keys), settings=settings)
    return enrich(events, settings).select(SILVER.names)


def flat_silver_stream(bronze: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    decoded = decode_flat(bronze, keep=ARRIVAL)
    events = dedup_stream(valid_events(decoded, settings.dedup_keys), settings=settings)
    return add_temp_delta(events).select(FLAT_SILVER.names)


def gold_stream(silver: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """A window is emitted once, when the watermark has passed its end."""
    return window_metrics(silver.withWatermark("timestamp", settings.watermark_delay), settings)


def flagged_events_stream(silver: DataFrame, gold: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Flagged windows joined with the events that raised the flag, both as streams.

    Either side waits in state for the other. A window bounds the times of its events and an event
    those of its windows, so each side's watermark drops what can find no partner any more.
    """
    return flagged_events(
        gold.withWatermark("window_end", settings.watermark_delay),
        silver.withWatermark("timestamp", settings.watermark_delay),
        settings,
    )


def trips_stream(silver: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """A trip is emitted once, when the watermark has passed its last event by the gap."""
    return trip_sessions(silver.withWatermark("timestamp", settings.watermark_delay), settings)


def start_bronze(
    bus: DataFrame, settings: Settings = DEFAULTS, *, continuous: bool = False
) -> StreamingQuery:
    return append_to_path(
        bus, settings.place("bronze_path"), settings.place("bronze_checkpoint"),
        settings=settings, continuous=continuous, name="bronze" if continuous else None,
    )


def start_silver(
    spark: SparkSession, settings: Settings = DEFAULTS, *, continuous: bool = False
) -> StreamingQuery:
    bronze = stream_table(spark, settings.place("bronze_path"), ENVELOPE, settings)
    return append_to_path(
        silver_stream(bronze, settings), settings.place("silver_path"), settings.place("silver_checkpoint"),
        settings=settings, partition_by=LAYER_PARTITIONS["silver"],
        continuous=continuous, name="silver" if continuous else None,
    )


def start_gold(
    spark: SparkSession, settings: Settings = DEFAULTS, *, continuous: bool = False
) -> StreamingQuery:
    silver = stream_table(spark, settings.place("silver_path"), SILVER, settings)
    return append_to_path(
        gold_stream(silver, settings), settings.place("gold_path"), settings.place("gold_checkpoint"),
        settings=settings, continuous=continuous, name="gold" if continuous else None,
    )


def run_once(bus: DataFrame, settings: Settings = DEFAULTS) -> None:
    """Move the rows at hand through all three layers, one layer after the other."""
    spark = bus.sparkSession
    drain(start_bronze(bus, settings))
    drain(start_silver(spark, settings))
    drain(start_gold(spark, settings))


def start_all(bus: DataFrame, settings: Settings = DEFAULTS) -> list[StreamingQuery]:
    """Start the three streams side by side, each with its own checkpoint.

    The layer folders must exist: create them with `plans.catalog.bootstrap_tables`, or
    start once with `run_once`. Then wait with `spark.streams.awaitAnyTermination()`.
    """
    spark = bus.sparkSession
    # Queries that ended earlier in this session would end that wait at once.
    spark.streams.resetTerminated()
    return [
        start_bronze(bus, settings, continuous=True),
        start_silver(spark, settings, continuous=True),
        start_gold(spark, settings, continuous=True),
    ]
