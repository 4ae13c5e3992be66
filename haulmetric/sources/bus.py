"""Message envelopes: the bus as a stream, files standing in for it, and payload encoding."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmetric.schemas import ENVELOPE
from haulmetric.settings import DEFAULTS, Settings


def bus_options(settings: Settings = DEFAULTS) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": settings.bootstrap_servers,
        "subscribe": settings.topic,
        "startingOffsets": settings.starting_offsets,
    }
    if settings.max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(settings.max_offsets_per_trigger)
    return options


def open_bus(
    spark: SparkSession,
    settings: Settings = DEFAULTS,
    *,
    source_format: str = "kafka",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Stream of envelopes from one topic, with the seven columns of `ENVELOPE`.

    The Kafka source needs its connector on the classpath. Any other source that delivers
    the same columns is named by `source_format` and `options`.
    """
    chosen = bus_options(settings) if source_format == "kafka" else {}
    reader = spark.readStream.format(source_format).options(**(chosen | dict(options or {})))
    if source_format != "kafka":
        reader = reader.schema(ENVELOPE)
    return reader.load()


def open_bus_files(spark: SparkSession, path: str, settings: Settings = DEFAULTS) -> DataFrame:
    """The same stream, fed by Parquet files that land in a folder."""
    options = {"path": path}
    if settings.max_files_per_trigger is not None:
        options["maxFilesPerTrigger"] = str(settings.max_files_per_trigger)
    return open_bus(spark, settings, source_format="parquet", options=options)


def encode_payload(*fields: Column | str) -> Column:
    """One message body: the fields as a UTF-8 JSON object, without those that are NULL."""
    return F.to_json(F.struct(*fields)).cast("binary")


def nested_body(
    event_id: Column, time_text: Column, origin: Column, destination: Column
) -> Column:
    """The nested body of a row of readings; the inverse of `decode_nested`."""
    return encode_payload(
        event_id.alias("eventId"),
        F.col("vehicle_id").alias("vehicleId"),
        time_text.alias("timestamp"),
        F.struct(
            "latitude", "longitude", origin.alias("origin"), destination.alias("destination")
        ).alias("routeContext"),
        F.struct(
            F.col("ambient_temp").alias("ambientTempC"),
            F.col("cargo_temp").alias("cargoContainerTempC"),
            F.col("humidity").alias("relativeHumidityPct"),
            F.col("vibration").alias("vibrationG"),
            F.col("door_status").alias("doorStatus"),
        ).alias("telemetry"),
    )


def encode_nested(
    events: DataFrame,
    *,
    event_id: Column | None = None,
    origin: Column | None = None,
    destination: Column | None = None,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """Clean events as message bodies, ready for a bus sink: one binary `value` column."""
    none = F.lit(None).cast("string")
    body = nested_body(
        F.uuid() if event_id is None else event_id,
        F.date_format("timestamp", settings.time_patterns[0]),
        none if origin is None else origin,
        none if destination is None else destination,
    )
    return events.select(body.alias("value"))
