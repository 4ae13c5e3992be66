"""Deterministic telemetry derived from an `events` table.

Used by the registered queries and the tests. Time is compressed so that one-minute windows
fill up, users fold into thirteen vehicles on three partitions, and a few rows are made unusable
on purpose: no vehicle, a time in another pattern, or a body that is not JSON. Readings have up
to five decimals and some are missing; one vehicle has no number, and one falls silent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulmetric.sources.bus import nested_body

TOPIC = "fleet-telemetry"
EPOCH_MICROS = 1_704_067_200_000_000  # 2024-01-01 00:00:00 UTC
TIME_COMPRESSION = 120

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


# Columns as SQL: one call to the JVM each, where a chain of column functions makes dozens.
_K = "cast(get_json_object(props, '$.k') AS int)"
_SECOND = (
    f"{EPOCH_MICROS // 1_000_000} + (unix_micros(cast(ts AS timestamp)) - {EPOCH_MICROS})"
    f" div {TIME_COMPRESSION * 1_000_000}"
)
# Vehicle 12 is silent from the tenth day on; the thirteenth has no number.
_NUMBER = "if(user_id % 13 = 11 AND ts >= timestamp_ntz'2024-01-10', 1, user_id % 13 + 1)"
_VEHICLE = (
    f"if({_NUMBER} = 13, 'TRK-CHI-SPARE', "
    f"concat('TRK-CHI-', lpad(cast({_NUMBER} AS string), 4, '0')))"
)
_CARGO = (
    "1.5D + floor(value / 5) * 0.25D + event_id % 11 * 0.00046D + if(user_id % 13 IN (2, 5), 7.0D, 0.0D)"
)


def readings(events: DataFrame) -> DataFrame:
    """One row of typed sensor values per event; `event_time` has whole seconds."""
    return events.selectExpr(
        "event_id",
        "cast(ts AS timestamp) AS broker_time",
        f"timestamp_seconds({_SECOND}) AS event_time",
        f"if(event_id % 97 = 0, null, {_VEHICLE}) AS vehicle_id",
        f"15.0D + {_K} * 0.25D AS ambient_temp",
        f"if(event_id % 59 = 0, null, {_CARGO}) AS cargo_temp",
        "cast(if(user_id % 3 = 0, 92 + event_id % 5, 10 + event_id * 7 % 86) AS double) AS humidity",
        "event_id * 7 % 26 * 0.125D AS vibration",
        f"if(event_type = 'error' AND {_K} < 10, 'OPEN', 'CLOSED') AS door_status",
        "if(event_id % 53 = 0, null, 41.5D + event_id % 512 / 1024.0D) AS latitude",
        "if(event_id % 53 = 0, null, -88.25D + event_id % 256 / 512.0D) AS longitude",
    )


def _envelope(rows: DataFrame, body: Column) -> DataFrame:
    """Wrap bodies; some are replaced by one that is not JSON."""
    return rows.withColumn("_body", body).selectExpr(
        "cast(null AS binary) AS key",
        "if(event_id % 89 = 0, cast('{bad json' AS binary), _body) AS value",
        f"'{TOPIC}' AS topic",
        "cast(event_id % 3 AS int) AS partition",
        "event_id AS offset",
        "broker_time AS timestamp",
        "0 AS timestampType",
    )


def nested_envelope(events: DataFrame) -> DataFrame:
    """Envelopes with nested bodies, with the three kinds of unusable rows."""
    time_text = F.expr(
        """date_format(event_time, if(event_id % 101 = 0,
           "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd HH:mm:ss"))"""
    )
    body = nested_body(
        F.expr("concat('evt-', event_id)"), time_text, F.lit("North Depot"), F.lit("South Hub")
    )
    return _envelope(readings(events), body)


def flat_envelope(events: DataFrame) -> DataFrame:
    """Envelopes with the older flat bodies; their times are ISO-8601 with `Z`."""
    body = F.expr(
        """cast(to_json(named_struct(
             'Timestamp', date_format(event_time, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
             'Vehicle_ID', vehicle_id,
             'Ambient_Temp', ambient_temp,
             'Cargo_Temp', cargo_temp,
             'Humidity', humidity,
             'Vibration', vibration,
             'Door_Status', door_status)) AS binary)"""
    )
    return _envelope(readings(events), body)
