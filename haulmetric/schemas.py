"""Fixed schemas of the three layers and of the two message payloads."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_BINARY, _STRING, _BOOLEAN = T.BinaryType(), T.StringType(), T.BooleanType()
_INT, _LONG, _DOUBLE, _TIME = T.IntegerType(), T.LongType(), T.DoubleType(), T.TimestampType()

# Raw layer: exactly the columns a Kafka source delivers.
ENVELOPE = _struct(
    ("key", _BINARY),
    ("value", _BINARY),
    ("topic", _STRING),
    ("partition", _INT),
    ("offset", _LONG),
    ("timestamp", _TIME),
    ("timestampType", _INT),
)

# Field names of the nested message body.
NESTED_PAYLOAD = _struct(
    ("eventId", _STRING),
    ("vehicleId", _STRING),
    ("timestamp", _STRING),
    (
        "routeContext",
        _struct(
            ("latitude", _DOUBLE),
            ("longitude", _DOUBLE),
            ("origin", _STRING),
            ("destination", _STRING),
        ),
    ),
    (
        "telemetry",
        _struct(
            ("ambientTempC", _DOUBLE),
            ("cargoContainerTempC", _DOUBLE),
            ("relativeHumidityPct", _DOUBLE),
            ("vibrationG", _DOUBLE),
            ("doorStatus", _STRING),
        ),
    ),
)

# Field names of the older, flat message body.
FLAT_PAYLOAD = _struct(
    ("Timestamp", _TIME),
    ("Vehicle_ID", _STRING),
    ("Ambient_Temp", _DOUBLE),
    ("Cargo_Temp", _DOUBLE),
    ("Humidity", _DOUBLE),
    ("Vibration", _DOUBLE),
    ("Door_Status", _STRING),
)

# Clean layer: one row per accepted event. Spark resolves names without regard to case, so
# SQL written against `Timestamp`, `Vehicle_ID`, `Cargo_Temp`, ... runs unchanged.
SILVER = _struct(
    ("timestamp", _TIME),
    ("vehicle_id", _STRING),
    ("ambient_temp", _DOUBLE),
    ("cargo_temp", _DOUBLE),
    ("humidity", _DOUBLE),
    ("vibration", _DOUBLE),
    ("door_status", _STRING),
    ("temp_delta", _DOUBLE),
    ("latitude", _DOUBLE),
    ("longitude", _DOUBLE),
    ("dew_point", _DOUBLE),
    ("condensation_risk", _BOOLEAN),
)

# Clean layer of the flat payload: stops at the temperature difference.
FLAT_SILVER = T.StructType(SILVER.fields[:8])

# Aggregate layer: one row per vehicle and sliding window.
GOLD = _struct(
    ("window_start", _TIME),
    ("window_end", _TIME),
    ("vehicle_id", _STRING),
    ("avg_cargo_temp", _DOUBLE),
    ("avg_ambient_temp", _DOUBLE),
    ("max_vibration", _DOUBLE),
    ("door_open_count", _LONG),
    ("anomaly_flag", _BOOLEAN),
    ("avg_dew_point", _DOUBLE),
    ("condensation_risk_count", _LONG),
)

# Aggregate layer of the flat payload: stops at the flag.
FLAT_GOLD = T.StructType(GOLD.fields[:8])

LAYER_SCHEMAS = {"bronze": ENVELOPE, "silver": SILVER, "gold": GOLD}
LAYER_PARTITIONS = {"bronze": (), "silver": ("vehicle_id",), "gold": ()}
LAYER_TIMES = {"bronze": "timestamp", "silver": "timestamp", "gold": "window_end"}
