"""Small builders shared by the tests."""

from __future__ import annotations

import datetime as dt
import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from haulmetric.schemas import ENVELOPE, SILVER

NOON = dt.datetime(2024, 5, 1, 12, 0, 0, tzinfo=dt.timezone.utc)


def at(seconds: float) -> dt.datetime:
    return NOON + dt.timedelta(seconds=seconds)


def body(vehicle="TRK-CHI-0001", seconds=0.0, time=None, **telemetry) -> str:
    readings = {
        "ambientTempC": 20.0, "cargoContainerTempC": 4.0, "relativeHumidityPct": 50.0,
        "vibrationG": 0.1, "doorStatus": "CLOSED",
    }
    readings.update(telemetry)
    return json.dumps(
        {
            "eventId": "e", "vehicleId": vehicle,
            "timestamp": time or at(seconds).strftime("%Y-%m-%d %H:%M:%S"),
            "routeContext": {"latitude": 41.5, "longitude": -88.0, "origin": "a", "destination": "b"},
            "telemetry": readings,
        }
    )


def envelope(spark: SparkSession, bodies: list[str | None], start: int = 0) -> DataFrame:
    rows = [
        (None, None if text is None else text.encode(), "t", 0, start + i, at(i), 0)
        for i, text in enumerate(bodies)
    ]
    return spark.createDataFrame(rows, ENVELOPE)


def clean(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Clean events with the given columns; `seconds` sets the time, all else has a default."""
    base = {
        "vehicle_id": "TRK-CHI-0001", "ambient_temp": 20.0, "cargo_temp": 4.0, "humidity": 50.0,
        "vibration": 0.1, "door_status": "CLOSED", "temp_delta": -16.0, "latitude": 41.5,
        "longitude": -88.0, "dew_point": -5.0, "condensation_risk": False,
    }
    values = []
    for row in rows:
        row = dict(row)
        full = base | {"timestamp": at(row.pop("seconds", 0.0))} | row
        values.append(tuple(full[name] for name in SILVER.names))
    return spark.createDataFrame(values, SILVER)


def data_files(path: str) -> list[Path]:
    return sorted(p for p in Path(path).rglob("*.parquet") if "_spark_metadata" not in p.parts)


def plan_of(frame: DataFrame) -> str:
    """The physical plan as text."""
    return frame._jdf.queryExecution().executedPlan().toString()
