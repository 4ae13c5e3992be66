"""Message bodies to typed columns. Works on batch frames and streams."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulmetric.schemas import FLAT_PAYLOAD, NESTED_PAYLOAD
from haulmetric.settings import DEFAULTS, Settings

# Output column -> path in the nested body.
NESTED_COLUMNS = {
    "timestamp": "timestamp",
    "vehicle_id": "vehicleId",
    "ambient_temp": "telemetry.ambientTempC",
    "cargo_temp": "telemetry.cargoContainerTempC",
    "humidity": "telemetry.relativeHumidityPct",
    "vibration": "telemetry.vibrationG",
    "door_status": "telemetry.doorStatus",
    "latitude": "routeContext.latitude",
    "longitude": "routeContext.longitude",
}


def parse_time(text: Column, patterns: Sequence[str]) -> Column:
    """First pattern that fits; NULL, never an error, when none does."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(pattern)) for pattern in patterns])


def _kept(keep: Sequence[str], renamed: Mapping[str, str]) -> list[Column]:
    return [F.col(name).alias(renamed.get(name, name)) for name in keep]


def _computed_once(frame: DataFrame, keep: Sequence[Column], columns: Sequence[Column]) -> DataFrame:
    """Project `columns` so that later filters on them do not repeat their expressions.

    A filter on a plain projection is pushed below it with the expressions inlined: here
    that would parse each body once per filtered column and once more for the projection.
    A one-element `inline` is a boundary such filters stay above.
    """
    return frame.select(*keep, F.inline(F.array(F.struct(*columns))))


def _parsed(
    envelope: DataFrame, schema: T.StructType, keep: Sequence[str], renamed: Mapping[str, str]
) -> DataFrame:
    body = F.from_json(F.col("value").cast("string"), schema)
    return _computed_once(envelope, _kept(keep, renamed), [body.alias("_body")])


def _only(schema: T.StructType, paths: Sequence[str]) -> T.StructType:
    """The part of a payload schema that is read; the parser skips everything else."""
    fields = []
    for field in schema.fields:
        if field.name in paths:
            fields.append(field)
        elif isinstance(field.dataType, T.StructType):
            prefix = field.name + "."
            inner = _only(
                field.dataType, [path[len(prefix):] for path in paths if path.startswith(prefix)]
            )
            if inner.fields:
                fields.append(T.StructField(field.name, inner, field.nullable))
    return T.StructType(fields)


def decode_nested(
    envelope: DataFrame,
    *,
    keep: Sequence[str] = (),
    renamed: Mapping[str, str] | None = None,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """Nine typed columns from nested bodies, behind the envelope columns in `keep`.

    A body that is not JSON gives NULLs, a leaf of another type gives a NULL leaf. `renamed`
    frees names that both sides use, such as `timestamp`.
    """
    renamed = renamed or {}
    schema = _only(NESTED_PAYLOAD, list(NESTED_COLUMNS.values()))
    parsed = _parsed(envelope, schema, keep, renamed)
    columns = []
    for name, path in NESTED_COLUMNS.items():
        leaf = F.col(f"_body.{path}")
        if name == "timestamp":
            leaf = parse_time(leaf, settings.time_patterns)
        columns.append(leaf.alias(name))
    return _computed_once(parsed, [F.col(renamed.get(name, name)) for name in keep], columns)


def decode_flat(
    envelope: DataFrame,
    *,
    keep: Sequence[str] = (),
    renamed: Mapping[str, str] | None = None,
) -> DataFrame:
    """Seven typed columns from the older flat bodies; the JSON reader parses the time."""
    renamed = renamed or {}
    parsed = _parsed(envelope, FLAT_PAYLOAD, keep, renamed)
    return parsed.select(
        *[F.col(renamed.get(name, name)) for name in keep],
        *[F.col(f"_body.{name}").alias(name.lower()) for name in FLAT_PAYLOAD.names],
    )
