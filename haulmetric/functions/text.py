"""Display text: previews, feed lines, alert messages and the colour of a vehicle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MISSING = "N/A"
_MINUTE_LINE = "yyyy-MM-dd HH:mm:ss"

# One colour per slot, in slot order.
PALETTE = (
    "#00d2ff",
    "#ff6b6b",
    "#2ed573",
    "#a55eea",
    "#fed330",
    "#ff4b91",
    "#1dd1a1",
    "#4b7bec",
    "#fa8231",
    "#26de81",
)


def shown(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(MISSING))


def shown_time(value: Column) -> Column:
    return F.coalesce(F.date_format(value, _MINUTE_LINE), F.lit(MISSING))


def preview(payload: Column, length: int) -> Column:
    """The first characters of a binary message body, for display."""
    return F.substring(payload.cast("string"), 1, length)


def _line(*parts: str | Column) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))


def bronze_line(length: int = 110) -> Column:
    return _line(
        "raw #", shown(F.col("offset")), " at ", shown_time(F.col("timestamp")), ": ",
        F.coalesce(preview(F.col("value"), length), F.lit("")),
    )


def silver_line() -> Column:
    return _line(
        "event of ", shown(F.col("vehicle_id")), " at ", shown_time(F.col("timestamp")),
        ": cargo ", shown(F.col("cargo_temp")), " C (", shown(F.col("temp_delta")),
        " to outside), door ", shown(F.col("door_status")),
    )


def gold_line() -> Column:
    return _line(
        "window of ", shown(F.col("vehicle_id")), " from ", F.date_format("window_start", "HH:mm:ss"),
        " to ", F.date_format("window_end", "HH:mm:ss"),
        ": mean cargo ", shown(F.col("avg_cargo_temp")), " C, flagged ", shown(F.col("anomaly_flag")),
    )


def anomaly_message() -> Column:
    return _line(
        F.col("vehicle_id"), " out of range: cargo ", shown(F.col("cargo_temp")),
        " C, vibration ", shown(F.col("vibration")), " g, door ", shown(F.col("door_status")),
    )


def condensation_message() -> Column:
    return _line(
        F.col("vehicle_id"), " close to its dew point: cargo ", shown(F.col("cargo_temp")),
        " C, dew point ", shown(F.col("dew_point")), " C, humidity ", shown(F.col("humidity")), " percent",
    )


def vehicle_slot(vehicle: Column) -> Column:
    """Stable colour slot: the trailing number less one, else a hash of the id."""
    number = F.element_at(F.split(vehicle, "-"), -1).try_cast("bigint") - F.lit(1)
    return F.pmod(F.coalesce(number, F.crc32(vehicle.cast("binary"))), F.lit(len(PALETTE))).cast("int")


def vehicle_colour(slot: Column) -> Column:
    return F.element_at(F.array(*[F.lit(colour) for colour in PALETTE]), slot + 1)
