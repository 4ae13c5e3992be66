"""Newest-k reports: `ORDER BY time DESC LIMIT k`, with ties broken so that k is exact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmetric.functions.text import preview

BRONZE_TIES = ("partition", "offset")
FLEET_TIES = ("vehicle_id",)


def newest(
    frame: DataFrame, k: int, time: str, ties: Sequence[str], *, by_cutoff: bool = False
) -> DataFrame:
    """Planned as TakeOrderedAndProject: every task sends on at most k rows.

    With `by_cutoff` the time column alone is read first, to find the k-th newest time; that
    time then reaches the main scan as a pushed filter, so that wide columns such as message
    bodies are read only from row groups that hold newest rows. This pays for stored tables
    whose files follow time, not for frames that are costly to compute twice. Rows without a
    time are not listed; no layer holds such rows.
    """
    if by_cutoff:
        times = frame.select(time).orderBy(F.col(time).desc()).limit(k)
        frame = frame.filter(F.col(time) >= times.agg(F.min(time)).scalar())
    return frame.orderBy(F.col(time).desc(), *ties).limit(k)


def bronze_latest(bronze: DataFrame, k: int = 5, *, by_cutoff: bool = False) -> DataFrame:
    return newest(bronze, k, "timestamp", BRONZE_TIES, by_cutoff=by_cutoff).select(
        F.col("value").cast("string").alias("payload"), "timestamp", "partition", "offset"
    )


def payload_preview(
    bronze: DataFrame,
    k: int = 20,
    length: int = 150,
    name: str = "payload",
    *,
    by_cutoff: bool = False,
) -> DataFrame:
    return newest(bronze, k, "timestamp", BRONZE_TIES, by_cutoff=by_cutoff).select(
        "timestamp", "partition", "offset", preview(F.col("value"), length).alias(name)
    )


def silver_recent(silver: DataFrame, k: int = 500, *, by_cutoff: bool = False) -> DataFrame:
    return newest(silver, k, "timestamp", FLEET_TIES, by_cutoff=by_cutoff)


def silver_latest(silver: DataFrame, k: int = 5, *, by_cutoff: bool = False) -> DataFrame:
    return silver_recent(silver, k, by_cutoff=by_cutoff).select(
        "timestamp", "vehicle_id", "ambient_temp", "cargo_temp", "temp_delta", "door_status"
    )


def gold_recent(gold: DataFrame, k: int = 100, *, by_cutoff: bool = False) -> DataFrame:
    return newest(gold, k, "window_end", FLEET_TIES, by_cutoff=by_cutoff)


def gold_latest(gold: DataFrame, k: int = 10, *, by_cutoff: bool = False) -> DataFrame:
    return gold_recent(gold, k, by_cutoff=by_cutoff).select(
        "window_start", "window_end", "vehicle_id", "avg_cargo_temp", "max_vibration",
        "door_open_count", "anomaly_flag",
    )
