"""Cross-layer reports: heartbeat, feed lines and the SQL console."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmetric.functions.text import bronze_line, gold_line, shown_time, silver_line
from haulmetric.operators.fleet import anomaly_events, vehicle_totals
from haulmetric.operators.newest import BRONZE_TIES, FLEET_TIES, newest, payload_preview
from haulmetric.schemas import LAYER_SCHEMAS, LAYER_TIMES
from haulmetric.settings import DEFAULTS, Settings
from haulmetric.sources.tables import register_layers


def layer_heartbeat(
    bronze: DataFrame | None, silver: DataFrame | None, gold: DataFrame | None
) -> DataFrame:
    """One row per layer: row count, newest time and, for bronze, the highest offset.

    A layer that is not there yet (None) has 0 rows and no time.
    """
    frames = {"bronze": bronze, "silver": silver, "gold": gold}
    there = next((f for f in frames.values() if f is not None), None)
    if there is None:
        raise ValueError("no layer exists")
    beats = []
    for layer, frame in frames.items():
        if frame is None:
            frame = there.sparkSession.createDataFrame([], LAYER_SCHEMAS[layer])
        offset = F.coalesce(F.max("offset"), F.lit(0)) if layer == "bronze" else F.max(F.lit(None).cast("bigint"))
        totals = frame.agg(
            F.count(F.lit(1)).alias("total"),
            F.max(LAYER_TIMES[layer]).alias("latest"),
            offset.alias("latest_offset"),
        )
        beats.append(
            totals.select(
                F.lit(layer).alias("layer"), "total", shown_time(F.col("latest")).alias("latest"),
                "latest_offset",
            )
        )
    return reduce(DataFrame.unionByName, beats)


def stored_layers(spark: SparkSession, settings: Settings = DEFAULTS) -> dict[str, DataFrame | None]:
    """The layers as they are stored, None for one that does not exist."""
    found = register_layers(spark, settings.layer_paths(), table_format=settings.table_format)
    return {layer: spark.table(layer) if layer in found else None for layer in LAYER_SCHEMAS}


def partition_offsets(bronze: DataFrame) -> DataFrame:
    """Highest offset per topic partition; offsets of different partitions do not compare."""
    return bronze.groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("total"), F.max("offset").alias("latest_offset")
    )


def layer_feed(bronze: DataFrame, silver: DataFrame, gold: DataFrame, k: int = 5) -> DataFrame:
    """The newest k rows of each layer as text lines."""
    def lines(layer: str, frame: DataFrame, ties: tuple[str, ...], text: Column) -> DataFrame:
        return newest(frame, k, LAYER_TIMES[layer], ties).select(
            F.lit(layer).alias("layer"), text.alias("line")
        )

    return (
        lines("bronze", bronze, BRONZE_TIES, bronze_line())
        .unionByName(lines("silver", silver, FLEET_TIES, silver_line()))
        .unionByName(lines("gold", gold, FLEET_TIES, gold_line()))
    )


def console(settings: Settings = DEFAULTS) -> dict[str, Callable[..., DataFrame]]:
    """The console's ready-made reports, as functions of bronze, silver and gold."""

    def anomalies(bronze: DataFrame, silver: DataFrame, gold: DataFrame) -> DataFrame:
        return newest(anomaly_events(silver, settings), 50, "timestamp", FLEET_TIES).select(
            "timestamp", "vehicle_id", "cargo_temp", "dew_point", "humidity", "condensation_risk"
        )

    def latest(bronze: DataFrame, silver: DataFrame, gold: DataFrame) -> DataFrame:
        return newest(silver, 10, "timestamp", FLEET_TIES).select(
            "timestamp", "vehicle_id", "ambient_temp", "cargo_temp", "dew_point", "condensation_risk"
        )

    def windows(bronze: DataFrame, silver: DataFrame, gold: DataFrame) -> DataFrame:
        return newest(gold, 20, "window_end", FLEET_TIES).select(
            "window_start", "window_end", "vehicle_id", "avg_cargo_temp", "avg_dew_point",
            "condensation_risk_count",
        )

    return {
        "vehicle_totals": lambda bronze, silver, gold: vehicle_totals(silver),
        "anomaly_events": anomalies,
        "console_latest_events": latest,
        "console_gold": windows,
        "console_raw": lambda bronze, silver, gold: payload_preview(bronze, 10, 120, "payload_preview"),
    }


def run_sql(spark: SparkSession, text: str, settings: Settings = DEFAULTS) -> DataFrame:
    """Any SQL over the stored layers, whose views are refreshed first."""
    register_layers(spark, settings.layer_paths(), table_format=settings.table_format)
    return spark.sql(text)
