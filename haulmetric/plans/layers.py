"""Batch builds of the clean and aggregate layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from haulmetric.operators.decode import decode_flat, decode_nested
from haulmetric.operators.enrich import add_temp_delta, enrich
from haulmetric.operators.quality import ARRIVAL, first_arrival, valid_events
from haulmetric.operators.windows import window_metrics
from haulmetric.schemas import ENVELOPE, FLAT_SILVER, LAYER_PARTITIONS, SILVER
from haulmetric.settings import DEFAULTS, Settings
from haulmetric.sources.tables import read_table, write_table


def clean_events(bronze: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Decoded, valid, first-arrival events, before any derived measure."""
    decoded = decode_nested(bronze, keep=ARRIVAL, settings=settings)
    valid = valid_events(decoded, settings.dedup_keys)
    return first_arrival(valid, settings.dedup_keys).drop(*ARRIVAL)


def build_silver(bronze: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return enrich(clean_events(bronze, settings), settings).select(SILVER.names)


def build_flat_silver(bronze: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    valid = valid_events(decode_flat(bronze, keep=ARRIVAL), settings.dedup_keys)
    events = first_arrival(valid, settings.dedup_keys)
    return add_temp_delta(events).select(FLAT_SILVER.names)


def build_gold(silver: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return window_metrics(silver, settings)


def write_layers(spark: SparkSession, bronze: DataFrame, settings: Settings) -> None:
    """Write all three layers; each is built from the stored one before it."""
    table_format = settings.table_format
    write_table(bronze, settings.place("bronze_path"), table_format=table_format)
    stored = read_table(spark, settings.place("bronze_path"), ENVELOPE, table_format)
    write_table(
        build_silver(stored, settings),
        settings.place("silver_path"),
        partition_by=LAYER_PARTITIONS["silver"],
        table_format=table_format,
    )
    stored = read_table(spark, settings.place("silver_path"), SILVER, table_format)
    write_table(build_gold(stored, settings), settings.place("gold_path"), table_format=table_format)
