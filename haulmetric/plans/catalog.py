"""Catalog work: create the layer tables and list their columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from haulmetric.schemas import LAYER_PARTITIONS, LAYER_SCHEMAS
from haulmetric.settings import DEFAULTS, Settings


def _ddl(layer: str, table: str, path: str, table_format: str) -> str:
    columns = ", ".join(
        f"`{field.name}` {field.dataType.simpleString()}" for field in LAYER_SCHEMAS[layer].fields
    )
    keys = LAYER_PARTITIONS[layer]
    partitioned = f"PARTITIONED BY ({', '.join(keys)})" if keys else ""
    return (
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING {table_format} "
        f"{partitioned} LOCATION '{path}'"
    )


def bootstrap_tables(spark: SparkSession, settings: Settings = DEFAULTS) -> list[str]:
    """Create database and external tables that do not exist yet; returns the table names."""
    paths = settings.layer_paths()
    tables = settings.layer_tables()
    for layer, table in tables.items():
        database = table.rpartition(".")[0]
        if database:
            parent = paths[layer].rstrip("/").rpartition("/")[0]
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{parent}'")
        spark.sql(_ddl(layer, table, paths[layer], settings.table_format))
    return list(tables.values())


def schema_explorer(spark: SparkSession, layers: dict[str, str]) -> DataFrame:
    """(layer, position, column, type) of each layer whose view or table exists."""
    rows = [
        (layer, position, field.name, field.dataType.simpleString())
        for layer, name in layers.items()
        if spark.catalog.tableExists(name)
        for position, field in enumerate(spark.table(name).schema.fields)
    ]
    return spark.createDataFrame(rows, "layer string, position int, column string, type string")
