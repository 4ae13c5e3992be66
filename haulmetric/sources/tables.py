"""Layer tables addressed by path: batch and stream reads, appends, temp views."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from haulmetric.schemas import LAYER_SCHEMAS
from haulmetric.session import session_conf, storage_conf
from haulmetric.settings import DEFAULTS, Settings


def read_table(
    spark: SparkSession, path: str, schema: T.StructType, table_format: str = "parquet"
) -> DataFrame:
    """Batch scan with a declared schema; partition columns keep their declared position."""
    return spark.read.schema(schema).format(table_format).load(path).select(schema.names)


def stream_table(
    spark: SparkSession, path: str, schema: T.StructType, settings: Settings = DEFAULTS
) -> DataFrame:
    """The rows of a table, and those appended later, as a stream."""
    reader = spark.readStream.schema(schema).format(settings.table_format)
    if settings.max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", settings.max_files_per_trigger)
    return reader.load(path).select(schema.names)


def write_table(
    frame: DataFrame,
    path: str,
    *,
    partition_by: Sequence[str] = (),
    mode: str = "append",
    table_format: str = "parquet",
) -> None:
    """Batch write; a partitioned table is first rebalanced on its partition columns.

    Without that step every task would open a file per partition value. Rebalancing leaves
    the sizes to adaptive execution, which splits a value that holds much of the table and
    merges small ones, so a hot vehicle is written by many tasks.
    """
    if partition_by:
        frame = frame.hint("rebalance", *partition_by)
    writer = frame.write.mode(mode).format(table_format)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with session_conf(frame.sparkSession, storage_conf()):
        writer.save(path)


def register_layers(
    spark: SparkSession,
    paths: Mapping[str, str],
    schemas: Mapping[str, T.StructType] = LAYER_SCHEMAS,
    table_format: str = "parquet",
) -> list[str]:
    """Register one temp view per layer that exists, and name those registered.

    Calling it again lists the files anew, so later appends become visible.
    """
    registered = []
    for name, path in paths.items():
        try:
            table = read_table(spark, path, schemas[name], table_format)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            spark.catalog.dropTempView(name)
            continue
        table.createOrReplaceTempView(name)
        registered.append(name)
    return registered
