"""Table upkeep as batch jobs. Each writes a new snapshot folder beside the table.

A folder written by a stream carries the sink's own file log, and a downstream stream follows
it; rewriting such a folder in place would break both. Readers switch to a snapshot instead.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulmetric.schemas import LAYER_PARTITIONS, LAYER_SCHEMAS
from haulmetric.session import session_conf, storage_conf
from haulmetric.settings import DEFAULTS, Settings
from haulmetric.sources.tables import read_table


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of the files below a folder, one row per file: their contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "part-*")
        .load(path)
    )
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def compact(
    spark: SparkSession,
    source: str,
    target: str,
    schema: T.StructType,
    settings: Settings = DEFAULTS,
) -> None:
    """Merge small files of an unpartitioned table, without a shuffle.

    The scan itself packs files into splits; with these options a split is as large as a
    target file, and each split is written as one file.
    """
    packing = {
        "spark.sql.files.maxPartitionBytes": str(settings.target_file_bytes),
        "spark.sql.files.openCostInBytes": "0",
        "spark.sql.files.minPartitionNum": "1",
    }
    with session_conf(spark, storage_conf() | packing):
        table = read_table(spark, source, schema, settings.table_format)
        table.write.format(settings.table_format).save(target)


def cluster_by_time(
    spark: SparkSession,
    source: str,
    target: str,
    schema: T.StructType,
    *,
    time: str = "timestamp",
    partition_by: Sequence[str] = (),
    settings: Settings = DEFAULTS,
) -> None:
    """Rewrite a table so that files of a partition hold disjoint time ranges.

    Ranges are cut over (partition columns, time), so a partition value with much of the
    table is spread over many tasks, and a small one stays in one file.
    """
    table = read_table(spark, source, schema, settings.table_format)
    pieces = max(1, math.ceil(stored_bytes(spark, source) / settings.target_file_bytes))
    order = [*partition_by, time]
    writer = (
        table.repartitionByRange(pieces, *order)
        .sortWithinPartitions(*order)
        .write.format(settings.table_format)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with session_conf(spark, storage_conf()):
        writer.save(target)


def retention_tiers(
    table: DataFrame, time: str, horizon: str, as_of: str | None = None
) -> DataFrame:
    """Add `tier`: `hot` within the horizon before `as_of` (default: the newest row), else `archive`."""
    newest = F.lit(as_of).cast("timestamp") if as_of else table.select(F.max(time)).scalar()
    cutoff = newest - F.expr(f"INTERVAL {horizon}")
    return table.withColumn("tier", F.when(F.col(time) >= cutoff, "hot").otherwise("archive"))


def maintain_layers(
    spark: SparkSession, settings: Settings, target_root: str
) -> list[tuple[str, str, str]]:
    """Compact or cluster every layer; one layer's failure does not stop the others.

    Returns (layer, operation, status) with status `done`, `missing` or `failed: <condition>`.
    """
    outcome = []
    for layer, path in settings.layer_paths().items():
        schema, keys = LAYER_SCHEMAS[layer], LAYER_PARTITIONS[layer]
        target = f"{target_root.rstrip('/')}/{layer}"
        operation = "cluster" if keys else "compact"
        try:
            if keys:
                cluster_by_time(
                    spark, path, target, schema, partition_by=keys, settings=settings
                )
            else:
                compact(spark, path, target, schema, settings)
        except AnalysisException as error:
            missing = error.getCondition() == "PATH_NOT_FOUND"
            status = "missing" if missing else f"failed: {error.getCondition()}"
        except PySparkException as error:
            status = f"failed: {error.getCondition()}"
        except Py4JJavaError as error:
            status = f"failed: {error.java_exception.getClass().getSimpleName()}"
        else:
            status = "done"
        outcome.append((layer, operation, status))
    return outcome
