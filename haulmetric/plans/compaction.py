"""Incremental compaction: small files of a table are merged in place, the others left alone.

Files are chosen by the hidden `_metadata` column. A filter on it is applied while Spark lists
the files, so files of target size are neither opened nor read. Merged files are first written to
a folder beside the data that readers skip; only when all of them are there do they take the place
of the old ones. A run that is cut off is finished, or undone, by the next.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulmetric.session import session_conf, storage_conf
from haulmetric.settings import DEFAULTS, Settings
from haulmetric.sources.files import Files, refuse_streamed

#: Readers skip names that start with an underscore.
STAGING = "_merged-"


@dataclass(frozen=True)
class Compaction:
    files_merged: int
    files_written: int


def small_files(table: DataFrame, limit: int) -> DataFrame:
    """Rows (file, folder, bytes) of files below `limit` bytes that share a folder with another such file.

    Only the footers of small files are read.
    """
    found = (
        table.filter(F.col("_metadata.file_size") < limit)
        .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))
        .distinct()
        .withColumn("folder", F.regexp_replace("file", "/[^/]*$", ""))
    )
    several = found.groupBy("folder").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("folder")
    return found.join(several, "folder", "left_semi")


def compact_small_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    partition_by: Sequence[str] = (),
    settings: Settings = DEFAULTS,
) -> Compaction:
    """Merge files below half the target size, folder by folder.

    The driver holds the names of the small files, a part of the listing that any scan of the table
    makes it hold. Readers that start while the files change places may see rows twice or not at
    all, so run it when the table is quiet; streams that append to it are refused. A second run
    finds at most one small file in each folder and writes nothing.
    """
    path = path.rstrip("/")
    files = Files(spark, path)
    refuse_streamed(files, path)
    finish(spark, path)
    reader = spark.read.schema(schema).format(settings.table_format)
    chosen = small_files(reader.load(path), settings.target_file_bytes // 2).collect()
    if not chosen:
        return Compaction(0, 0)

    staging = f"{path}/{STAGING}{uuid.uuid4().hex}"
    # `_metadata` gives paths as URIs.
    rows = reader.option("basePath", path).load([unquote(r.file) for r in chosen]).select(schema.names)
    packing = {
        "spark.sql.files.maxPartitionBytes": str(settings.target_file_bytes),
        "spark.sql.files.openCostInBytes": "0",
        "spark.sql.files.minPartitionNum": "1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(settings.target_file_bytes),
    }
    if partition_by:
        # A value's rows meet in one task, or in several where they fill several files.
        rows = rows.hint("rebalance", *partition_by)
    with session_conf(spark, storage_conf() | packing):
        writer = rows.write.format(settings.table_format)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.save(f"{staging}/new")
    # The list of old files is complete before any of them goes.
    spark.createDataFrame([(r.file,) for r in chosen], "file string").coalesce(1).write.text(f"{staging}/old")
    written = finish(spark, path)
    return Compaction(len(chosen), written)


def finish(spark: SparkSession, path: str) -> int:
    """Put merged files in their place; returns how many. A folder without its list of old files
    was cut off while it was written, and is dropped."""
    files = Files(spark, path)
    moved = 0
    for name in files.names(path):
        if not name.startswith(STAGING):
            continue
        staging = f"{path}/{name}"
        if files.exists(f"{staging}/old/_SUCCESS"):
            old = [r.value for r in spark.read.text(f"{staging}/old").collect()]
            files.delete_all(unquote(f) for f in old)
            moved += _place(files, f"{staging}/new", path)
        files.delete(staging)
    return moved


def _place(files: Files, source: str, target: str) -> int:
    moved = 0
    for name in files.names(source):
        if name.startswith(("_", ".")):
            continue
        if name.startswith("part-"):
            files.move(f"{source}/{name}", f"{target}/{name}")
            moved += 1
        else:
            files.make(f"{target}/{name}")
            moved += _place(files, f"{source}/{name}", f"{target}/{name}")
    return moved
