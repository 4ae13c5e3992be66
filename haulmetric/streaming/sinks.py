"""Append sinks with checkpoints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from haulmetric.session import session_conf, state_conf, storage_conf
from haulmetric.settings import DEFAULTS, Settings


def gathered(frame: DataFrame, partition_by: Sequence[str], writers: int | None) -> DataFrame:
    """Bring the rows of each partition value to a few tasks before a partitioned sink.

    Otherwise every task of the stage before it opens a file per value: tasks x values small
    files in each micro-batch. A value still has up to `writers` tasks, by default as many as
    the shuffle has, so that one with most of the batch is written by all of them. (Batch writes
    leave this to adaptive execution, which stateful streams do not have.)
    """
    if writers is None:
        spark = frame.sparkSession
        default = spark.sparkContext.defaultParallelism
        writers = int(spark.conf.get("spark.sql.shuffle.partitions", str(default)))
    share = F.pmod(F.xxhash64(*frame.columns), F.lit(writers))
    return frame.repartition(*partition_by, share)


def _writer(
    frame: DataFrame,
    checkpoint: str,
    *,
    settings: Settings,
    partition_by: Sequence[str],
    continuous: bool,
    name: str | None,
) -> DataStreamWriter:
    if partition_by:
        frame = gathered(frame, partition_by, settings.partition_writers)
    writer = (
        frame.writeStream.format(settings.table_format)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    if continuous:
        writer = writer.trigger(processingTime=settings.trigger_interval)
    else:
        writer = writer.trigger(availableNow=True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if name:
        writer = writer.queryName(name)
    return writer


def append_to_path(
    frame: DataFrame,
    path: str,
    checkpoint: str,
    *,
    settings: Settings = DEFAULTS,
    partition_by: Sequence[str] = (),
    continuous: bool = False,
    name: str | None = None,
) -> StreamingQuery:
    """Start appending a stream to a folder; by default it stops after the rows at hand."""
    writer = _writer(
        frame, checkpoint, settings=settings, partition_by=partition_by,
        continuous=continuous, name=name,
    )
    # A query copies the session's options when it starts.
    spark = frame.sparkSession
    with session_conf(spark, storage_conf() | state_conf(spark, settings)):
        return writer.start(path)


def append_to_table(
    frame: DataFrame,
    table: str,
    checkpoint: str,
    *,
    settings: Settings = DEFAULTS,
    partition_by: Sequence[str] = (),
    continuous: bool = False,
    name: str | None = None,
) -> StreamingQuery:
    """The same into a catalog table, which is created if it does not exist."""
    writer = _writer(
        frame, checkpoint, settings=settings, partition_by=partition_by,
        continuous=continuous, name=name,
    )
    spark = frame.sparkSession
    with session_conf(spark, storage_conf() | state_conf(spark, settings)):
        return writer.toTable(table)


def drain(query: StreamingQuery) -> StreamingQuery:
    """Wait for a query that stops by itself; raises if it failed."""
    query.awaitTermination()
    return query
