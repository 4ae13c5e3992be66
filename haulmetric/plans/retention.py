"""Tiered retention: rows past their horizon move from a hot folder to an archive.

Both folders are partitioned by a piece of time, day or hour, cut from the layer's own time
column. Everything here works by partition: the scan for old rows is pruned to partitions that can
hold any, partitions that are old as a whole are dropped from the hot folder without being
rewritten, and the one on the cutoff is replaced by dynamic partition overwrite. Partitions that do
not change are neither read nor written.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulmetric.schemas import GOLD, LAYER_TIMES
from haulmetric.session import session_conf, storage_conf
from haulmetric.settings import DEFAULTS, Settings
from haulmetric.sources.files import Files, refuse_streamed
from haulmetric.sources.tables import read_table

#: Partition column and the patterns of its values, which sort like the times they stand for.
PIECE = "piece"
PATTERNS = {"day": "yyyy-MM-dd", "hour": "yyyy-MM-dd-HH"}


@dataclass(frozen=True)
class Tier:
    """A layer in two folders: `keys` tell its rows apart, `time` ages them."""

    hot: str
    archive: str
    schema: T.StructType
    time: str
    keys: Sequence[str]
    unit: str = "day"

    def piece(self, time: Column) -> Column:
        return F.date_format(time, PATTERNS[self.unit])


def write_tier(rows: DataFrame, path: str, tier: Tier, settings: Settings = DEFAULTS) -> None:
    """Replace the partitions that `rows` has, and no others."""
    dated = rows.withColumn(PIECE, tier.piece(F.col(tier.time))).hint("rebalance", PIECE)
    writer = dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    with session_conf(rows.sparkSession, storage_conf()):
        writer.format(settings.table_format).partitionBy(PIECE).save(path)


def read_tier(spark: SparkSession, path: str, tier: Tier, settings: Settings = DEFAULTS) -> DataFrame:
    """The rows with their partition, none for a folder that does not exist."""
    schema = T.StructType([*tier.schema.fields, T.StructField(PIECE, T.StringType())])
    try:
        return spark.read.schema(schema).format(settings.table_format).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def publish(rows: DataFrame, tier: Tier, settings: Settings = DEFAULTS) -> None:
    """Bring the hot folder up to date with a layer that grows in order of time, as a stream's does.

    Only the newest partition and those after it are written; what was moved away stays away.
    """
    spark = rows.sparkSession
    newest = read_tier(spark, tier.hot, tier, settings).agg(F.max(PIECE)).first()[0]
    if newest is not None:
        # The pattern's own time, so that the filter reaches the layer's scan as one on time.
        start = F.to_timestamp(F.lit(newest), PATTERNS[tier.unit])
        rows = rows.filter(F.col(tier.time) >= F.lit(spark.range(1).select(start).first()[0]))
    write_tier(rows, tier.hot, tier, settings)


def gold_tier(root: str) -> Tier:
    return Tier(f"{root}/hot", f"{root}/archive", GOLD, LAYER_TIMES["gold"], ("vehicle_id", "window_start"))


def retain_gold(spark: SparkSession, root: str, settings: Settings = DEFAULTS) -> list[tuple[str, int]]:
    """Publish the gold layer below `root` by date and move what is past `gold_horizon`."""
    tier = gold_tier(root.rstrip("/"))
    gold = read_table(spark, settings.place("gold_path"), GOLD, settings.table_format)
    publish(gold, tier, settings)
    return move_expired(spark, tier, settings.gold_horizon, settings=settings)


def move_expired(
    spark: SparkSession,
    tier: Tier,
    horizon: str,
    as_of: dt.datetime | str | None = None,
    settings: Settings = DEFAULTS,
) -> list[tuple[str, int]]:
    """Move rows older than `horizon` before `as_of` (default: the newest hot row).

    Returns (partition, rows moved), empty if nothing was old enough; then nothing is written.
    Rows reach the archive before they leave the hot folder. A run that was cut off in between
    leaves them in both, and the next run moves them again: an archived row gives way to a moved
    one with the same keys, so none is doubled. Rows without a time stay hot.
    """
    files = Files(spark, tier.hot)
    refuse_streamed(files, tier.hot)
    hot, time = read_tier(spark, tier.hot, tier, settings), F.col(tier.time)
    if as_of is None:
        # The newest row lies in the newest partition that has rows.
        latest = hot.agg(F.max(PIECE)).first()[0]
        as_of = hot.filter(F.col(PIECE) == F.lit(latest)).agg(F.max(tier.time)).first()[0]
    cutoff = F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {horizon}")
    cutoff, last = spark.range(1).select(cutoff, tier.piece(cutoff)).first()
    if cutoff is None:
        return []
    # A filter on the partition column, so that younger partitions are not listed.
    old = hot.filter((F.col(PIECE) <= F.lit(last)) & (time < F.lit(cutoff)))
    moved = sorted((r[0], r[1]) for r in old.groupBy(PIECE).count().collect())
    if not moved:
        return []
    pieces = [name for name, _ in moved]
    there = read_tier(spark, tier.archive, tier, settings).filter(F.col(PIECE).isin(pieces))
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"m.{k}")) for k in tier.keys]
    kept = there.alias("a").join(old.alias("m"), same, "left_anti")
    columns = tier.schema.names
    write_tier(old.select(columns).unionByName(kept.select(columns)), tier.archive, tier, settings)

    if pieces[-1] == last:
        young = hot.filter((F.col(PIECE) == F.lit(last)) & ((time >= F.lit(cutoff)) | time.isNull()))
        # No young rows, no partition to overwrite: it is dropped with the others.
        if not young.isEmpty():
            write_tier(young.select(columns), tier.hot, tier, settings)
            pieces = pieces[:-1]
    files.delete_all(f"{tier.hot}/{PIECE}={name}" for name in pieces)
    return moved
