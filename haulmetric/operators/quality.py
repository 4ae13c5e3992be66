"""Which decoded events enter the clean layer."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulmetric.settings import DEFAULTS, Settings

ARRIVAL = ("partition", "offset")


def is_valid(*required: str) -> Column:
    return reduce(and_, [F.col(name).isNotNull() for name in required])


def valid_events(decoded: DataFrame, required: Sequence[str] = DEFAULTS.dedup_keys) -> DataFrame:
    return decoded.filter(is_valid(*required))


def rejected_events(decoded: DataFrame, required: Sequence[str] = DEFAULTS.dedup_keys) -> DataFrame:
    return decoded.filter(~is_valid(*required))


def first_arrival(
    events: DataFrame,
    keys: Sequence[str] = DEFAULTS.dedup_keys,
    arrival: Sequence[str] = ARRIVAL,
) -> DataFrame:
    """Batch dedup: per key, the row that arrived first.

    `row_number() = 1` makes Spark cut each key to one row inside every task before the
    shuffle (WindowGroupLimit), so a key with many copies does not load one reducer.
    """
    order = Window.partitionBy(*keys).orderBy(*arrival)
    ranked = events.withColumn("_rank", F.row_number().over(order))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def dedup_stream(
    events: DataFrame,
    *,
    settings: Settings = DEFAULTS,
    arrival: Sequence[str] = ARRIVAL,
) -> DataFrame:
    """Streaming dedup within the watermark; late rows are dropped.

    Mode "exact": per key the row that arrived first, by its place in the bus and whatever the
    order of reading, as soon as the watermark has passed the key's time. It is one aggregate
    with one state store, and copies of a hot key are combined map-side before the shuffle.
    Mode "fast": a key's first copy to be read, emitted at once.
    """
    keys = list(settings.dedup_keys)
    marked = events.withWatermark("timestamp", settings.watermark_delay)
    if settings.dedup_mode == "fast":
        return marked.dropDuplicates(keys)
    if settings.dedup_mode != "exact":
        raise ValueError(f"dedup_mode is exact or fast, not {settings.dedup_mode}")
    rest = [name for name in events.columns if name not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*arrival)).alias("_first")
    return marked.groupBy(*keys).agg(first).select(*keys, "_first.*").select(events.columns)
