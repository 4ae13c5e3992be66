"""Reconciliation of layers: what one layer should hold by the layer before it, and what it does."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmetric.plans.layers import build_silver
from haulmetric.settings import DEFAULTS, Settings


def multiset_difference(expected: DataFrame, found: DataFrame) -> DataFrame:
    """Rows that are in one frame more often than in the other, with `side` and `copies`.

    EXCEPT ALL in both directions at once: each side's rows count +1 or -1, equal rows are added up
    (map-side first, so copies of a row do not meet in one task), and what is not level remains.
    Nulls equal nulls, and NaN equals NaN. The two frames have the same columns.
    """
    names = expected.columns
    sides = expected.withColumn("_n", F.lit(1)).unionByName(found.select(names).withColumn("_n", F.lit(-1)))
    level = sides.groupBy(*names).agg(F.sum("_n").alias("_n")).filter("_n <> 0")
    return level.select(
        F.when(F.col("_n") > 0, "missing").otherwise("unexpected").alias("side"),
        F.abs("_n").alias("copies"),
        *names,
    )


def layer_reconcile(bronze: DataFrame, silver: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Accepted bronze events that silver lacks (`missing`), and silver rows without a source."""
    expected = build_silver(bronze, settings)
    return multiset_difference(expected, silver)
