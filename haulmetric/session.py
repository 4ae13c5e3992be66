"""Session building, temporary settings and scratch folders."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from haulmetric.settings import DEFAULTS, Settings

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def build_session(
    app_name: str, settings: Settings = DEFAULTS, extra: dict[str, str] | None = None
) -> SparkSession:
    """Session with the settings every job here expects; master and memory stay the caller's."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", settings.time_zone)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Call sites for every column expression cost more driver time than the expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_time_zone(spark: SparkSession, settings: Settings = DEFAULTS) -> None:
    """Event times carry no offset, so their meaning is the session zone: pin it."""
    spark.conf.set("spark.sql.session.timeZone", settings.time_zone)


@contextmanager
def session_conf(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Set runtime options for the duration of one action."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def storage_conf() -> dict[str, str]:
    """Options every write needs: Spark's default INT96 times carry no min/max statistics,
    and without those no reader can skip files or row groups by time."""
    return {"spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS"}


def state_conf(spark: SparkSession, settings: Settings = DEFAULTS) -> dict[str, str]:
    """Options a stateful query freezes into its checkpoint at the first start.

    State partitions: the setting, else what the session says, else one per core. Spark's own
    200 are too few for a large cluster and slow on a small one.
    """
    key = "spark.sql.shuffle.partitions"
    # Sessions of a busy vehicle are merged within each task before the shuffle.
    values = {"spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true"}
    if settings.state_partitions is not None:
        values[key] = str(settings.state_partitions)
    elif spark.conf.get(key, None) is None:
        values[key] = str(spark.sparkContext.defaultParallelism)
    if settings.state_store == "rocksdb":
        values["spark.sql.streaming.stateStore.providerClass"] = ROCKSDB_PROVIDER
        values["spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"] = "true"
    return values


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder all executors can reach, removed when the session's JVM ends.

    It lies below the shared folder the cluster names in `spark.checkpoint.dir`. Only a local
    session may lack that setting and gets a machine-local folder; elsewhere executors would
    write to disks that nobody else sees, so that is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        path = f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    elif re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        path = tempfile.mkdtemp(prefix=f"{label}-")
    else:
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    jvm = spark.sparkContext._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    files = location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(location)
    files.deleteOnExit(location)
    return path
