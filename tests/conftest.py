from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import DataFrame, SparkSession

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

TESTDATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.sql.debug.maxToStringFields", "1000")
        .config("spark.sql.maxMetadataStringLength", "10000")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return str(TESTDATA / f"sf{os.environ.get('TEST_SF', '0.001')}")


@pytest.fixture(scope="session")
def silver(spark, sf_dir, tmp_path_factory) -> DataFrame:
    """Clean events of the fixture, stored once."""
    import __spark_entry__ as entry
    from haulmetric.schemas import SILVER
    from haulmetric.sources.tables import read_table, write_table

    path = str(tmp_path_factory.mktemp("silver"))
    write_table(entry.queries()["silver_events"](spark, sf_dir), path)
    return read_table(spark, path, SILVER)
