"""Stored layout: partitions, skew, compaction, clustering, retention, failures."""

from dataclasses import replace
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from helpers import at, clean, data_files
from pyspark.sql import functions as F

from haulmetric.plans import upkeep
from haulmetric.plans.catalog import bootstrap_tables, schema_explorer
from haulmetric.plans.layers import write_layers
from haulmetric.plans.reports import console, partition_offsets, run_sql, stored_layers
from haulmetric.schemas import ENVELOPE, LAYER_SCHEMAS, SILVER
from haulmetric.session import scratch_dir, session_conf
from haulmetric.settings import DEFAULTS
from haulmetric.sources import fixtures
from haulmetric.sources.tables import read_table, register_layers, write_table


@pytest.fixture(scope="module")
def lake(spark, sf_dir, tmp_path_factory):
    settings = DEFAULTS.at(str(tmp_path_factory.mktemp("lake")))
    write_layers(spark, fixtures.nested_envelope(fixtures.read_events(spark, sf_dir)), settings)
    return settings


def same_rows(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def statistics(path, column):
    table = pq.ParquetFile(path)
    index = table.schema_arrow.names.index(column)
    groups = [table.metadata.row_group(i).column(index).statistics
              for i in range(table.metadata.num_row_groups)]
    assert all(s is not None and s.has_min_max for s in groups)
    return min(s.min for s in groups), max(s.max for s in groups)


def test_layers_read_back_with_their_schemas(spark, lake):
    for layer, path in lake.layer_paths().items():
        assert read_table(spark, path, LAYER_SCHEMAS[layer]).schema == LAYER_SCHEMAS[layer]


def test_silver_folder_per_vehicle_is_pruned(spark, lake):
    folders = [p.name for p in Path(lake.silver_path).iterdir() if p.is_dir()]
    numbered = [f"vehicle_id=TRK-CHI-{i:04d}" for i in range(1, 13)]
    assert sorted(folders) == [*numbered, "vehicle_id=TRK-CHI-SPARE"]
    one = read_table(spark, lake.silver_path, SILVER).filter("vehicle_id = 'TRK-CHI-0002'")
    assert one.count() > 0
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(vehicle_id" in plan


def test_stored_times_carry_statistics(lake):
    low, high = statistics(data_files(lake.gold_path)[0], "window_end")
    assert low <= high


def test_hot_vehicle_is_written_by_several_tasks(spark, tmp_path):
    rows = (
        spark.range(200_000)
        .select(
            F.timestamp_seconds(F.col("id")).alias("timestamp"),
            F.when(F.col("id") % 3 > 0, "HOT").otherwise(F.concat(F.lit("V"), F.col("id") % 5)).alias("vehicle_id"),
            F.rand(1).alias("ambient_temp"), F.rand(2).alias("cargo_temp"),
        )
    )
    with session_conf(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "500k"}):
        write_table(rows, str(tmp_path / "t"), partition_by=("vehicle_id",))
    files = {}
    for path in data_files(tmp_path / "t"):
        files.setdefault(path.parent.name, []).append(path)
    assert len(files["vehicle_id=HOT"]) > 3
    assert min(len(found) for found in files.values()) <= 3


def test_compaction_merges_files_and_keeps_rows(spark, silver, tmp_path):
    silver.repartition(20).write.parquet(f"{tmp_path}/small")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    upkeep.compact(spark, f"{tmp_path}/small", f"{tmp_path}/big", SILVER)
    assert len(data_files(tmp_path / "small")) == 20
    assert len(data_files(tmp_path / "big")) == 1
    assert same_rows(read_table(spark, f"{tmp_path}/big", SILVER), silver)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def test_compaction_respects_the_target_size(spark, silver, tmp_path):
    silver.repartition(20).write.parquet(f"{tmp_path}/small")
    total = sum(p.stat().st_size for p in data_files(tmp_path / "small"))
    settings = replace(DEFAULTS, target_file_bytes=total // 4)
    assert upkeep.stored_bytes(spark, f"{tmp_path}/small") == total
    upkeep.compact(spark, f"{tmp_path}/small", f"{tmp_path}/big", SILVER, settings)
    assert 4 <= len(data_files(tmp_path / "big")) <= 6


def test_clustering_gives_disjoint_time_ranges(spark, silver, tmp_path):
    write_table(silver.repartition(7), f"{tmp_path}/in", partition_by=("vehicle_id",))
    size = sum(p.stat().st_size for p in data_files(tmp_path / "in"))
    settings = replace(DEFAULTS, target_file_bytes=size // 12)
    upkeep.cluster_by_time(
        spark, f"{tmp_path}/in", f"{tmp_path}/out", SILVER,
        partition_by=("vehicle_id",), settings=settings,
    )
    assert same_rows(read_table(spark, f"{tmp_path}/out", SILVER), silver)
    ranges = {}
    for path in data_files(tmp_path / "out"):
        ranges.setdefault(path.parent.name, []).append(statistics(path, "timestamp"))
    assert max(map(len, ranges.values())) > 1
    for found in ranges.values():
        found.sort()
        assert all(a[1] < b[0] for a, b in zip(found, found[1:]))


def test_time_filter_reaches_the_clustered_files(spark, silver, tmp_path):
    silver.write.parquet(f"{tmp_path}/in")
    upkeep.cluster_by_time(spark, f"{tmp_path}/in", f"{tmp_path}/out", SILVER)
    late = read_table(spark, f"{tmp_path}/out", SILVER).filter("timestamp > '2024-01-01 05:00:00'")
    plan = late.select("cargo_temp")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(timestamp), GreaterThan(timestamp" in plan
    assert "ReadSchema: struct<timestamp:timestamp,cargo_temp:double>" in plan


def test_retention_horizon(spark):
    frame = clean(spark, [{"seconds": s} for s in (0, 60, 120)])
    def hot(**options):
        tiers = upkeep.retention_tiers(frame, "timestamp", "60 SECONDS", **options)
        return tiers.filter("tier = 'hot'").count()
    assert hot() == 2
    assert hot(as_of="2024-05-01 12:10:00") == 0


def test_maintenance_survives_a_missing_and_a_broken_layer(spark, lake, tmp_path):
    broken = tmp_path / "gold"
    broken.mkdir()
    (broken / "part-0.parquet").write_text("not parquet")
    settings = replace(lake, silver_path=f"{tmp_path}/nowhere", gold_path=str(broken))
    outcome = upkeep.maintain_layers(spark, settings, str(tmp_path / "out"))
    status = {layer: state for layer, _, state in outcome}
    assert status["bronze"] == "done" and status["silver"] == "missing"
    assert status["gold"].startswith("failed")


def test_views_of_missing_layers_are_skipped(spark, lake, tmp_path):
    paths = lake.layer_paths() | {"gold": f"{tmp_path}/nowhere"}
    assert register_layers(spark, lake.layer_paths()) == ["bronze", "silver", "gold"]
    assert register_layers(spark, paths) == ["bronze", "silver"]
    assert not spark.catalog.tableExists("gold")
    listing = schema_explorer(spark, {name: name for name in paths})
    assert {r.layer for r in listing.collect()} == {"bronze", "silver"}
    assert schema_explorer(spark, {"x": "no_such_view"}).count() == 0


def test_views_see_rows_appended_later(spark, lake, tmp_path):
    path = str(tmp_path / "bronze")
    bronze = read_table(spark, lake.bronze_path, ENVELOPE)
    write_table(bronze, path)
    settings = replace(lake, bronze_path=path)
    count = "SELECT count(*) AS n FROM bronze"
    first = run_sql(spark, count, settings).first().n
    write_table(bronze, path)
    assert run_sql(spark, count, settings).first().n == 2 * first


@pytest.mark.parametrize("name", sorted(console()))
def test_console_reports_run_on_stored_layers(spark, lake, name):
    assert console()[name](**stored_layers(spark, lake)).count() > 0


def test_console_reports_follow_the_settings(spark, lake):
    layers = stored_layers(spark, lake)
    strict = console(replace(lake, cargo_limit=-100.0))["anomaly_events"](**layers)
    assert strict.count() == 50


def test_a_missing_layer_is_none(spark, lake, tmp_path):
    layers = stored_layers(spark, replace(lake, gold_path=f"{tmp_path}/nowhere"))
    assert layers["gold"] is None and layers["silver"] is not None


def test_places_must_be_absolute():
    with pytest.raises(ValueError, match="bronze_path"):
        DEFAULTS.layer_paths()
    with pytest.raises(ValueError, match="gold_checkpoint"):
        replace(DEFAULTS, gold_checkpoint="warehouse/gold").place("gold_checkpoint")


def test_sql_prints_all_rows(spark, capsys):
    from haulmetric.__main__ import _print

    _print(spark.range(45))
    assert len(capsys.readouterr().out.splitlines()) == 46
    _print(spark.range(45), rows=30)
    assert capsys.readouterr().out.splitlines()[-1] == "... 15 more rows"


def test_size_of_a_table_is_found_without_reading_it(spark, lake):
    before = sum(p.stat().st_size for p in data_files(lake.silver_path))
    assert upkeep.stored_bytes(spark, lake.silver_path) == before


def test_scratch_without_a_shared_folder_is_local_only():
    class Conf:
        def get(self, key, default=None):
            return default

    class Cluster:
        conf = Conf()
        sparkContext = type("Context", (), {"master": "spark://host:7077"})()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(Cluster(), "x")


def test_sql_in_mixed_case_column_names(spark, lake):
    text = """SELECT Timestamp, Vehicle_ID, Ambient_Temp, Cargo_Temp, Temp_Delta, Door_Status
              FROM silver ORDER BY Timestamp DESC LIMIT 5"""
    assert run_sql(spark, text, lake).count() == 5
    by_path = f"SELECT Window_End, Anomaly_Flag FROM parquet.`{lake.gold_path}` LIMIT 3"
    assert spark.sql(by_path).count() == 3


def test_bootstrap_is_idempotent(spark, tmp_path):
    settings = replace(DEFAULTS.at(str(tmp_path / "lake")), bronze_table="boot.bronze",
                       silver_table="boot.silver", gold_table="boot.gold")
    for _ in range(2):
        assert bootstrap_tables(spark, settings) == ["boot.bronze", "boot.silver", "boot.gold"]
    assert spark.table("boot.bronze").schema == ENVELOPE
    assert sorted(spark.table("boot.silver").columns) == sorted(SILVER.names)
    columns = {c.name: c.isPartition for c in spark.catalog.listColumns("boot.silver")}
    assert [name for name, is_key in columns.items() if is_key] == ["vehicle_id"]


def test_partition_offsets(spark):
    rows = [(None, b"x", "t", p, o, at(0), 0) for p, o in ((0, 5), (0, 9), (1, 3))]
    found = partition_offsets(spark.createDataFrame(rows, ENVELOPE)).collect()
    assert {(r.partition, r.total, r.latest_offset) for r in found} == {(0, 2, 9), (1, 1, 3)}


def test_scratch_lies_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    a, b = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert a != b and a.startswith(shared) and b.startswith(shared)
