"""Streams: dedup across batches and restarts, late rows, chained and continuous runs."""

from dataclasses import replace

import pytest
from helpers import body, clean, data_files, envelope
from pyspark.sql import functions as F

import __spark_entry__ as entry
from haulmetric.operators.windows import window_metrics
from haulmetric.plans.catalog import bootstrap_tables
from haulmetric.plans.layers import build_silver
from haulmetric.schemas import GOLD, SILVER
from haulmetric.settings import DEFAULTS
from haulmetric.sources import fixtures
from haulmetric.sources.bus import bus_options, open_bus_files
from haulmetric.sources.tables import read_table, stream_table
from haulmetric.streaming.chain import gold_stream, run_once, silver_stream, start_all
from haulmetric.streaming.sinks import append_to_path, drain


class Silver:
    """A silver stream over a folder of envelopes, run as often as asked."""

    def __init__(self, spark, root, settings=DEFAULTS):
        self.spark, self.root, self.settings = spark, str(root), settings

    def land(self, bodies, start=0):
        envelope(self.spark, bodies, start).write.mode("append").parquet(f"{self.root}/in")

    def run(self):
        stream = silver_stream(open_bus_files(self.spark, f"{self.root}/in"), self.settings)
        return drain(
            append_to_path(
                stream, f"{self.root}/out", f"{self.root}/checkpoint", settings=self.settings
            )
        )

    def seconds(self):
        rows = read_table(self.spark, f"{self.root}/out", SILVER).collect()
        return sorted(row.timestamp.minute * 60 + row.timestamp.second for row in rows)


@pytest.mark.parametrize("store", ["rocksdb", None])
def test_replays_are_dropped_across_batches_and_restarts(spark, tmp_path, store):
    settings = replace(DEFAULTS, dedup_mode="fast", state_store=store)
    silver = Silver(spark, tmp_path, settings)
    silver.land([body(seconds=100), body(seconds=101), body(seconds=101), "broken"])
    silver.run()
    # Inside the watermark: one replay, one new row.
    silver.land([body(seconds=101), body(seconds=95)], start=10)
    silver.run()
    assert silver.seconds() == [95, 100, 101]
    silver.run()
    assert silver.seconds() == [95, 100, 101]


def test_exact_mode_keeps_the_first_arrival_once_its_time_has_passed(spark, tmp_path):
    silver = Silver(spark, tmp_path)
    silver.land([body(seconds=100, ambientTempC=2.0)], start=7)
    silver.run()
    # An earlier message of the same key is read later, inside the watermark.
    silver.land([body(seconds=100, ambientTempC=1.0), body(seconds=105)], start=3)
    silver.run()
    assert silver.seconds() == []
    silver.land([body(seconds=130)], start=20)
    silver.run()
    assert silver.seconds() == [100, 105]
    rows = read_table(spark, f"{tmp_path}/out", SILVER).filter("minute(timestamp) = 1").collect()
    assert {r.ambient_temp for r in rows if r.timestamp.second == 40} == {1.0}
    silver.land([body(seconds=100)], start=30)
    silver.run()
    assert silver.seconds() == [100, 105]


def test_exact_dedup_has_one_state_store_and_combines_before_the_shuffle(spark, tmp_path):
    silver = Silver(spark, tmp_path)
    silver.land([body(seconds=5)] * 900 + [body(seconds=60)])
    progress = silver.run().recentProgress
    assert all(len(p["stateOperators"]) == 1 for p in progress)
    assert progress[0]["stateOperators"][0]["numRowsTotal"] == 2
    assert silver.seconds() == [5]


def test_rows_behind_the_watermark_are_dropped_and_counted(spark, tmp_path):
    silver = Silver(spark, tmp_path, replace(DEFAULTS, dedup_mode="fast"))
    silver.land([body(seconds=100)])
    silver.run()
    silver.land([body(seconds=80), body(seconds=110)], start=10)
    progress = silver.run().recentProgress
    assert silver.seconds() == [100, 110]
    dropped = sum(s["numRowsDroppedByWatermark"] for p in progress for s in p["stateOperators"])
    assert dropped == 1


def test_windows_are_emitted_once_and_only_when_closed(spark, tmp_path):
    events = clean(spark, [{"seconds": s} for s in (0, 5, 30, 130)])
    events.write.parquet(f"{tmp_path}/in")
    windows = gold_stream(stream_table(spark, f"{tmp_path}/in", SILVER))
    for _ in range(2):
        drain(append_to_path(windows, f"{tmp_path}/out", f"{tmp_path}/checkpoint"))
    out = read_table(spark, f"{tmp_path}/out", GOLD)
    newest = events.agg(F.max("timestamp")).first()[0]
    closed = window_metrics(events).filter(
        F.col("window_end") <= F.lit(newest) - F.expr("INTERVAL 10 SECONDS")
    )
    assert out.exceptAll(closed).isEmpty() and closed.exceptAll(out).isEmpty()
    assert 0 < out.count() < window_metrics(events).count()


def test_streamed_silver_over_many_files_equals_batch_up_to_the_watermark(spark, sf_dir, tmp_path):
    raw = fixtures.nested_envelope(fixtures.read_events(spark, sf_dir))
    raw.repartition(9).write.parquet(f"{tmp_path}/in")
    stream = silver_stream(open_bus_files(spark, f"{tmp_path}/in"))
    drain(append_to_path(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint"))
    out = read_table(spark, f"{tmp_path}/out", SILVER)
    batch = build_silver(raw)
    newest = batch.agg(F.max("timestamp")).first()[0]
    passed = batch.filter(F.col("timestamp") <= F.lit(newest) - F.expr("INTERVAL 10 SECONDS"))
    assert out.exceptAll(passed).isEmpty() and passed.exceptAll(out).isEmpty()
    assert 0 < passed.count() < batch.count()


def test_run_once_twice_adds_only_new_rows(spark, sf_dir, tmp_path):
    settings = DEFAULTS.at(str(tmp_path / "lake"))
    rows = fixtures.nested_envelope(fixtures.read_events(spark, sf_dir))
    rows.write.parquet(f"{tmp_path}/bus")
    bus = open_bus_files(spark, f"{tmp_path}/bus")
    run_once(bus, settings)
    counts = [read_table(spark, settings.gold_path, GOLD).count()]
    assert len(data_files(settings.silver_path)) > 0
    run_once(bus, settings)
    counts.append(read_table(spark, settings.gold_path, GOLD).count())
    assert counts[0] == counts[1] > 0


def test_three_streams_side_by_side(spark, tmp_path):
    settings = replace(DEFAULTS.at(str(tmp_path / "lake")), trigger_interval="200 milliseconds",
                       bronze_table="side.bronze", silver_table="side.silver",
                       gold_table="side.gold", state_partitions=2)
    bootstrap_tables(spark, settings)
    bodies = [body(seconds=s) for s in range(0, 180, 5)]
    envelope(spark, bodies).write.parquet(f"{tmp_path}/bus")
    streams = start_all(open_bus_files(spark, f"{tmp_path}/bus"), settings)
    try:
        assert [s.name for s in streams] == ["bronze", "silver", "gold"]
        for stream in streams:
            stream.processAllAvailable()
        assert spark.streams.awaitAnyTermination(1) is False
    finally:
        for stream in streams:
            stream.stop()
    # The last ten seconds wait for the watermark.
    assert 0 < len(bodies) - read_table(spark, settings.silver_path, SILVER).count() <= 3
    assert read_table(spark, settings.gold_path, GOLD).count() > 0


def test_partitioned_sink_bounds_the_files_per_vehicle(spark, tmp_path):
    bodies = [body(vehicle=f"V-{s % 2}", seconds=s // 2) for s in range(2000)]
    envelope(spark, bodies).write.parquet(f"{tmp_path}/in")
    settings = replace(DEFAULTS, state_partitions=40, partition_writers=3, state_store=None,
                       dedup_mode="fast")
    stream = silver_stream(open_bus_files(spark, f"{tmp_path}/in"), settings)
    drain(append_to_path(stream, f"{tmp_path}/out", f"{tmp_path}/cp", settings=settings,
                         partition_by=("vehicle_id",)))
    assert read_table(spark, f"{tmp_path}/out", SILVER).count() == 2000
    per_vehicle = {}
    for path in data_files(tmp_path / "out"):
        per_vehicle[path.parent.name] = per_vehicle.get(path.parent.name, 0) + 1
    assert set(per_vehicle) == {"vehicle_id=V-0", "vehicle_id=V-1"}
    assert all(1 < files <= 3 for files in per_vehicle.values())


def test_state_partitions_are_fixed_by_the_settings(spark, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    clean(spark, [{}]).write.parquet(f"{tmp_path}/in")
    settings = replace(DEFAULTS, state_partitions=3)
    stream = gold_stream(stream_table(spark, f"{tmp_path}/in", SILVER))
    query = drain(
        append_to_path(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint", settings=settings)
    )
    state = query.recentProgress[0]["stateOperators"][0]
    assert state["numShufflePartitions"] == 3
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_state_partitions_default_to_the_session_then_to_the_cores(spark):
    from haulmetric.session import state_conf

    key = "spark.sql.shuffle.partitions"
    assert key not in state_conf(spark)
    before = spark.conf.get(key)
    spark.conf.unset(key)
    try:
        assert state_conf(spark)[key] == str(spark.sparkContext.defaultParallelism)
    finally:
        spark.conf.set(key, before)


def test_file_admission_limits_a_batch(spark, tmp_path):
    for start in range(3):
        envelope(spark, [body(seconds=start)], start).coalesce(1).write.mode("append").parquet(
            f"{tmp_path}/in"
        )
    settings = replace(DEFAULTS, max_files_per_trigger=1)
    bus = open_bus_files(spark, f"{tmp_path}/in", settings)
    query = drain(append_to_path(bus, f"{tmp_path}/out", f"{tmp_path}/cp", settings=settings))
    assert [p["numInputRows"] for p in query.recentProgress] == [1, 1, 1]


def test_bus_options():
    options = bus_options(replace(DEFAULTS, bootstrap_servers="b:1", topic="t"))
    assert options == {
        "kafka.bootstrap.servers": "b:1", "subscribe": "t", "startingOffsets": "latest",
    }


def test_flat_stream_into_a_table(spark, sf_dir):
    frame = entry.queries()["stream_to_table"](spark, sf_dir)
    assert frame.columns[0] == "timestamp" and frame.count() > 0
