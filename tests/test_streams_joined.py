"""Stream-stream join and sessions over many micro-batches, and the bus through a stub source."""

import json
import sys
from dataclasses import replace

import helpers
from helpers import at, clean
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

from haulmetric.operators.decode import decode_nested
from haulmetric.operators.joins import flagged_events
from haulmetric.operators.trips import trip_sessions
from haulmetric.operators.windows import window_metrics
from haulmetric.schemas import ENVELOPE, GOLD, SILVER
from haulmetric.settings import DEFAULTS
from haulmetric.sources.bus import bus_options, open_bus
from haulmetric.sources.tables import stream_table
from haulmetric.streaming.chain import flagged_events_stream, gold_stream, trips_stream
from haulmetric.streaming.sinks import append_to_path, drain

ONE_FILE = replace(DEFAULTS, max_files_per_trigger=1)


def land_in_order(frame, path, time, files):
    """One file after the other in order of time, so that each becomes a micro-batch."""
    edges = frame.agg(F.min(F.unix_seconds(time)).alias("a"), F.max(F.unix_seconds(time)).alias("b")).first()
    width = (edges.b - edges.a) // files + 1
    for k in range(files):
        part = frame.filter(F.floor((F.unix_seconds(time) - edges.a) / width) == k)
        part.coalesce(1).write.mode("append").parquet(path)


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def states(query):
    """State rows after each micro-batch that had any."""
    return [sum(s["numRowsTotal"] for s in p["stateOperators"]) for p in query.recentProgress if p["stateOperators"]]


def test_joined_streams_equal_the_batch_join_and_their_state_stays_small(spark, silver, tmp_path):
    gold = window_metrics(silver)
    files = 12
    land_in_order(silver, f"{tmp_path}/silver", "timestamp", files)
    land_in_order(gold, f"{tmp_path}/gold", "window_end", files)
    joined = flagged_events_stream(
        stream_table(spark, f"{tmp_path}/silver", SILVER, ONE_FILE), stream_table(spark, f"{tmp_path}/gold", GOLD, ONE_FILE)
    )
    query = drain(append_to_path(joined, f"{tmp_path}/out", f"{tmp_path}/checkpoint"))
    batch = flagged_events(gold, silver)
    assert batch.count() > 50
    assert same(spark.read.schema(joined.schema).parquet(f"{tmp_path}/out"), batch)
    held = states(query)
    assert len(held) >= files
    # Both sides put in more rows than ever stay: a batch's worth at each end.
    flagged = gold.filter("anomaly_flag").count()
    assert max(held[2:]) < flagged / 2
    assert held[-1] <= max(held[: files // 2])


def test_the_gold_stream_itself_can_be_joined(spark, tmp_path):
    """Windows come late: an event waits until the window that it flagged is closed."""
    events = [{"seconds": s, "door_status": "OPEN" if s == 100 else "CLOSED"} for s in range(0, 400, 20)]
    clean(spark, events).coalesce(1).write.parquet(f"{tmp_path}/silver")
    silver = stream_table(spark, f"{tmp_path}/silver", SILVER)
    drain(append_to_path(gold_stream(silver), f"{tmp_path}/gold", f"{tmp_path}/c1"))
    joined = flagged_events_stream(silver, stream_table(spark, f"{tmp_path}/gold", GOLD))
    drain(append_to_path(joined, f"{tmp_path}/out", f"{tmp_path}/c2"))
    rows = spark.read.parquet(f"{tmp_path}/out").collect()
    assert len(rows) == 6 and {r.cause for r in rows} == {"door"}


def test_streamed_trips_equal_batch_up_to_the_watermark(spark, silver, tmp_path):
    short = replace(ONE_FILE, trip_gap="2 minutes")
    land_in_order(silver, f"{tmp_path}/in", "timestamp", 8)
    trips = trips_stream(stream_table(spark, f"{tmp_path}/in", SILVER, short), short)
    query = drain(append_to_path(trips, f"{tmp_path}/out", f"{tmp_path}/checkpoint", settings=short))
    passed = silver.agg(F.max("timestamp") - F.expr("INTERVAL 130 SECONDS")).first()[0]
    want = trip_sessions(silver, short).filter(F.col("trip_end") <= F.lit(passed))
    found = spark.read.schema(trips.schema).parquet(f"{tmp_path}/out")
    assert want.count() > 10 and same(found, want)
    assert max(states(query)) < silver.count() / 4


def test_trips_grow_over_batches_and_restarts(spark, tmp_path):
    def run(*seconds):
        rows = [{"seconds": s, "cargo_temp": float(s % 10)} for s in seconds]
        clean(spark, rows).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        trips = trips_stream(stream_table(spark, f"{tmp_path}/in", SILVER))
        drain(append_to_path(trips, f"{tmp_path}/out", f"{tmp_path}/checkpoint"))
        return sorted((r.events, r.max_cargo_temp) for r in spark.read.schema(trips.schema).parquet(f"{tmp_path}/out").collect())

    assert run(0, 105) == []
    assert run(203, 400) == []
    # Later by more than the gap and the watermark's delay: the first trip is final.
    assert run(720) == [(4, 5.0)]
    assert run(1, 721) == [(4, 5.0)]
    assert run(2000) == [(2, 1.0), (4, 5.0)]


def test_a_broken_reading_does_not_stop_the_gold_stream(spark, tmp_path):
    rows = [{"seconds": s, "cargo_temp": 9e18 if s < 30 else 4.0} for s in range(0, 60, 10)] + [{"seconds": 500}]
    clean(spark, rows).coalesce(1).write.parquet(f"{tmp_path}/in")
    windows = gold_stream(stream_table(spark, f"{tmp_path}/in", SILVER))
    drain(append_to_path(windows, f"{tmp_path}/out", f"{tmp_path}/checkpoint"))
    found = {r.window_start: r.avg_cargo_temp for r in spark.read.schema(GOLD).parquet(f"{tmp_path}/out").collect()}
    start = lambda s: at(s).replace(tzinfo=None)
    assert found[start(30)] == 4.0 and found[start(-30)] > 8e18 and found[start(0)] > 4e18


# --- the bus --------------------------------------------------------------------------------


# Workers cannot import test modules.
for module in (sys.modules[__name__], helpers):
    cloudpickle.register_pickle_by_value(module)


class StubReader(SimpleDataSourceStreamReader):
    """Hands out the options it was given as one message, once."""

    def __init__(self, options):
        self.options = dict(options)

    def initialOffset(self):
        return {"at": 0}

    def read(self, start):
        if start["at"]:
            return iter(()), start
        message = json.dumps({"vehicleId": json.dumps(self.options, sort_keys=True), "timestamp": "2024-05-01 12:00:00"})
        return iter([(None, message.encode(), self.options["subscribe"], 0, 7, at(0), 0)]), {"at": 1}

    def readBetweenOffsets(self, start, end):
        return self.read(start)[0]

    def commit(self, end):
        pass


class Stub(DataSource):
    @classmethod
    def name(cls):
        return "stub_bus"

    def schema(self):
        return ENVELOPE

    def simpleStreamReader(self, schema):
        return StubReader(self.options)


def test_the_settings_reach_the_reader_of_the_bus(spark, tmp_path):
    spark.dataSource.register(Stub)
    settings = replace(
        DEFAULTS, bootstrap_servers="b1:9092,b2:9092", topic="t7", starting_offsets="earliest", max_offsets_per_trigger=500
    )
    options = bus_options(settings) | {"failOnDataLoss": "false"}
    bus = open_bus(spark, settings, source_format="stub_bus", options=options)
    assert bus.schema.names == ENVELOPE.names
    events = decode_nested(bus, keep=("topic", "offset")).select("topic", "offset", "vehicle_id")
    query = append_to_path(events, f"{tmp_path}/out", f"{tmp_path}/checkpoint", continuous=True)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    (row,) = spark.read.parquet(f"{tmp_path}/out").collect()
    assert (row.topic, row.offset) == ("t7", 7)
    given = {k.lower(): v for k, v in json.loads(row.vehicle_id).items()}
    assert given == {
        "kafka.bootstrap.servers": "b1:9092,b2:9092", "subscribe": "t7", "startingoffsets": "earliest",
        "maxoffsetspertrigger": "500", "failondataloss": "false",
    }
