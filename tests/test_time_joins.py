"""Windows with their causes, as-of positions, trips, door episodes, roll-ups, shapes, differences."""

import random
import re
from dataclasses import replace

import pytest
from helpers import at, body, clean, envelope, plan_of
from pyspark.sql import functions as F

from haulmetric.operators import fleet, rollup
from haulmetric.operators.drift import merged_schema, payload_drift
from haulmetric.operators.joins import alert_positions, as_of, flagged_events, window_causes
from haulmetric.operators.trips import door_episodes, trip_sessions
from haulmetric.operators.windows import window_metrics
from haulmetric.plans.layers import build_silver
from haulmetric.plans.reconcile import layer_reconcile, multiset_difference
from haulmetric.settings import DEFAULTS


# --- window causes --------------------------------------------------------------------------


def causes(events):
    found = window_causes(window_metrics(events), events)
    return {int((r.window_start - at(0).replace(tzinfo=None)).total_seconds()): r for r in found.collect()}


def test_the_first_event_that_raised_the_flag_is_the_cause(spark):
    events = clean(spark, [
        {"seconds": 0, "cargo_temp": 8.5},  # warm, but the means of its windows are not
        {"seconds": 5, "cargo_temp": 1.0},
        {"seconds": 20, "door_status": "OPEN"},
        {"seconds": 30, "vibration": 3.2, "door_status": "OPEN"},
        {"seconds": 200, "cargo_temp": 9.0, "vibration": 3.004},  # rounds to 3.0: no flag by vibration
        {"seconds": 400, "cargo_temp": 5.0},
    ])
    found = causes(events)
    assert {s: r.cause for s, r in found.items() if s < 100} == (
        {s: "cargo" for s in (-50,)} and {s: found[s].cause for s in found if s < 100}
    )
    assert found[0].cause == "door" and found[0].event_time == at(20).replace(tzinfo=None) and found[0].raising_events == 2
    assert found[30].cause == "door+vibration" and found[30].raising_events == 1
    assert found[200].cause == "cargo"
    assert 400 not in found


def test_every_flagged_window_has_a_cause(spark, silver):
    gold = window_metrics(silver)
    found = window_causes(gold, silver)
    keys = ["vehicle_id", "window_start", "window_end"]
    flagged = gold.filter("anomaly_flag").select(keys)
    assert flagged.exceptAll(found.select(keys)).isEmpty() and found.count() == flagged.count() > 0


def test_causes_meet_on_equal_keys_without_a_range_join(spark, silver, tmp_path):
    window_metrics(silver).write.parquet(f"{tmp_path}/gold")
    gold = spark.read.parquet(f"{tmp_path}/gold")
    plan = plan_of(window_causes(gold, silver))
    joins = re.findall(r"(\w*(?:Join|Product))\b \[([^\]]*)\]", plan)
    assert len(joins) == 1 and joins[0][0] in ("SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin")
    assert joins[0][1].startswith("vehicle_id") and "window_start" in joins[0][1]
    # Only anomalous events are multiplied by their windows.
    generate = plan.index("Expand") if "Expand" in plan else plan.index("Generate")
    assert "door_status" in plan[generate : plan.index("FileScan", generate)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(window_causes(gold, silver))
        # Two for the join; the aggregate adds window_end, which equal starts do not spread further.
        assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# --- as-of join -----------------------------------------------------------------------------


def plain_as_of(left, right):
    out = []
    for key, time, tag in left:
        known = [(t, v) for k, t, v in right if k == key and t is not None and time is not None and t <= time]
        out.append((key, time, tag, *(max(known) if known else (None, None))))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed, bucket", [(0, "1 hour"), (1, "10 minutes"), (2, "7 seconds")])
def test_as_of_equals_a_search_row_by_row(spark, seed, bucket):
    """One key holds nine rows of ten; times tie, and some keys are on one side only."""
    rng = random.Random(seed)

    def rows(count):
        return [
            ("hot" if rng.random() < 0.9 else rng.choice(["a", "b", f"only-{count}", None]),
             None if rng.random() < 0.02 else at(rng.randrange(0, 20_000, 5)), k)
            for k in range(count)
        ]

    left, right = rows(700), rows(400)
    found = as_of(
        spark.createDataFrame(left, "v string, t timestamp, tag int"),
        spark.createDataFrame(right, "v string, t timestamp, x int"),
        "v", "t", ["x"], found_at="seen", bucket=bucket,
    )
    assert found.columns == ["v", "t", "tag", "seen", "x"]
    naive = lambda rs: [(k, t and t.replace(tzinfo=None), x) for k, t, x in rs]
    assert sorted(map(tuple, found.collect()), key=str) == plain_as_of(naive(left), naive(right))


def test_a_hot_key_is_dealt_over_its_buckets(spark):
    events = spark.range(20_000).selectExpr(
        "if(id % 10 = 0, concat('v', id % 100), 'hot') AS v", "timestamp_seconds(1700000000 + id * 7) AS t", "id AS x"
    )
    found = as_of(events, events, "v", "t", ["x"], found_at="seen")
    # All rows of a task's partition, of which a single key alone would hold 90 %.
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [r.n for r in found.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert len(sizes) > 2 and max(sizes) < 0.6 * 20_000
        assert "CartesianProduct" not in plan_of(found) and "NestedLoop" not in plan_of(found)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert found.filter("x <> tag").count() == 0 if "tag" in found.columns else found.count() == 20_000


def test_alerts_take_the_last_known_position(spark):
    events = clean(spark, [
        {"seconds": 0, "latitude": 1.0, "longitude": 2.0},
        {"seconds": 60, "latitude": None, "longitude": 9.0, "cargo_temp": 9.0},
        {"seconds": 90, "latitude": 3.0, "longitude": 4.0, "cargo_temp": 9.0},
        {"seconds": 8000, "latitude": None, "longitude": None, "door_status": "OPEN"},
        {"seconds": 10, "vehicle_id": "TRK-CHI-0002", "latitude": None, "condensation_risk": True},
    ])
    found = [(r.latitude, r.longitude, r.position_age) for r in alert_positions(events).orderBy("vehicle_id", "timestamp").collect()]
    assert found == [(1.0, 2.0, 60), (3.0, 4.0, 0), (3.0, 4.0, 7910), (None, None, None)]


# --- trips and episodes -----------------------------------------------------------------------


def test_trips_end_after_a_gap(spark):
    seconds = [0, 100, 400, 700, 1001, 5000]
    rows = [{"seconds": s, "cargo_temp": float(s % 7), "vehicle_id": v} for s in seconds for v in ("a", "b")]
    rows += [{"seconds": 1001, "vehicle_id": "a", "cargo_temp": float("nan")}]
    found = {(r.vehicle_id, r.trip_start): r for r in trip_sessions(clean(spark, rows)).collect()}
    start = lambda s: at(s).replace(tzinfo=None)
    assert {k[1] for k in found if k[0] == "b"} == {start(0), start(1001), start(5000)}
    first = found["b", start(0)]
    assert first.trip_end == start(700) and first.events == 4 and (first.min_cargo_temp, first.max_cargo_temp) == (0.0, 2.0)
    assert found["a", start(1001)].events == 2 and found["a", start(1001)].max_cargo_temp == 0.0


@pytest.mark.parametrize("bucket", ["1 hour", "1 minute", "3 seconds"])
def test_trips_do_not_depend_on_buckets(spark, silver, bucket):
    short = replace(DEFAULTS, trip_gap="100 seconds")
    found, want = trip_sessions(silver, short, bucket), trip_sessions(silver, short, "10 days")
    assert found.count() > silver.select("vehicle_id").distinct().count()
    assert found.exceptAll(want).isEmpty() and want.exceptAll(found).isEmpty()


def test_a_busy_vehicles_stretches_are_merged_before_they_meet(spark, silver):
    plan = plan_of(trip_sessions(silver))
    sessions = plan.index("MergingSessions")
    shuffles = [m.group(1) for m in re.finditer(r"Exchange hashpartitioning\(([^)]*?), \d+\)", plan[sessions:])]
    # Stretches by vehicle; the events themselves by (vehicle, bucket).
    assert len(shuffles) == 2 and "bucket" not in shuffles[0] and "bucket" in shuffles[1]


def plain_episodes(rows):
    out = []
    for vehicle in {r[0] for r in rows}:
        own = sorted((t, not o, c) for v, t, o, c in rows if v == vehicle and o is not None)
        k = 0
        while k < len(own):
            j = k
            while j < len(own) and own[j][1] == own[k][1]:
                j += 1
            if not own[k][1]:
                closed = own[j][0] if j < len(own) else None
                out.append((vehicle, own[k][0], own[j - 1][0], closed, j - k, max(c for _, _, c in own[k:j]), (closed or own[j - 1][0]) - own[k][0]))
            k = j
    return sorted(out, key=str)


@pytest.mark.parametrize("seed, bucket", [(0, "1 hour"), (1, "10 minutes"), (2, "30 seconds"), (3, "1 second")])
def test_episodes_equal_a_walk_over_the_events(spark, seed, bucket):
    """Long and short episodes over many buckets, statuses that are missing, and equal times."""
    rng = random.Random(seed)
    rows, state = [], False
    for k in range(600):
        state = state if rng.random() < 0.8 else not state
        vehicle = "hot" if rng.random() < 0.8 else rng.choice("ab")
        rows.append((vehicle, rng.randrange(0, 9000) if seed else k * 15, None if rng.random() < 0.05 else state, float(rng.randrange(20))))
    frame = clean(spark, [
        {"vehicle_id": v, "seconds": t, "door_status": None if o is None else "OPEN" if o else "CLOSED", "cargo_temp": c}
        for v, t, o, c in rows
    ])
    base = F.unix_seconds(F.lit(at(0)))
    found = door_episodes(frame, bucket).select(
        "vehicle_id", *((F.unix_seconds(c) - base).alias(c) for c in ("opened_at", "last_open", "closed_at")),
        "events", "max_cargo_temp", "seconds",
    )
    assert sorted(map(tuple, found.collect()), key=str) == plain_episodes(rows)


def test_episodes_of_nothing(spark):
    assert door_episodes(clean(spark, [])).count() == 0
    only = clean(spark, [{"door_status": None}, {"seconds": 5, "door_status": "CLOSED"}])
    assert door_episodes(only).count() == 0


# --- roll-ups ---------------------------------------------------------------------------------


def test_rollup_of_stored_sums_equals_recomputation_and_has_one_shuffle(spark, silver, tmp_path):
    rollup.hourly_sums(silver).write.parquet(f"{tmp_path}/hourly")
    found = rollup.fleet_rollup(spark.read.parquet(f"{tmp_path}/hourly"))
    assert plan_of(found).count("Exchange") == 1
    assert {r.level for r in found.select("level").distinct().collect()} == set(rollup.LEVELS.values())
    from haulmetric.functions.numeric import exact_mean

    fleet_row = found.filter("level = 'fleet'").first()
    whole = silver.agg(exact_mean(F.col("cargo_temp")).alias("m"), F.count("*").alias("n")).first()
    assert (fleet_row.avg_cargo_temp, fleet_row.events) == (whole.m, whole.n)
    vehicles = silver.groupBy("vehicle_id").agg(exact_mean(F.col("cargo_temp")).alias("avg_cargo_temp"))
    assert vehicles.exceptAll(found.filter("level = 'vehicle'").select("vehicle_id", "avg_cargo_temp")).isEmpty()


def test_rollup_tells_unknown_vehicles_from_totals(spark):
    events = clean(spark, [{"vehicle_id": None, "cargo_temp": 1.0}, {"cargo_temp": None}, {"seconds": 7200, "cargo_temp": 4.0}])
    rows = rollup.fleet_rollup(rollup.hourly_sums(events)).collect()
    by = {(r.level, r.vehicle_id): (r.events, r.cargo_readings, r.avg_cargo_temp) for r in rows if r.level in ("vehicle", "fleet")}
    assert by == {("vehicle", None): (1, 1, 1.0), ("vehicle", "TRK-CHI-0001"): (2, 1, 4.0), ("fleet", None): (3, 2, 2.5)}


def test_sketches_merge_in_any_order_within_their_errors(spark):
    events = spark.range(60_000).selectExpr(
        "concat('v', id % 2) AS vehicle_id", "timestamp_seconds(1700000000 + id) AS timestamp",
        "cast(id % 7919 AS double) AS latitude", "0D AS longitude", "cast(id * 7919 % 60000 AS double) AS cargo_temp",
    )
    hourly = rollup.hourly_sketches(events)
    for order in ("hour", "hash(hour)", "-unix_seconds(hour)"):
        dealt = hourly.repartition(3).sortWithinPartitions(F.expr(order))
        for r in rollup.daily_estimates(dealt).collect():
            exact = rollup.daily_exact(events.filter(F.col("vehicle_id") == r.vehicle_id)).filter(F.col("day") == r.day).first()
            assert r.cargo_readings == exact.cargo_readings
            assert abs(r.positions - exact.positions) <= 0.065 * exact.positions
            assert abs(r.cargo_median - exact.cargo_median) <= 0.0166 * 60_000
            assert abs(r.cargo_p95 - exact.cargo_p95) <= 0.0166 * 60_000


# --- shapes and differences -------------------------------------------------------------------


def test_shapes_of_a_mixed_topic(spark):
    flat = '{"Timestamp":"2024-05-01T12:00:00Z","Vehicle_ID":"x","Cargo_Temp":%s,"Extra":{"a":[1,2],"b":null}}'
    texts = [body(), body(cargoContainerTempC=3), flat % "1.5", flat % '"warm"', '{"Timestamp":1}', "{bad json", None, "", "[1]", "7", '{"x":{}}', "{}"]
    found = {(r.shape, r.field, r.type): r.bodies for r in payload_drift(envelope(spark, texts)).collect()}
    totals = {s: n for (s, f, _), n in found.items() if f == ""}
    assert totals == {"nested": 2, "flat": 3, "broken": 3, "other": 4}
    assert found["flat", "Cargo_Temp", "NUMBER"] == found["flat", "Cargo_Temp", "STRING"] == 1
    assert found["flat", "Timestamp", "STRING"] == 2 and found["flat", "Timestamp", "NUMBER"] == 1
    assert found["flat", "Extra", "OBJECT"] == found["flat", "Extra.a", "ARRAY"] == found["flat", "Extra.b", "VOID"] == 2
    assert found["nested", "telemetry.cargoContainerTempC", "NUMBER"] == 2 and found["other", "x", "OBJECT"] == 1
    merged = {r.shape: r.schema for r in merged_schema(envelope(spark, texts)).collect()}
    assert "Cargo_Temp: VARIANT" in merged["flat"] and merged["nested"].startswith("OBJECT<")


def test_bodies_are_parsed_once(spark):
    plan = payload_drift(envelope(spark, [body()]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parse_json") + plan.count("parseJson") == 1
    assert plan.count("Exchange") == 1


def test_reconcile_finds_a_loss_and_a_surplus_with_multiplicities(spark):
    bronze = envelope(spark, [body(seconds=s) for s in range(10)] + ["{bad json", None])
    silver = build_silver(bronze)
    assert layer_reconcile(bronze, silver).count() == 0
    second = F.unix_seconds("timestamp") % 60
    twice = silver.filter(second == 5)
    damaged = silver.filter(second != 3).unionByName(twice).unionByName(twice).unionByName(twice.withColumn("cargo_temp", F.lit(float("nan"))))
    found = sorted((r.side, r.copies, r.timestamp.second) for r in layer_reconcile(bronze, damaged).collect())
    assert found == [("missing", 1, 3), ("unexpected", 1, 5), ("unexpected", 2, 5)]


def test_difference_equals_except_all_both_ways_in_one_shuffle(spark):
    rng = random.Random(1)
    rows = lambda: [(rng.choice([1, 2, None]), rng.choice([0.0, -0.0, float("nan"), None])) for _ in range(60)]
    a, b = (spark.createDataFrame(rows(), "x int, y double") for _ in range(2))
    found = multiset_difference(a, b)
    spread = found.select("side", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))), "x", "y").groupBy("side").count()
    want = {"missing": a.exceptAll(b).count(), "unexpected": b.exceptAll(a).count()}
    assert {r.side: r["count"] for r in spread.collect()} == {k: v for k, v in want.items() if v}
    assert plan_of(found).count("Exchange") == 1


# --- averages that nothing stops ----------------------------------------------------------------


def test_broken_readings_stop_no_average(spark):
    rows = [{"cargo_temp": 9e18}, {"cargo_temp": 9e18, "seconds": 1}, {"cargo_temp": 9.2e18, "seconds": 2}]
    events = clean(spark, rows + [{"cargo_temp": -9e18, "seconds": 300, "vehicle_id": "b"}])
    found = window_metrics(events).filter("vehicle_id <> 'b'").agg(F.max("avg_cargo_temp")).first()[0]
    assert found == pytest.approx((9e18 + 9e18 + 9.2e18) / 3, rel=1e-12)
    assert fleet.fleet_kpis(events).first().sample_events == 4
    moved = events.withColumn("latitude", F.col("cargo_temp")).withColumn("longitude", F.col("cargo_temp"))
    assert fleet.map_center(fleet.route_trail(moved)).count() == 1
    assert rollup.fleet_rollup(rollup.hourly_sums(events)).filter("level = 'fleet'").first().avg_cargo_temp > 1e18
    assert flagged_events(window_metrics(events), events).count() > 0


def test_settings_reach_the_new_operators(spark):
    events = clean(spark, [{"seconds": s, "cargo_temp": 5.0} for s in (0, 30, 90)])
    strict = replace(DEFAULTS, cargo_limit=1.0, trip_gap="20 seconds")
    assert window_causes(window_metrics(events, strict), events, strict).count() > 0
    assert trip_sessions(events, strict).count() == 3
