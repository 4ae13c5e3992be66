"""Hand-written rows with known results."""

import json
import math

import pytest
from helpers import at, body, clean, envelope
from pyspark.sql import functions as F

from haulmetric.functions.numeric import exact_mean
from haulmetric.functions.text import vehicle_slot
from haulmetric.operators import fleet
from haulmetric.operators.decode import decode_flat, decode_nested
from haulmetric.operators.enrich import enrich
from haulmetric.operators.quality import first_arrival, rejected_events, valid_events
from haulmetric.operators.windows import window_metrics
from haulmetric.plans.layers import build_silver
from haulmetric.plans.reports import layer_heartbeat
from haulmetric.settings import Settings
from haulmetric.sources.bus import encode_nested

SAMPLE = {
    "vehicle": "TRK-CHI-0854", "ambientTempC": 26.5, "cargoContainerTempC": 3.2,
    "relativeHumidityPct": 55.4, "vibrationG": 0.04,
}


def test_sample_record_is_rejected_for_its_time_pattern(spark):
    bronze = envelope(spark, [body(time="2026-06-20T22:15:30Z", **SAMPLE)])
    assert build_silver(bronze).count() == 0
    assert rejected_events(decode_nested(bronze)).first().vehicle_id == "TRK-CHI-0854"


def test_further_time_patterns_can_be_allowed(spark):
    bronze = envelope(spark, [body(time="2026-06-20T22:15:30Z", **SAMPLE)])
    settings = Settings(time_patterns=("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    assert build_silver(bronze, settings).count() == 1


def test_sample_record_measures(spark):
    row = build_silver(envelope(spark, [body(**SAMPLE)])).first()
    assert row.temp_delta == -23.3
    assert row.dew_point == -4.87
    assert row.condensation_risk is False
    assert (row.cargo_temp, row.door_status) == (3.2, "CLOSED")


@pytest.mark.parametrize("text", ["not json", "[]", None, "", '{"VehicleId": "x"}'])
def test_unusable_bodies_are_rejected_without_an_error(spark, text):
    decoded = decode_nested(envelope(spark, [text]))
    assert valid_events(decoded).count() == 0
    assert rejected_events(decoded).count() == 1
    flat = decode_flat(envelope(spark, [text]))
    assert valid_events(flat).count() == 0


def test_wrong_leaf_type_spoils_only_the_leaf(spark):
    row = build_silver(envelope(spark, [body(ambientTempC="oops")])).first()
    assert row.ambient_temp is None and row.temp_delta is None
    assert row.cargo_temp == 4.0 and row.dew_point is not None


def test_missing_struct_keeps_the_row(spark):
    text = json.dumps({"vehicleId": "A-1", "timestamp": at(0).strftime("%Y-%m-%d %H:%M:%S")})
    silver = build_silver(envelope(spark, [text]))
    row = silver.first()
    assert row.cargo_temp is None and row.dew_point is None and row.condensation_risk is None
    gold = window_metrics(silver).first()
    assert gold.avg_cargo_temp is None and gold.door_open_count == 0
    assert gold.anomaly_flag is None


def test_invalid_utf8_does_not_fail(spark):
    frame = spark.createDataFrame([(bytearray(b"\xff\xfe{"),)], "value binary")
    assert valid_events(decode_nested(frame)).count() == 0


@pytest.mark.parametrize(
    ("readings", "dew"),
    [
        ({"relativeHumidityPct": 0.0}, None),
        ({"relativeHumidityPct": -5.0}, None),
        ({"cargoContainerTempC": -237.7}, None),
        ({"cargoContainerTempC": 10.0, "relativeHumidityPct": 100.0}, 10.0),
    ],
)
def test_dew_point_edges(spark, readings, dew):
    row = build_silver(envelope(spark, [body(**readings)])).first()
    assert row.dew_point == dew
    assert row.condensation_risk is (None if dew is None else True)


@pytest.mark.parametrize(("gap", "risk"), [(2.0, False), (1.99, True)])
def test_condensation_gap_is_strict(spark, gap, risk):
    from haulmetric.operators.enrich import add_condensation_risk

    frame = clean(spark, [{"cargo_temp": 10.0, "dew_point": 10.0 - gap}]).drop("condensation_risk")
    assert add_condensation_risk(frame).first().condensation_risk is risk


@pytest.mark.parametrize(
    ("column", "value", "flag"),
    [
        ("cargo_temp", 8.0, False), ("cargo_temp", 8.004, False), ("cargo_temp", 8.01, True),
        ("cargo_temp", 8.0046, False), ("cargo_temp", 8.0051, True),
        ("vibration", 3.0, False), ("vibration", 3.004, False), ("vibration", 3.01, True),
        ("door_status", "OPEN", True), ("door_status", None, False),
    ],
)
def test_window_thresholds_apply_to_rounded_values(spark, column, value, flag):
    rows = window_metrics(clean(spark, [{column: value}])).collect()
    assert len(rows) == 6
    assert {row.anomaly_flag for row in rows} == {flag}


def test_event_belongs_to_six_windows(spark):
    starts = [row.window_start for row in window_metrics(clean(spark, [{"seconds": 10}])).collect()]
    offsets = [round((s - at(0).replace(tzinfo=None)).total_seconds()) for s in starts]
    assert sorted(offsets) == [-40, -30, -20, -10, 0, 10]


def test_nan_reading_is_left_out_of_averages_and_event_flags(spark):
    text = body(seconds=1).replace('"cargoContainerTempC": 4.0', '"cargoContainerTempC": NaN')
    silver = build_silver(envelope(spark, [body(seconds=0), text]))
    assert silver.filter(F.isnan("cargo_temp")).count() == 1
    assert fleet.anomaly_events(silver).count() == 0
    assert {row.avg_cargo_temp for row in window_metrics(silver).collect()} == {4.0}
    assert fleet.latest_per_vehicle(silver).first().cargo_temp == 4.0


def test_mean_is_half_up_and_order_free(spark):
    frame = spark.createDataFrame([(0.005,), (0.005,), (-0.005,), (float("nan"),)], "x double")
    def mean(values):
        return values.agg(exact_mean(F.col("x")).alias("m")).first().m
    assert mean(frame.filter("x > 0 and not isnan(x)")) == 0.01
    assert mean(frame.filter("x < 0")) == -0.01
    assert mean(frame) == 0.0
    assert math.copysign(1, mean(frame.filter("x < 0").selectExpr("x / 5 as x"))) == 1.0
    assert mean(frame.filter("false")) is None


def test_map_centre_over_many_positions(spark):
    trail = spark.range(20_000_000).selectExpr("41.88D AS lat", "-87.65D AS lon")
    row = fleet.map_center(trail).first()
    assert (row.lat, row.lon) == (41.88, -87.65)


def test_rounding_happens_once(spark):
    frame = clean(spark, [{"cargo_temp": 8.0046}])
    assert {row.avg_cargo_temp for row in window_metrics(frame).collect()} == {8.0}
    frame = clean(spark, [{"cargo_temp": 8.0051}])
    assert {row.avg_cargo_temp for row in window_metrics(frame).collect()} == {8.01}


def test_readings_beyond_any_long_are_missing(spark):
    rows = window_metrics(clean(spark, [{"cargo_temp": 1e300}, {"seconds": 1, "cargo_temp": 4.0}]))
    assert {row.avg_cargo_temp for row in rows.collect()} == {4.0}


def test_latest_state_is_the_last_known_value_per_column(spark):
    frame = clean(
        spark,
        [
            {"seconds": 0, "cargo_temp": 1.0, "door_status": "OPEN", "humidity": 40.0},
            {"seconds": 5, "cargo_temp": 2.0, "door_status": "CLOSED", "condensation_risk": True},
            {"seconds": 9, "cargo_temp": None, "door_status": None, "humidity": None,
             "condensation_risk": None},
            {"seconds": 3, "vehicle_id": "B", "door_status": None},
        ],
    )
    rows = {row.vehicle_id: row for row in fleet.latest_per_vehicle(frame).collect()}
    first = rows["TRK-CHI-0001"]
    assert first.timestamp.replace(tzinfo=None) == at(9).replace(tzinfo=None)
    assert (first.cargo_temp, first.door_status) == (2.0, "CLOSED")
    assert (first.humidity, first.condensation_risk) == (50.0, True)
    assert rows["B"].door_status is None


def test_event_thresholds_are_strict(spark):
    frame = clean(
        spark,
        [
            {"vehicle_id": "a", "cargo_temp": 8.0}, {"vehicle_id": "b", "cargo_temp": 8.01},
            {"vehicle_id": "c", "vibration": 3.0}, {"vehicle_id": "d", "vibration": 3.01},
            {"vehicle_id": "e", "door_status": "OPEN"},
            {"vehicle_id": "f", "condensation_risk": True},
        ],
    )
    latest = fleet.latest_per_vehicle(frame)
    assert {r.vehicle_id for r in fleet.active_anomalies(latest).collect()} == {"b", "d", "e"}
    assert {r.vehicle_id for r in fleet.active_condensation(latest).collect()} == {"f"}
    assert {r.vehicle_id for r in fleet.anomaly_events(frame).collect()} == {"b", "d", "e", "f"}
    kinds = {(r.kind, r.vehicle_id) for r in fleet.alert_feed(latest).collect()}
    assert kinds == {("anomaly", "b"), ("anomaly", "d"), ("anomaly", "e"), ("condensation", "f")}


@pytest.mark.parametrize(("cargo", "status"), [(6.0, "ok"), (6.001, "alert"), (None, "ok")])
def test_fleet_mean_limit_uses_the_unrounded_mean(spark, cargo, status):
    row = fleet.fleet_kpis(clean(spark, [{"cargo_temp": cargo}])).first()
    assert row.cargo_temp_status == status and row.sample_events == 1


def test_kpis_of_no_events(spark):
    row = fleet.fleet_kpis(clean(spark, [{}]).filter("false")).first()
    assert (row.sample_events, row.active_anomalies, row.avg_cargo_temp) == (0, 0, None)
    assert row.cargo_temp_status == "ok"


def test_heartbeat_of_empty_layers(spark):
    silver = clean(spark, [{}]).filter("false")
    rows = layer_heartbeat(envelope(spark, ["x"]).filter("false"), silver, window_metrics(silver))
    found = {r.layer: (r.total, r.latest, r.latest_offset) for r in rows.collect()}
    assert found == {
        "bronze": (0, "N/A", 0), "silver": (0, "N/A", None), "gold": (0, "N/A", None),
    }


def test_heartbeat_of_missing_layers(spark):
    found = layer_heartbeat(None, clean(spark, [{}]), None).collect()
    assert [(r.layer, r.total) for r in found] == [("bronze", 0), ("silver", 1), ("gold", 0)]
    assert (found[0].latest, found[0].latest_offset) == ("N/A", 0)


def test_vehicle_slots(spark):
    frame = spark.createDataFrame(
        [("TRK-CHI-0001",), ("TRK-CHI-0011",), ("A-0",), ("TRUCK-X",), ("7",)], "v string"
    )
    slots = dict(frame.select("v", vehicle_slot(F.col("v"))).collect())
    assert (slots["TRK-CHI-0001"], slots["TRK-CHI-0011"], slots["A-0"], slots["7"]) == (0, 0, 9, 6)
    assert 0 <= slots["TRUCK-X"] < 10


def test_trail_cuts_before_it_drops_incomplete_rows(spark):
    rows = [{"seconds": s, "latitude": None if s == 9 else 41.0 + s} for s in range(10)]
    trail = fleet.route_trail(clean(spark, rows), settings=Settings(trail_length=3)).collect()
    assert sorted(r.lat for r in trail) == [48.0, 49.0]
    assert {r.color for r in trail} == {"#00d2ff"}


def test_vehicle_selection(spark):
    frame = clean(spark, [{"vehicle_id": f"V-{i}"} for i in range(8)])
    assert fleet.select_vehicles(frame, []).count() == 8
    assert fleet.select_vehicles(frame, None).count() == 8
    assert fleet.select_vehicles(frame, ["V-3", "V-9"]).count() == 1
    chosen = frame.select("vehicle_id").filter("vehicle_id < 'V-6'")
    assert fleet.select_vehicles(frame, chosen).count() == 6


def test_dedup_keeps_the_first_arrival(spark):
    bodies = [body(seconds=1, ambientTempC=float(i)) for i in range(5)] + [body(seconds=2)]
    decoded = decode_nested(envelope(spark, bodies).repartition(3), keep=("partition", "offset"))
    rows = {r.timestamp: r.ambient_temp for r in first_arrival(decoded).collect()}
    assert sorted(rows.values()) == [0.0, 20.0]


def test_encoded_events_decode_to_themselves(spark):
    frame = clean(spark, [{"seconds": 1}, {"seconds": 2, "cargo_temp": None}])
    back = enrich(decode_nested(encode_nested(frame)))
    columns = ["timestamp", "vehicle_id", "cargo_temp", "humidity", "latitude"]
    assert back.select(columns).exceptAll(frame.select(columns)).isEmpty()
    assert back.count() == 2


@pytest.mark.parametrize(
    ("text", "second"),
    [
        ("2024-05-01T12:00:05Z", 5), ("2024-05-01T12:00:05.250Z", 5), ("2024-05-01 12:00:05", 5),
        ("2024-05-01T14:00:05+02:00", 5), ("yesterday", None), ("", None),
    ],
)
def test_flat_times_are_parsed_by_the_json_reader(spark, text, second):
    payload = json.dumps({"Timestamp": text, "Vehicle_ID": "A-1", "Cargo_Temp": 4.0})
    row = decode_flat(envelope(spark, [payload])).first()
    assert row.vehicle_id == "A-1"
    if second is None:
        assert row.timestamp is None
    else:
        assert (row.timestamp.minute, row.timestamp.second) == (0, second)


def test_flat_windows_stop_at_the_flag(spark):
    from haulmetric.plans.layers import build_flat_silver
    from haulmetric.schemas import FLAT_GOLD

    payload = json.dumps({
        "Timestamp": "2024-05-01T12:00:05Z", "Vehicle_ID": "A-1", "Ambient_Temp": 20.0,
        "Cargo_Temp": 9.0, "Humidity": 50.0, "Vibration": 0.1, "Door_Status": "CLOSED",
    })
    gold = window_metrics(build_flat_silver(envelope(spark, [payload, payload])))
    assert gold.columns == FLAT_GOLD.names
    assert {row.anomaly_flag for row in gold.collect()} == {True}
