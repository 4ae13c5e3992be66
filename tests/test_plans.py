"""Physical plans: what must hold for the operators to survive much larger tables."""

import re

import __spark_entry__ as entry
import pytest
from helpers import plan_of

from haulmetric.operators import fleet, newest
from haulmetric.operators.decode import decode_nested
from haulmetric.operators.quality import first_arrival, valid_events
from haulmetric.operators.windows import window_metrics
from haulmetric.plans.layers import build_silver
from haulmetric.plans.reports import layer_heartbeat
from haulmetric.schemas import ENVELOPE
from haulmetric.session import session_conf
from haulmetric.sources.tables import read_table, write_table

# These run streams or write tables before they return a frame.
STORED = {
    "register_layers", "bronze_latest_stored", "schema_explorer", "bootstrap_tables", "adhoc_sql",
    "silver_partition_counts", "compact_layer", "cluster_by_time", "maintain_layers",
    "ingest_envelope", "bronze_stream_append", "stream_to_table", "stream_dedup_keys",
    "stream_silver", "stream_window_metrics", "stream_late_drop", "layers_end_to_end",
}
LAZY = sorted(set(entry.telemetry_queries()) - STORED)


@pytest.fixture(scope="module")
def bronze(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("bronze"))
    write_table(entry._bronze(spark, sf_dir), path)
    return read_table(spark, path, ENVELOPE)


@pytest.mark.parametrize("name", LAZY)
def test_no_query_has_a_cross_join_or_a_python_worker(spark, sf_dir, name):
    plan = plan_of(entry.telemetry_queries()[name](spark, sf_dir))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "Arrow"):
        assert operator not in plan
    assert "Scan parquet" in plan


def test_each_body_is_parsed_once(bronze):
    plan = plan_of(build_silver(bronze))
    assert plan.count("from_json") == 1
    assert plan.count("try_to_timestamp") == 1
    assert "ReadSchema: struct<value:binary,partition:int,offset:bigint>" in plan


def test_parser_skips_fields_nobody_reads(bronze):
    plan = plan_of(decode_nested(bronze))
    assert "eventId" not in plan and "destination" not in plan


def test_dedup_cuts_each_key_before_the_shuffle(bronze):
    plan = plan_of(first_arrival(valid_events(decode_nested(bronze, keep=("partition", "offset")))))
    exchange = plan.index("Exchange hashpartitioning(vehicle_id")
    assert plan.count("Exchange ") == 1
    assert 0 < plan.index("Final") < exchange < plan.index("Partial")


def test_window_aggregate_has_one_shuffle_and_a_partial_step(silver):
    plan = plan_of(window_metrics(silver))
    assert plan.count("Exchange ") == 1
    assert plan.count("HashAggregate") - plan.count("ObjectHashAggregate") == 2
    assert "SortAggregate" not in plan
    # Unused columns are not read.
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert "latitude" not in schema and "humidity" not in schema


def test_latest_state_passes_over_events_with_a_hash_aggregate(silver):
    plan = plan_of(fleet.latest_per_vehicle(silver))
    below = plan[plan.index("Exchange hashpartitioning(vehicle_id#", plan.index("door_status")):]
    assert "HashAggregate(keys=[vehicle_id" in below
    assert "Sort" not in below[below.index("HashAggregate"):]


def test_trail_cuts_each_vehicle_before_the_shuffle(silver):
    plan = plan_of(fleet.route_trail(silver))
    exchange = plan.index("Exchange hashpartitioning(vehicle_id")
    assert exchange < plan.index("Partial")


@pytest.mark.parametrize(
    "report", [newest.bronze_latest, newest.payload_preview], ids=["latest", "preview"]
)
def test_newest_reports_are_top_k_with_late_projection(bronze, report):
    plan = plan_of(report(bronze))
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan
    # No projection below it: the text is made for k rows only.
    assert "Project [" not in plan


def test_newest_rows_of_a_stored_table_are_found_by_a_pushed_cutoff(bronze):
    frame = newest.bronze_latest(bronze, by_cutoff=True)
    plan = plan_of(frame)
    assert "GreaterThanOrEqual(timestamp,ScalarSubquery" in plan
    assert "ReadSchema: struct<timestamp:timestamp>" in plan
    assert frame.collect() == newest.bronze_latest(bronze).collect()
    for k in (1, 7, 100_000):
        plain = newest.newest(bronze, k, "timestamp", newest.BRONZE_TIES)
        cut = newest.newest(bronze, k, "timestamp", newest.BRONZE_TIES, by_cutoff=True)
        assert cut.collect() == plain.collect()


def test_newest_by_cutoff_with_ties_and_few_rows(silver):
    for k in (3, 10**6):
        plain = newest.silver_recent(silver, k).collect()
        assert newest.silver_recent(silver, k, by_cutoff=True).collect() == plain


def test_fleet_reports_over_a_sample_start_from_a_top_k(silver):
    plan = plan_of(fleet.fleet_kpis(newest.silver_recent(silver)))
    assert "TakeOrderedAndProject(limit=500" in plan


def test_heartbeat_reads_two_columns_of_bronze_and_one_of_the_others(bronze, silver):
    gold = window_metrics(silver)
    plan = plan_of(layer_heartbeat(bronze, silver, gold))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas[0] == "offset:bigint,timestamp:timestamp"
    assert schemas[1] == "timestamp:timestamp"


def test_trail_query_parses_and_deduplicates_once(spark, sf_dir):
    plan = plan_of(entry.telemetry_queries()["route_trail"](spark, sf_dir))
    assert plan.count("from_json") == 1
    assert plan.count("Exchange hashpartitioning") == 2


def test_selection_is_not_broadcast_without_a_size_check(spark, silver):
    chosen = silver.select("vehicle_id").distinct()
    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        plan = plan_of(fleet.route_trail(silver, chosen))
        assert "BroadcastHashJoin" not in plan


def test_no_query_deals_rows_out_by_the_size_of_its_input(spark, sf_dir):
    assert "RoundRobin" not in plan_of(entry.telemetry_queries()["silver_events"](spark, sf_dir))
