"""

Each query derives the bronze envelopes from the whole `events` table and runs the library's
operators on them. Queries about storage or streams first land those rows in a fresh folder
below `spark.checkpoint.dir` (see `haulmetric.session.scratch_dir`).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import oracles
from haulmetric.operators import fleet, newest
from haulmetric.operators.decode import decode_flat, decode_nested
from haulmetric.operators.drift import payload_drift
from haulmetric.operators.enrich import add_dew_point, add_temp_delta, enrich
from haulmetric.operators.joins import alert_positions, window_causes
from haulmetric.operators.quality import (
    ARRIVAL,
    dedup_stream,
    first_arrival,
    rejected_events,
    valid_events,
)
from haulmetric.operators.rollup import (
    RANKS,
    daily_estimates,
    daily_exact,
    fleet_rollup,
    hourly_sketches,
    hourly_sums,
)
from haulmetric.operators.trips import door_episodes, trip_sessions
from haulmetric.operators.windows import anomaly_windows, window_metrics
from haulmetric.plans import compaction, reports, retention, upkeep
from haulmetric.plans.catalog import bootstrap_tables, schema_explorer
from haulmetric.plans.layers import (
    build_flat_silver,
    build_gold,
    build_silver,
    clean_events,
    write_layers,
)
from haulmetric.plans.reconcile import layer_reconcile
from haulmetric.schemas import (
    ENVELOPE,
    FLAT_SILVER,
    GOLD,
    LAYER_PARTITIONS,
    LAYER_SCHEMAS,
    LAYER_TIMES,
    SILVER,
)
from haulmetric.session import scratch_dir, use_time_zone
from haulmetric.settings import DEFAULTS, Settings
from haulmetric.sources import fixtures
from haulmetric.sources.bus import encode_nested, open_bus_files
from haulmetric.sources.tables import read_table, register_layers, stream_table, write_table
from haulmetric.streaming.chain import (
    flagged_events_stream,
    flat_silver_stream,
    gold_stream,
    run_once,
    silver_stream,
    trips_stream,
)
from haulmetric.streaming.sinks import append_to_path, append_to_table, drain

try:
    from haulmetric.llm import registry as training_data
except ModuleNotFoundError as error:
    if error.name not in ("haulmetric.llm", "haulmetric.llm.registry", "corpus_pipeline"):
        raise
    training_data = None

Query = Callable[[SparkSession, str], DataFrame]

SMOKE_DIR = "/root/testdata/sf0.001"


# --- layers derived from `events` -------------------------------------------------------


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_time_zone(spark)
    return fixtures.read_events(spark, sf_dir)


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.nested_envelope(_events(spark, sf_dir))


def _flat_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.flat_envelope(_events(spark, sf_dir))


def _decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_nested(_bronze(spark, sf_dir), keep=ARRIVAL)


def _valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_events(_decoded(spark, sf_dir))


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_silver(_bronze(spark, sf_dir))


def _gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_gold(_silver(spark, sf_dir))


def _stored(spark: SparkSession, sf_dir: str) -> Settings:
    """The three layers as tables in a fresh folder."""
    settings = DEFAULTS.at(scratch_dir(spark, "layers"))
    write_layers(spark, _bronze(spark, sf_dir), settings)
    return settings


# --- decoding and derived measures ------------------------------------------------------

SAMPLE = (
    "offset", "timestamp", "vehicle_id", "ambient_temp", "cargo_temp", "humidity", "vibration",
    "door_status", "latitude", "longitude",
)


def parse_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_flat(_flat_bronze(spark, sf_dir), keep=("offset",))


def payload_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean events, encoded as message bodies and decoded again."""
    return decode_nested(encode_nested(clean_events(_bronze(spark, sf_dir))))


def condensation_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(_valid(spark, sf_dir)).select(
        "offset", "cargo_temp", "dew_point", "condensation_risk"
    )


# --- fleet status ------------------------------------------------------------------------


def _status() -> dict[str, Query]:
    def over_events(operator: Callable[[DataFrame], DataFrame]) -> Query:
        return lambda spark, sf_dir: operator(_silver(spark, sf_dir))

    def over_latest(operator: Callable[[DataFrame], DataFrame]) -> Query:
        return over_events(lambda events: operator(fleet.latest_per_vehicle(events)))

    return {
        "latest_per_vehicle": over_latest(lambda latest: latest),
        "fleet_kpis": over_events(fleet.fleet_kpis),
        "active_anomalies": over_latest(fleet.active_anomalies),
        "active_condensation": over_latest(fleet.active_condensation),
        "alert_feed": over_latest(fleet.alert_feed),
        "route_trail": over_events(fleet.route_trail),
        "map_center": over_events(lambda events: fleet.map_center(fleet.route_trail(events))),
        "timeline_cargo": over_events(lambda events: fleet.timeline(events, "cargo_temp")),
        "timeline_vibration": over_events(lambda events: fleet.timeline(events, "vibration")),
    }


# --- cross-layer reports ----------------------------------------------------------------


def _of_layers(report: Callable[..., DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        bronze = _bronze(spark, sf_dir)
        silver = build_silver(bronze)
        return report(bronze, silver, build_gold(silver))

    return query


# --- stored layers ----------------------------------------------------------------------


def _database() -> str:
    return f"telemetry_{uuid.uuid4().hex}"


def _result(spark: SparkSession, frame: DataFrame, database: str) -> DataFrame:
    """The rows in a folder of their own, so that the database they came from can go."""
    path = scratch_dir(spark, "result")
    write_table(frame, f"{path}/rows")
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return spark.read.schema(frame.schema).parquet(f"{path}/rows")


def register_layers_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = register_layers(spark, _stored(spark, sf_dir).layer_paths())
    return spark.sql(
        " UNION ALL ".join(f"SELECT '{name}' AS layer, count(*) AS total FROM {name}" for name in names)
    )


def _with_totals(spark: SparkSession, listing: DataFrame, names: dict[str, str]) -> DataFrame:
    """Add the number of rows of each layer to a listing of columns."""
    totals = " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, count(*) AS total_rows FROM {name}" for layer, name in names.items()
    )
    return listing.join(spark.sql(totals), "layer")


def schema_explorer_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {name: name for name in register_layers(spark, _stored(spark, sf_dir).layer_paths())}
    return _with_totals(spark, schema_explorer(spark, names), names)


def bootstrap_tables_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create the catalog tables, twice, then fill them and list what the catalog holds."""
    database = _database()
    settings = replace(
        DEFAULTS.at(scratch_dir(spark, "catalog")),
        bronze_table=f"{database}.bronze",
        silver_table=f"{database}.silver",
        gold_table=f"{database}.gold",
    )
    bootstrap_tables(spark, settings)
    bootstrap_tables(spark, settings)
    write_layers(spark, _bronze(spark, sf_dir), settings)
    tables = settings.layer_tables()
    spark.sql(f"MSCK REPAIR TABLE {tables['silver']}")
    for table in tables.values():
        spark.catalog.refreshTable(table)
    # The catalog lists partition columns last, so positions differ from the declared ones.
    listing = _with_totals(spark, schema_explorer(spark, tables), tables).drop("position")
    return _result(spark, listing, database)


def adhoc_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = """
        SELECT s.vehicle_id, s.events, g.windows, g.flagged,
               (SELECT count(*) FROM bronze) AS envelopes
        FROM (SELECT Vehicle_ID, count(*) AS events FROM silver GROUP BY Vehicle_ID) s
        JOIN (SELECT Vehicle_ID, count(*) AS windows, count_if(Anomaly_Flag) AS flagged
              FROM gold GROUP BY Vehicle_ID) g
          ON s.vehicle_id = g.vehicle_id"""
    return reports.run_sql(spark, text, _stored(spark, sf_dir))


def bronze_latest_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest envelopes of a stored table, without reading the bodies of the others."""
    path = scratch_dir(spark, "bronze")
    write_table(_bronze(spark, sf_dir), path)
    return newest.bronze_latest(read_table(spark, path, ENVELOPE), by_cutoff=True)


def silver_partition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "silver")
    write_table(_silver(spark, sf_dir), path, partition_by=LAYER_PARTITIONS["silver"])
    return (
        read_table(spark, path, SILVER)
        .groupBy("vehicle_id")
        .agg(F.count(F.lit(1)).alias("total"))
    )


def compact_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings = _stored(spark, sf_dir)
    target = f"{scratch_dir(spark, 'compacted')}/gold"
    upkeep.compact(spark, settings.gold_path, target, GOLD, settings)
    return read_table(spark, target, GOLD)


def cluster_by_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings = _stored(spark, sf_dir)
    target = f"{scratch_dir(spark, 'clustered')}/silver"
    upkeep.cluster_by_time(
        spark, settings.silver_path, target, SILVER,
        partition_by=LAYER_PARTITIONS["silver"], settings=settings,
    )
    return read_table(spark, target, SILVER)


def maintain_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upkeep of all layers, with row counts before and after."""
    settings = _stored(spark, sf_dir)
    root = scratch_dir(spark, "maintained")
    outcome = upkeep.maintain_layers(spark, settings, root)
    after = DEFAULTS.at(root).layer_paths()
    rows = F.count(F.lit(1))
    report = None
    for layer, operation, status in outcome:
        schema = LAYER_SCHEMAS[layer]
        counts = (
            read_table(spark, settings.layer_paths()[layer], schema)
            .select(F.lit("rows_before").alias("side"))
            .unionByName(
                read_table(spark, after[layer], schema).select(F.lit("rows_after").alias("side"))
            )
            .groupBy()
            .agg(
                F.count_if(F.col("side") == "rows_before").alias("rows_before"),
                F.count_if(F.col("side") == "rows_after").alias("rows_after"),
            )
        )
        row = counts.select(
            F.lit(layer).alias("layer"), F.lit(operation).alias("operation"),
            F.lit(status).alias("status"), "rows_before", "rows_after",
        )
        report = row if report is None else report.unionByName(row)
    return report


def retention_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    def tiers(layer: str, frame: DataFrame, horizon: str) -> DataFrame:
        time = LAYER_TIMES[layer]
        return (
            upkeep.retention_tiers(frame, time, horizon)
            .groupBy(F.lit(layer).alias("layer"), "tier")
            .agg(
                F.count(F.lit(1)).alias("total"),
                F.min(time).alias("oldest"),
                F.max(time).alias("newest"),
            )
        )

    def report(bronze: DataFrame, silver: DataFrame, gold: DataFrame) -> DataFrame:
        return (
            tiers("bronze", bronze, "7 DAYS")
            .unionByName(tiers("silver", silver, "3 HOURS"))
            .unionByName(tiers("gold", gold, "1 HOUR"))
        )

    return _of_layers(report)(spark, sf_dir)


def retention_move(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the windows lie after two moves of what is older than an hour."""
    root = scratch_dir(spark, "tiers")
    tier = retention.Tier(
        f"{root}/hot", f"{root}/archive", GOLD, "window_end", ("vehicle_id", "window_start"), unit="hour"
    )
    retention.write_tier(_gold(spark, sf_dir), tier.hot, tier)
    for _ in range(2):
        retention.move_expired(spark, tier, "1 HOUR")
    hot, archive = (
        retention.read_tier(spark, path, tier).withColumn("tier", F.lit(name))
        for name, path in (("hot", tier.hot), ("archive", tier.archive))
    )
    return hot.unionByName(archive)


def compact_small_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gold layer after its small files were merged; the file of target size was left alone."""
    path = scratch_dir(spark, "gold")
    gold = read_table(spark, _stored(spark, sf_dir).gold_path, GOLD)
    odd = F.xxhash64("vehicle_id", "window_start") % 4 == 0
    write_table(gold.filter(~odd).coalesce(1), path)
    largest = read_table(spark, path, GOLD).agg(F.max("_metadata.file_size")).first()[0]
    write_table(gold.filter(odd).repartition(16), path)
    settings = replace(DEFAULTS, target_file_bytes=2 * largest)
    compaction.compact_small_files(spark, path, GOLD, settings=settings)
    return read_table(spark, path, GOLD)


# --- roll-ups and differences ---------------------------------------------------------------


def fleet_rollup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All levels from stored hourly sums."""
    path = scratch_dir(spark, "hourly")
    write_table(hourly_sums(_silver(spark, sf_dir)), path)
    return fleet_rollup(spark.read.parquet(path))


def vehicle_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Estimates from stored hourly sketches, as whether they lie within the stated errors."""
    path = scratch_dir(spark, "sketches")
    silver = _silver(spark, sf_dir)
    write_table(hourly_sketches(silver), path)
    estimates, exact = daily_estimates(spark.read.parquet(path)), daily_exact(silver)
    # A quantile is judged by its rank among the readings.
    day = F.date_trunc("day", "timestamp")
    ranked = silver.select("vehicle_id", day.alias("day"), "cargo_temp").join(
        estimates.select("vehicle_id", "day", *RANKS), ["vehicle_id", "day"]
    )
    ranks = ranked.groupBy("vehicle_id", "day").agg(
        *(F.count_if(F.col("cargo_temp") < F.col(n)).alias(f"{n}_below") for n in RANKS),
        *(F.count_if(F.col("cargo_temp") <= F.col(n)).alias(f"{n}_upto") for n in RANKS),
    )
    n = F.col("cargo_readings")

    def close(name: str, rank: float) -> Column:
        return (F.col(f"{name}_below") <= (rank + 0.0166) * n) & (F.col(f"{name}_upto") >= (rank - 0.0166) * n)

    return (
        estimates.withColumnRenamed("positions", "estimate")
        .join(exact.select("vehicle_id", "day", "positions"), ["vehicle_id", "day"])
        .join(ranks, ["vehicle_id", "day"])
        .select(
            "vehicle_id", "day", "cargo_readings",
            (F.abs(F.col("estimate") - F.col("positions")) <= 0.08 * F.col("positions")).alias("positions_close"),
            *(close(name, rank).alias(f"{name}_close") for name, rank in RANKS.items()),
        )
    )


def payload_drift_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A topic that carries both payload shapes."""
    return payload_drift(_bronze(spark, sf_dir).unionByName(_flat_bronze(spark, sf_dir)))


def layer_reconcile_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored layers, with some events lost from silver and others doubled."""
    settings = _stored(spark, sf_dir)
    bronze = read_table(spark, settings.bronze_path, ENVELOPE)
    silver = read_table(spark, settings.silver_path, SILVER)
    second = F.unix_seconds("timestamp")
    copies = F.when(second % 50 == 0, 0).when(second % 70 == 0, 3).otherwise(1)
    path = scratch_dir(spark, "damaged")
    write_table(silver.withColumn("n", F.explode(F.array_repeat(F.lit(1), copies))).drop("n"), path)
    found = layer_reconcile(bronze, read_table(spark, path, SILVER))
    return found.select("side", F.col("copies").cast("long").alias("copies"), *SILVER.names)


# --- streams ----------------------------------------------------------------------------


def _land(spark: SparkSession, frame: DataFrame, path: str | None = None) -> str:
    path = path or scratch_dir(spark, "landing")
    frame.write.mode("append").parquet(path)
    return path


def _stream_out(frame: DataFrame, *, partition_by: tuple[str, ...] = ()) -> str:
    """Run a stream over the rows at hand and return the folder it appended to."""
    root = scratch_dir(frame.sparkSession, "stream")
    drain(append_to_path(frame, f"{root}/out", f"{root}/checkpoint", partition_by=partition_by))
    return f"{root}/out"


def ingest_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    bus = open_bus_files(spark, _land(spark, _bronze(spark, sf_dir)))
    out = _stream_out(bus.select("topic", "partition", "offset", "timestamp"))
    return spark.read.parquet(out)


def bronze_stream_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of the raw append stream from one checkpoint, with new rows in between."""
    landing = _land(spark, _bronze(spark, sf_dir))
    root = scratch_dir(spark, "bronze")
    bus = open_bus_files(spark, landing)
    drain(append_to_path(bus, f"{root}/out", f"{root}/checkpoint"))
    _land(spark, _flat_bronze(spark, sf_dir), landing)
    drain(append_to_path(bus, f"{root}/out", f"{root}/checkpoint"))
    return read_table(spark, f"{root}/out", ENVELOPE).select(
        "topic", "partition", "offset", "timestamp", F.col("value").cast("string").alias("payload")
    )


def stream_to_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat stream, as it comes, into a catalog table."""
    bus = open_bus_files(spark, _land(spark, _flat_bronze(spark, sf_dir)))
    root = scratch_dir(spark, "table")
    database = _database()
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/database'")
    drain(append_to_table(flat_silver_stream(bus), f"{database}.silver", f"{root}/checkpoint"))
    return _result(spark, spark.table(f"{database}.silver").select(FLAT_SILVER.names), database)


def stream_dedup_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that the low-latency dedup of all raw envelopes lets through."""
    bus = open_bus_files(spark, _land(spark, _bronze(spark, sf_dir)))
    events = valid_events(decode_nested(bus, keep=ARRIVAL))
    return spark.read.parquet(
        _stream_out(
            dedup_stream(events, settings=replace(DEFAULTS, dedup_mode="fast")).select(
                "vehicle_id", "timestamp"
            )
        )
    )


def stream_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    bus = open_bus_files(spark, _land(spark, _bronze(spark, sf_dir)))
    out = _stream_out(silver_stream(bus), partition_by=LAYER_PARTITIONS["silver"])
    return read_table(spark, out, SILVER)


def stream_window_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = _land(spark, _silver(spark, sf_dir))
    out = _stream_out(gold_stream(stream_table(spark, landing, SILVER)))
    return read_table(spark, out, GOLD)


def stream_late_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events, then all of them again: the second, late delivery must change nothing."""
    silver = _silver(spark, sf_dir)
    landing = _land(spark, silver)
    root = scratch_dir(spark, "late")
    windows = gold_stream(stream_table(spark, landing, SILVER))
    drain(append_to_path(windows, f"{root}/out", f"{root}/checkpoint"))
    _land(spark, silver, landing)
    drain(append_to_path(windows, f"{root}/out", f"{root}/checkpoint"))
    return read_table(spark, f"{root}/out", GOLD)


#: Short enough for several trips of each vehicle in compressed time.
SHORT_GAP = replace(DEFAULTS, trip_gap="1 minute")


def trip_sessions_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = _silver(spark, sf_dir)
    return (
        trip_sessions(silver).withColumn("gap", F.lit(DEFAULTS.trip_gap))
        .unionByName(trip_sessions(silver, SHORT_GAP).withColumn("gap", F.lit(SHORT_GAP.trip_gap)))
    )


def stream_trip_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = _land(spark, _silver(spark, sf_dir))
    trips = trips_stream(stream_table(spark, landing, SILVER), SHORT_GAP)
    return spark.read.schema(trips.schema).parquet(_stream_out(trips))


def stream_flagged_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver stream joined with the gold stream."""
    silver = _silver(spark, sf_dir)
    sides = {"silver": _land(spark, silver), "gold": _land(spark, build_gold(silver))}
    joined = flagged_events_stream(
        stream_table(spark, sides["silver"], SILVER), stream_table(spark, sides["gold"], GOLD)
    )
    return spark.read.schema(joined.schema).parquet(_stream_out(joined))


def layers_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bus -> bronze -> silver -> gold as three chained streams."""
    landing = _land(spark, _bronze(spark, sf_dir))
    settings = DEFAULTS.at(scratch_dir(spark, "chain"))
    run_once(open_bus_files(spark, landing), settings)
    return read_table(spark, settings.gold_path, GOLD)


# --- contract ---------------------------------------------------------------------------


def queries() -> dict[str, Query]:
    """Every registered query; those on training data only where their package is present."""
    return telemetry_queries() | (training_data.queries() if training_data else {})


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql() | (training_data.oracle_sql() if training_data else {})


def telemetry_queries() -> dict[str, Query]:
    def on(source: Query, operator: Callable[[DataFrame], DataFrame]) -> Query:
        return lambda spark, sf_dir: operator(source(spark, sf_dir))

    console = reports.console()
    registered: dict[str, Query] = {
        # decoding and derived measures
        "parse_nested": on(_decoded, lambda events: events.select(*SAMPLE)),
        "parse_flat": parse_flat,
        "payload_roundtrip": payload_roundtrip,
        "valid_events": on(_valid, lambda events: events.select(*SAMPLE)),
        "rejected_events": on(_decoded, lambda events: rejected_events(events).select(*SAMPLE)),
        "dedup_first": on(_valid, lambda events: first_arrival(events).select(*SAMPLE)),
        "temp_delta": on(
            _valid,
            lambda events: add_temp_delta(events).select(
                "offset", "cargo_temp", "ambient_temp", "temp_delta"
            ),
        ),
        "dew_point": on(
            _valid,
            lambda events: add_dew_point(events).select(
                "offset", "cargo_temp", "humidity", "dew_point"
            ),
        ),
        "condensation_risk": condensation_risk,
        "silver_events": _silver,
        "flat_silver": on(_flat_bronze, build_flat_silver),
        # windows
        "window_metrics": _gold,
        "anomaly_windows": on(_gold, anomaly_windows),
        "flat_window_metrics": on(
            _flat_bronze, lambda bronze: window_metrics(build_flat_silver(bronze))
        ),
        # whole-table reports
        "vehicle_totals": _of_layers(console["vehicle_totals"]),
        "risk_events": on(_silver, fleet.anomaly_events),
        "vehicle_ids": on(_silver, fleet.vehicle_ids),
        "vehicle_slot": on(_silver, fleet.vehicle_slots),
        "layer_heartbeat": _of_layers(reports.layer_heartbeat),
        "partition_offsets": on(_bronze, reports.partition_offsets),
        "layer_feed": _of_layers(reports.layer_feed),
        # newest-k reports
        "bronze_latest": on(_bronze, newest.bronze_latest),
        "payload_preview": on(_bronze, newest.payload_preview),
        "silver_latest": on(_silver, newest.silver_latest),
        "silver_recent": on(
            _silver, lambda silver: newest.silver_recent(silver, DEFAULTS.recent_rows)
        ),
        "gold_latest": on(_gold, newest.gold_latest),
        "gold_recent": on(_gold, newest.gold_recent),
        "anomaly_events": _of_layers(console["anomaly_events"]),
        "console_latest_events": _of_layers(console["console_latest_events"]),
        "console_gold": _of_layers(console["console_gold"]),
        "console_raw": _of_layers(console["console_raw"]),
        # stored layers
        "register_layers": register_layers_query,
        "schema_explorer": schema_explorer_query,
        "bootstrap_tables": bootstrap_tables_query,
        "adhoc_sql": adhoc_sql,
        "bronze_latest_stored": bronze_latest_stored,
        "silver_partition_counts": silver_partition_counts,
        "compact_layer": compact_layer,
        "cluster_by_time": cluster_by_time,
        "maintain_layers": maintain_layers,
        "retention_split": retention_split,
        "retention_move": retention_move,
        "compact_small_files": compact_small_files,
        # joins along time, trips and episodes
        "window_causes": _of_layers(lambda bronze, silver, gold: window_causes(gold, silver)),
        "alert_positions": on(_silver, alert_positions),
        "trip_sessions": trip_sessions_query,
        "door_episodes": on(_silver, door_episodes),
        # roll-ups and differences
        "fleet_rollup": fleet_rollup_query,
        "vehicle_sketches": vehicle_sketches,
        "vehicle_days": on(_silver, daily_exact),
        "payload_drift": payload_drift_query,
        "layer_reconcile": layer_reconcile_query,
        # streams
        "stream_trip_sessions": stream_trip_sessions,
        "stream_flagged_events": stream_flagged_events,
        "ingest_envelope": ingest_envelope,
        "bronze_stream_append": bronze_stream_append,
        "stream_to_table": stream_to_table,
        "stream_dedup_keys": stream_dedup_keys,
        "stream_silver": stream_silver,
        "stream_window_metrics": stream_window_metrics,
        "stream_late_drop": stream_late_drop,
        "layers_end_to_end": layers_end_to_end,
    }
    return registered | _status()


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: window aggregates of the whole fleet, from raw envelopes."""
    return _gold(spark, SMOKE_DIR)
