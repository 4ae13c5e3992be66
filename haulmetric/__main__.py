"""Jobs to submit: `python -m haulmetric bootstrap | stream | maintain | check | sql | ...`."""

from __future__ import annotations

import argparse
import logging
import sys
import time

from pyspark.sql import DataFrame

from haulmetric.operators import fleet
from haulmetric.operators.drift import payload_drift
from haulmetric.operators.joins import alert_positions, window_causes
from haulmetric.operators.newest import bronze_latest, gold_latest, silver_latest
from haulmetric.operators.rollup import fleet_rollup, hourly_sums
from haulmetric.operators.trips import door_episodes, trip_sessions
from haulmetric.plans.catalog import bootstrap_tables
from haulmetric.plans.compaction import compact_small_files
from haulmetric.plans.reconcile import layer_reconcile
from haulmetric.plans.reports import layer_feed, layer_heartbeat, run_sql, stored_layers
from haulmetric.plans.retention import retain_gold
from haulmetric.plans.upkeep import maintain_layers
from haulmetric.schemas import LAYER_PARTITIONS, LAYER_SCHEMAS
from haulmetric.session import build_session
from haulmetric.settings import Settings, load_settings
from haulmetric.sources.bus import open_bus, open_bus_files
from haulmetric.sources.tables import read_table
from haulmetric.streaming.chain import run_once, start_all

log = logging.getLogger("haulmetric")


#: Reports that are one operator over the stored layers.
REPORTS = {
    "causes": lambda layers, settings: window_causes(layers["gold"], layers["silver"], settings),
    "positions": lambda layers, settings: alert_positions(layers["silver"], settings),
    "trips": lambda layers, settings: trip_sessions(layers["silver"], settings),
    "episodes": lambda layers, settings: door_episodes(layers["silver"]),
    "rollup": lambda layers, settings: fleet_rollup(hourly_sums(layers["silver"])),
    "drift": lambda layers, settings: payload_drift(layers["bronze"]),
    "reconcile": lambda layers, settings: layer_reconcile(layers["bronze"], layers["silver"], settings),
}


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="haulmetric")
    parser.add_argument(
        "--set", action="append", default=[], metavar="FIELD=VALUE", help="override a setting"
    )
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("bootstrap", help="create the database and the layer tables")
    stream = commands.add_parser("stream", help="run the three layer streams")
    stream.add_argument("--once", action="store_true", help="stop after the rows at hand")
    stream.add_argument("--files", help="folder of envelope files to read instead of the bus")
    maintain = commands.add_parser("maintain", help="write compacted and clustered snapshots")
    maintain.add_argument("target", help="folder for the snapshots")
    compact = commands.add_parser("compact", help="merge small files of a table in place")
    compact.add_argument("path")
    compact.add_argument("layer", choices=sorted(LAYER_SCHEMAS))
    retain = commands.add_parser("retain", help="publish gold by date, and archive what is past its horizon")
    retain.add_argument("target", help="folder for the hot and archived dates")
    commands.add_parser("check", help="show the newest rows of each layer")
    sql = commands.add_parser("sql", help="run SQL over the views bronze, silver and gold")
    sql.add_argument("text")
    sql.add_argument("--out", help="folder for all rows as Parquet, instead of printing them")
    sql.add_argument("--rows", type=int, help="print at most so many rows, and say how many are left")
    for name in ("heartbeat", "feed", "kpis", "alerts", "trail", *REPORTS):
        commands.add_parser(name, help=f"show the {name} of the stored layers")
    return parser.parse_args()


def main() -> None:
    logging.basicConfig(level=logging.INFO, format="%(levelname)s: haulmetric: %(message)s")
    arguments = _arguments()
    settings = load_settings(overrides=arguments.set)
    spark = build_session(f"haulmetric-{arguments.command}", settings)
    if arguments.command == "bootstrap":
        for table in bootstrap_tables(spark, settings):
            log.info("table %s is in place", table)
    elif arguments.command == "stream":
        if arguments.files:
            bus = open_bus_files(spark, arguments.files, settings)
        else:
            bus = open_bus(spark, settings)
        if arguments.once:
            run_once(bus, settings)
        else:
            bootstrap_tables(spark, settings)
            start_all(bus, settings)
            spark.streams.awaitAnyTermination()
    elif arguments.command == "maintain":
        # A folder of its own for each run, so that a failed one can be repeated.
        target = f"{arguments.target.rstrip('/')}/{time.strftime('%Y%m%dT%H%M%S', time.gmtime())}"
        outcome = maintain_layers(spark, settings, target)
        for layer, operation, status in outcome:
            log.info("%s %s: %s", operation, layer, status)
        if any(status not in ("done", "missing") for _, _, status in outcome):
            spark.stop()
            sys.exit(1)
    elif arguments.command == "compact":
        done = compact_small_files(
            spark, arguments.path, LAYER_SCHEMAS[arguments.layer],
            partition_by=LAYER_PARTITIONS[arguments.layer], settings=settings,
        )
        log.info("%s small files became %s", done.files_merged, done.files_written)
    elif arguments.command == "retain":
        for piece, rows in retain_gold(spark, arguments.target, settings):
            log.info("%s: %s rows archived", piece, rows)
    elif arguments.command == "check":
        reports = {"bronze": bronze_latest, "silver": silver_latest, "gold": gold_latest}
        for layer, path in settings.layer_paths().items():
            table = read_table(spark, path, LAYER_SCHEMAS[layer], settings.table_format)
            reports[layer](table, by_cutoff=True).show(truncate=False)
    elif arguments.command == "sql":
        result = run_sql(spark, arguments.text, settings)
        if arguments.out:
            result.write.parquet(arguments.out)
        else:
            _print(result, arguments.rows)
    else:
        _print(_report(arguments.command, stored_layers(spark, settings), settings))
    spark.stop()


def _print(result: DataFrame, rows: int | None = None) -> None:
    """All rows as tab-separated text, one by one; or the first ones and how many are left."""
    print(*result.columns, sep="\t")
    shown = 0
    for row in result.toLocalIterator():
        if rows is not None and shown >= rows:
            print(f"... {result.count() - shown} more rows")
            return
        print(*row, sep="\t")
        shown += 1


def _report(name: str, layers: dict[str, DataFrame | None], settings: Settings) -> DataFrame:
    if name == "heartbeat":
        return layer_heartbeat(**layers)
    missing = [layer for layer, frame in layers.items() if frame is None]
    if missing:
        raise SystemExit(f"not there yet: {', '.join(missing)}")
    if name == "feed":
        return layer_feed(**layers)
    if name in REPORTS:
        return REPORTS[name](layers, settings)
    silver = layers["silver"]
    if name == "kpis":
        return fleet.fleet_kpis(silver, settings)
    if name == "alerts":
        return fleet.alert_feed(fleet.latest_per_vehicle(silver), settings)
    return fleet.route_trail(silver, settings=settings)


if __name__ == "__main__":
    main()
