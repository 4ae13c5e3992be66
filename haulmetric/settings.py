"""All tunables in one frozen object, optionally read from INI files."""

from __future__ import annotations

import configparser
import os
from collections.abc import Sequence
from dataclasses import dataclass, replace
from pathlib import Path
from typing import get_args, get_origin, get_type_hints

CONFIG_DIR = Path(__file__).resolve().parent.parent / "config"


@dataclass(frozen=True)
class Settings:
    # message bus
    bootstrap_servers: str = "localhost:9092"
    topic: str = "fleet-telemetry"
    starting_offsets: str = "latest"

    # layer locations, catalog names and checkpoints; places have no default, see `place`
    bronze_path: str = ""
    silver_path: str = ""
    gold_path: str = ""
    bronze_table: str = "telemetry.bronze"
    silver_table: str = "telemetry.silver"
    gold_table: str = "telemetry.gold"
    bronze_checkpoint: str = ""
    silver_checkpoint: str = ""
    gold_checkpoint: str = ""
    table_format: str = "parquet"

    # event time
    time_zone: str = "UTC"
    time_patterns: tuple[str, ...] = ("yyyy-MM-dd HH:mm:ss",)
    dedup_keys: tuple[str, ...] = ("vehicle_id", "timestamp")
    watermark_delay: str = "10 seconds"
    window_length: str = "1 minute"
    window_slide: str = "10 seconds"
    trip_gap: str = "5 minutes"

    # streaming execution
    trigger_interval: str = "5 seconds"
    max_files_per_trigger: int | None = None
    max_offsets_per_trigger: int | None = None
    state_partitions: int | None = None
    state_store: str | None = "rocksdb"
    # "exact" keeps the first arrival and waits for the watermark; "fast" emits at once.
    dedup_mode: str = "exact"

    # Tasks that write rows of one partition value in a micro-batch, none for one per shuffle
    # partition; see streaming.sinks.
    partition_writers: int | None = None

    # thresholds; every comparison is strict
    cargo_limit: float = 8.0
    vibration_limit: float = 3.0
    condensation_gap: float = 2.0
    fleet_temp_limit: float = 6.0

    # reports
    recent_rows: int = 500
    trail_length: int = 15

    # upkeep
    target_file_bytes: int = 256 * 1024 * 1024
    gold_horizon: str = "90 days"

    def place(self, field: str) -> str:
        """A layer path or checkpoint; it must be a URI or an absolute path.

        A relative one would be the working folder of whatever process looks at it.
        """
        found = getattr(self, field)
        if not (found.startswith("/") or "://" in found or found.startswith("file:/")):
            raise ValueError(f"{field} must be a URI or an absolute path, not {found!r}")
        return found

    def layer_paths(self) -> dict[str, str]:
        return {layer: self.place(f"{layer}_path") for layer in ("bronze", "silver", "gold")}

    def layer_tables(self) -> dict[str, str]:
        return {"bronze": self.bronze_table, "silver": self.silver_table, "gold": self.gold_table}

    def at(self, root: str) -> Settings:
        """The same settings with every layer and checkpoint below one folder."""
        root = root.rstrip("/")
        return replace(
            self,
            bronze_path=f"{root}/bronze",
            silver_path=f"{root}/silver",
            gold_path=f"{root}/gold",
            bronze_checkpoint=f"{root}/_checkpoints/bronze",
            silver_checkpoint=f"{root}/_checkpoints/silver",
            gold_checkpoint=f"{root}/_checkpoints/gold",
        )


DEFAULTS = Settings()

# INI (section, option) -> settings field.
_INI_FIELDS = {
    ("kafka", "bootstrap_servers"): "bootstrap_servers",
    ("kafka", "topic"): "topic",
    ("kafka", "starting_offsets"): "starting_offsets",
    ("storage", "bronze_path"): "bronze_path",
    ("storage", "silver_path"): "silver_path",
    ("storage", "gold_path"): "gold_path",
    ("storage", "table_format"): "table_format",
    ("tables", "bronze"): "bronze_table",
    ("tables", "silver"): "silver_table",
    ("tables", "gold"): "gold_table",
    ("spark", "checkpoint_bronze"): "bronze_checkpoint",
    ("spark", "checkpoint_silver"): "silver_checkpoint",
    ("spark", "checkpoint_gold"): "gold_checkpoint",
    ("spark", "time_zone"): "time_zone",
    ("spark", "trigger_interval"): "trigger_interval",
}


def load_settings(base: Settings = DEFAULTS, overrides: Sequence[str] = ()) -> Settings:
    """Read `pipeline.ini` and `storage.ini`, then apply `overrides` ("field=value").

    `CONFIG_DIR` names the folder; `PIPELINE_CONFIG_PATH` and `STORAGE_CONFIG_PATH` name
    single files and win over it. A file or folder that is named but absent is an error: with
    the defaults, tables and checkpoints would start anew somewhere else. Every field can be
    given by its name in a section [settings]. `root` in [storage], or `WAREHOUSE_ROOT`, puts all
    layers and checkpoints below one folder. Options that are not given keep their default,
    and credentials are never read here: they belong to the cluster's own configuration.
    """
    folder = Path(os.environ.get("CONFIG_DIR", CONFIG_DIR))
    if "CONFIG_DIR" in os.environ and not folder.is_dir():
        raise FileNotFoundError(f"CONFIG_DIR names no folder: {folder}")
    parser = configparser.ConfigParser(interpolation=None)
    for variable, name in (("PIPELINE_CONFIG_PATH", "pipeline.ini"), ("STORAGE_CONFIG_PATH", "storage.ini")):
        path = Path(os.environ.get(variable, folder / name))
        if not parser.read(path, encoding="utf-8") and variable in os.environ:
            raise FileNotFoundError(f"{variable} names no file: {path}")
    if root := os.environ.get("WAREHOUSE_ROOT") or parser.get("storage", "root", fallback=None):
        base = base.at(root)
    found = {
        field: parser.get(section, option)
        for (section, option), field in _INI_FIELDS.items()
        if parser.has_option(section, option)
    }
    if parser.has_section("settings"):
        found |= dict(parser.items("settings"))
    for text in overrides:
        field, equals, value = text.partition("=")
        if not equals:
            raise ValueError(f"not of the form field=value: {text}")
        found[field.strip()] = value.strip()
    return replace(base, **{field: _parsed(field, value) for field, value in found.items()})


def _parsed(field: str, text: str) -> object:
    """Text as the type of a field; lists are separated by `|`, and `none` clears an optional."""
    kinds = get_type_hints(Settings)
    if field not in kinds:
        raise ValueError(f"no setting is called {field}")
    kind = kinds[field]
    options = get_args(kind)
    if type(None) in options:
        if text.lower() == "none":
            return None
        kind = next(k for k in options if k is not type(None))
    if get_origin(kind) is tuple:
        return tuple(part.strip() for part in text.split("|"))
    return kind(text)
