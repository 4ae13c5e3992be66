import pytest

from haulmetric.settings import DEFAULTS, load_settings


def test_shipped_files_equal_the_defaults(monkeypatch):
    for name in ("CONFIG_DIR", "PIPELINE_CONFIG_PATH", "STORAGE_CONFIG_PATH"):
        monkeypatch.delenv(name, raising=False)
    assert load_settings() == DEFAULTS


def test_folder_and_single_file_overrides(monkeypatch, tmp_path):
    (tmp_path / "pipeline.ini").write_text("[kafka]\ntopic = one\nbootstrap_servers = host:1\n")
    (tmp_path / "storage.ini").write_text("[storage]\nbronze_path = s3a://bucket/bronze\n")
    other = tmp_path / "other.ini"
    other.write_text("[kafka]\ntopic = two\n[tables]\ngold = db.gold\n")
    monkeypatch.setenv("CONFIG_DIR", str(tmp_path))
    settings = load_settings()
    assert (settings.topic, settings.bronze_path) == ("one", "s3a://bucket/bronze")
    assert settings.silver_path == DEFAULTS.silver_path
    monkeypatch.setenv("PIPELINE_CONFIG_PATH", str(other))
    settings = load_settings()
    assert (settings.topic, settings.gold_table) == ("two", "db.gold")
    assert settings.bootstrap_servers == DEFAULTS.bootstrap_servers


def test_one_folder_for_everything():
    settings = DEFAULTS.at("s3a://bucket/root/")
    assert settings.layer_paths() == {
        layer: f"s3a://bucket/root/{layer}" for layer in ("bronze", "silver", "gold")
    }
    assert settings.gold_checkpoint == "s3a://bucket/root/_checkpoints/gold"


def test_every_field_by_name_and_by_override(monkeypatch, tmp_path):
    (tmp_path / "pipeline.ini").write_text(
        "[settings]\nwatermark_delay = 30 seconds\ndedup_keys = vehicle_id | timestamp | offset\n"
        "cargo_limit = 7.5\nstate_partitions = 64\nmax_files_per_trigger = none\n"
    )
    (tmp_path / "storage.ini").write_text("[storage]\nroot = s3a://bucket/lake\n")
    monkeypatch.setenv("CONFIG_DIR", str(tmp_path))
    settings = load_settings(overrides=["window_slide=5 seconds", "state_partitions=none"])
    assert settings.watermark_delay == "30 seconds"
    assert settings.dedup_keys == ("vehicle_id", "timestamp", "offset")
    assert (settings.cargo_limit, settings.max_files_per_trigger) == (7.5, None)
    assert (settings.window_slide, settings.state_partitions) == ("5 seconds", None)
    assert settings.silver_checkpoint == "s3a://bucket/lake/_checkpoints/silver"
    for text in ("no_such_field=1", "cargo_limit"):
        with pytest.raises(ValueError):
            load_settings(overrides=[text])


def test_a_named_but_absent_file_is_an_error(monkeypatch, tmp_path):
    monkeypatch.setenv("PIPELINE_CONFIG_PATH", str(tmp_path / "typo.ini"))
    with pytest.raises(FileNotFoundError):
        load_settings()
    monkeypatch.delenv("PIPELINE_CONFIG_PATH")
    monkeypatch.setenv("CONFIG_DIR", str(tmp_path / "nowhere"))
    with pytest.raises(FileNotFoundError):
        load_settings()
