"""Fleet sensor telemetry analytics as plain Spark DataFrame transformations."""

from haulmetric.settings import DEFAULTS, Settings

__all__ = ["DEFAULTS", "Settings"]
