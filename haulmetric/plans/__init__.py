"""Compositions of operators: layer builds, reports, catalog work, upkeep jobs."""
