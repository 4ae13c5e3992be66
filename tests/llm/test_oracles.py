"""Queries that SQL can express, against DuckDB."""

import parity
import pytest

from haulmetric.llm import registry

ORACLES = registry.oracle_sql()


def test_all_operators_and_the_pipeline_are_registered():
    numbers = [int(k[2:].split("_")[0]) for k in registry.queries() if k.startswith("op")]
    assert sorted(numbers) == list(range(1, 14))
    assert "pipeline" in registry.queries()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, sf_dir, name):
    got = registry.queries()[name](spark, sf_dir)
    assert parity.differences(got, parity.connect(sf_dir), ORACLES[name]) == []
