"""Every registered query against its DuckDB statement."""

import pytest
from compare import differences
from conftest import SF_DIR

from deliverylens.plans.queries import QUERIES
from oracles.sql import ORACLES


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_duckdb(name, spark, con):
    assert differences(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(name, spark):
    assert QUERIES[name](spark, SF_DIR).count() > 0
