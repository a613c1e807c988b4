"""Registered queries against DuckDB on the smallest data set."""

import pytest

from checks.compare import compare, duck
from checks.oracle import ORACLE
from checks.queries import QUERIES

SAMPLE = [
    "normalize_messages",
    "topic_inventory_merge",
    "message_aggregates_15m",
    "message_aggregates_range_15m",
    "power_energy_60m",
    "power_energy_range_60m",
    "load_messages",
    "load_topics",
]


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", SAMPLE)
def test_query(spark, sf, con, name):
    assert compare(spark, con, sf, name, QUERIES[name], ORACLE[name]) is None
