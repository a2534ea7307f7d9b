"""Every registered batch query against its SQL, and the driver's contract."""

import pytest

import __spark_entry__ as entry_point
from checks import oracles, queries, stored
from checks.compare import TESTDATA, compare

SF = f"{TESTDATA}/sf0.001"
QUERIES, ORACLES = queries.QUERIES | stored.STORED, oracles.ORACLES | stored.SQL
BATCH = [q for q in QUERIES if not q.startswith("stream_")]


@pytest.mark.parametrize("name", BATCH)
def test_query_equals_sql(spark, name):
    ok, note = compare(spark, name, QUERIES[name], ORACLES[name], SF)
    assert ok, note


def test_contract(spark):
    assert set(QUERIES) == set(ORACLES) <= set(entry_point.oracle_sql()) <= set(entry_point.queries())
    assert entry_point.entry(spark).count() > 0
