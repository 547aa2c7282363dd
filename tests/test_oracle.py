from __future__ import annotations

import os

import pytest

from martloom.queries import REGISTRY
from oracle import differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="tables absent")


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query_agrees_with_sql(spark, name):
    assert differences(spark, REGISTRY[name], SF_DIR) == []


def test_every_query_has_sql():
    assert [name for name, query in REGISTRY.items() if query.sql is None] == []


def test_entry(spark):
    import __spark_entry__ as entry_points

    assert entry_points.entry(spark).columns[0] == "user_id"
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
