"""Every registered query against its SQL in another engine, on the test tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import check
from __spark_entry__ import entry, oracle_sql, queries
from turnweave.catalog import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def connection():
    return check.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL) <= set(queries()) & set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, connection, name):
    assert check.differences(spark, connection, SF_DIR, name) == []


def test_entry(spark):
    rows = entry(spark).collect()
    assert {row.next_algorithm for row in rows} <= {"SFT", "GRPO", "DPO"}
    assert len(rows) == 4
