"""The registered queries against their SQL."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))

import check
from __spark_entry__ import queries
from turnweave.llm.queries import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, name):
    assert check.differences(spark, check.connect(SF_DIR), SF_DIR, name) == []


def test_every_operator_is_registered():
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert {*QUERIES, "pipeline"} <= set(queries())
