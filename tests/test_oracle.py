"""Every registered query against its DuckDB oracle."""

import pytest

import __spark_entry__ as entry_mod
from compare import compare
from railyard.plans.catalog import QUERIES
from railyard.plans.oracle import ORACLE


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, sf_dir, name):
    ok, msg = compare(QUERIES[name](spark, sf_dir), con, ORACLE[name])
    assert ok, f"{name}: {msg}"


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns[:3] == ["route_id", "direction", "stop_id"]
    assert df.count() > 0
