"""Every registered query against its SQL twin on the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract
from oracle import compare, connect

from logloom.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_a_twin():
    assert set(registry.ORACLES) == set(registry.QUERIES)
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[:5] == ["path", "depth", "service", "name", "parent"] and df.count() > 0


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query(spark, con, name):
    result = compare(spark, con, contract.queries()[name], contract.oracle_sql()[name], SF)
    assert result is None, result
