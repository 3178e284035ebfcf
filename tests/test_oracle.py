"""Every registered query beside its DuckDB counterpart."""

import pytest

import __spark_entry__ as entry
from postmill.plans import oracles
from postmill.plans.queries import REGISTRY
from tests.oracle_check import compare, connect


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_counterpart():
    assert set(REGISTRY) == set(oracles.oracle_sql())
    assert set(REGISTRY) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, con, sf_dir, name):
    assert compare(spark, con, name, sf_dir) is None


def test_entry(spark):
    assert entry.entry(spark).columns == ["portal", "size_bucket", "time_model", "n"]
    assert entry.entry(spark).count() > 0
