"""Every registered query against its DuckDB statement."""

import os

import pytest
from compare import connect, differences

from tidemark.plans import registry

registry.load()


@pytest.fixture(scope="module")
def con(sf_dir):
    if not os.path.isdir(sf_dir):
        pytest.skip("no test tables")
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_statement(spark, sf_dir, con, name):
    assert differences(registry.QUERIES[name](spark, sf_dir), con, registry.ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_query_without_statement_has_rows(spark, sf_dir, name):
    assert registry.QUERIES[name](spark, sf_dir).count() > 0


def test_entry_has_rows(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
