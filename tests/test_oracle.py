"""Every SQL-checkable registered query equals its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as entry
from fleetsight.plans import registry
from conftest import SF_SMALL
from oracle_compare import compare, duck

ORACLES = registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    result = compare(registry.queries()[name](spark, SF_SMALL), con, ORACLES[name])
    assert result["columns_match"], result
    assert result["spark_rows"] == result["oracle_rows"], result
    assert result["hash_match"], result


def test_every_query_has_an_oracle_or_is_documented():
    rows_only = set(registry.queries()) - set(ORACLES)
    assert rows_only == {"train_and_evaluate"}


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
