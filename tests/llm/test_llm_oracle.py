"""Queries with an oracle equal it on the smallest tables, compared as the driver does."""

import pytest
from odd_tables import SF_SMALL
from oracle_compare import compare, duck

from fleetsight.llm import queries as llm


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_query_equals_oracle(spark, name):
    result = compare(llm.queries()[name](spark, SF_SMALL), duck(SF_SMALL), llm.oracle_sql()[name])
    assert result["hash_match"] and result["spark_rows"] == result["oracle_rows"], result
