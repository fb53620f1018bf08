"""Queries of the operators against their SQL on whole tables."""

import pytest

from rillworks.llm.queries import ORACLES, QUERIES
from tests.compare import spark_result, sql_result

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", ORACLES)
def test_query_matches_sql(spark, name):
    got_names, got = spark_result(QUERIES[name](spark, SF))
    want_names, want = sql_result(SF, ORACLES[name])
    assert got_names == want_names
    assert got == want and got
