"""Every registered query against its SQL on whole tables."""

import pytest

import __spark_entry__ as registered
from rillworks.plans.oracles import ORACLES
from rillworks.plans.queries import QUERIES
from tests.compare import spark_result, sql_result

SF = "/root/testdata/sf0.01"


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= registered.queries().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, name):
    got_names, got = spark_result(QUERIES[name](spark, SF))
    want_names, want = sql_result(SF, ORACLES[name])
    assert got_names == want_names
    assert sum(got.values()) == sum(want.values())
    assert got == want
    assert got


def test_entry_runs(spark):
    df = registered.entry(spark)
    assert df.columns == ["key", "provider", "value"]
    _, want = sql_result("/root/testdata/sf0.001", ORACLES["csv_to_index"])
    assert df.count() == sum(want.values()) > 0
