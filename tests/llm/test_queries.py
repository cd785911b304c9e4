"""Registered training-data queries against their SQL."""

import pytest

from logbeam.llm import oracle, queries
from tools.oracle_check import compare

SF = "/root/testdata/sf0.001"


def test_one_query_per_operator():
    assert sorted(int(k[2:].split("_")[0]) for k in queries.queries()) == list(range(1, 14))
    assert set(oracle.oracle_sql()) <= set(queries.queries())


@pytest.mark.parametrize("key", sorted(oracle.oracle_sql()))
def test_query_matches_sql(spark, key):
    assert compare(spark, SF, [key])[key].startswith("OK")
