"""Every registered query against its DuckDB oracle (small scale)."""

import pytest

import __spark_entry__ as E
from logbeam.plans import catalog, oracle
from tools.oracle_check import compare

from .conftest import SF_SMALL

KEYS = sorted(catalog.queries())


def test_every_query_has_an_oracle():
    assert set(oracle.oracle_sql()) == set(KEYS) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def results(spark):
    return compare(spark, SF_SMALL, KEYS)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(results, key):
    assert results[key].startswith("OK"), results[key]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["date", "hour", "requests", "total_bytes", "errors"]
    assert df.count() > 0


def test_oracle_takes_nothing_from_the_code_under_test():
    source = open(oracle.__file__).read()
    assert "from .." not in source and "import catalog" not in source
