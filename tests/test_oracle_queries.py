"""Every registered query against its DuckDB oracle on the sf0.001 tables
(the driver runs the same comparison at sf0.01)."""

import pytest

import __spark_entry__ as E
from florafold.plans import registry as R
from oracle_harness import compare, duck

SF = "/root/testdata/sf0.001"
ORACLE = dict(R.ORACLE)
QUERIES = dict(R.QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLE[name], SF)
    assert r["cols_match"], r
    assert r["spark_rows"] == r["duck_rows"], r
    assert r["hash_match"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["value", "count"]
    assert df.count() > 0
