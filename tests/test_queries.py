"""Every registered query beside its SQL twin on the small tables."""

import pytest

import __spark_entry__ as entry
from compare import compare, duck
from smeltery.plans import catalog

SF_DIR = "/root/testdata/sf0.001"
# The optional text operators have tests of their own.
QUERIES, ORACLE = catalog.QUERIES, entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_a_twin():
    assert set(QUERIES) <= set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    got, want, _ = compare(spark, con, SF_DIR, name, QUERIES[name], ORACLE[name])
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]


def test_entry(spark):
    assert entry.entry(spark).count() > 0
