"""Every registered query against its SQL statement."""

import os

import pytest

from meterlake.checks import oracle, queries
from tests import compare

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def con():
    return compare.connect(FOLDER)


def test_every_query_has_sql():
    assert set(queries.queries()) == set(oracle.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query(spark, con, name):
    got, got_names = compare.spark_rows(queries.queries()[name](spark, FOLDER))
    want, want_names = compare.duck_rows(con, oracle.oracle_sql()[name])
    assert got_names == want_names
    assert len(got) == len(want)
    assert got == want
    assert want
