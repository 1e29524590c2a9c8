"""Every registered query against its SQL on the smallest given tables."""

import os

import pytest

from harness import compare
from harness.oracle import ORACLE
from harness.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def db():
    return compare.connect(SF_DIR)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, db, name):
    result = compare.compare(spark, db, SF_DIR, name)
    assert not result.startswith("DIFF"), result
