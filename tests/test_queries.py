"""Every registered query against its SQL counterpart on the smallest tables."""

import os

import pytest
from compare import connect, difference

from tidemark.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    problem, _ = difference(spark, con, SF_DIR, name)
    assert problem is None, problem
