"""Every registered query against its SQL statement, over whole tables."""

import os

import pytest

from tests.compare import connect, differences
from tradewind.checks.expected import EXPECTED
from tradewind.checks.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(EXPECTED)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_statement(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), con, EXPECTED[name]) == []
