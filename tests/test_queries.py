"""Registered queries against their SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entries
from check_queries import compare, connect

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not there")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(entries.queries()))
def test_query(spark, con, name):
    passed, message = compare(spark, con, name, SF_DIR)
    assert passed, message


def test_flagship(spark):
    assert entries.entry(spark).count() > 0
    assert set(entries.oracle_sql()) <= set(entries.queries())
