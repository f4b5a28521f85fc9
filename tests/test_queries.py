"""Every registered query against its SQL form, or at least some rows, at the small scale."""

import os

import pytest

import __spark_entry__ as entry
from check_oracles import compare, connect

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no driver tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    assert compare(spark, con, name, SF_DIR) is None


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 50
