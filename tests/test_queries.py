"""Every registered query against its SQL on the smallest samples."""

import os

import pytest

import __spark_entry__ as entry
from roadledger.queries.oracle import ORACLE
from roadledger.queries.registered import QUERIES
from tests.compare import difference, duck

DIRECTORY = os.environ.get("SAMPLE_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(DIRECTORY)


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    assert entry.entry(spark).count() == 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    frame = entry.queries()[name](spark, DIRECTORY)
    assert difference(frame, con, entry.oracle_sql()[name]) is None
