"""Every registered query against its SQL counterpart on the smallest data."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from tools import check_oracle
from workload import catalog, oracle

DATA = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


@pytest.fixture(scope="module")
def connection():
    return check_oracle.connect(DATA)


def test_every_query_has_its_counterpart():
    assert set(catalog.QUERIES) == set(oracle.ORACLE)


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(oracle.ORACLE))
def test_query(spark, connection, name):
    assert check_oracle.compare(spark, connection, DATA, name) == ""
