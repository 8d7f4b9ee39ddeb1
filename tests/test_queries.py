"""Every registered query against its checking SQL."""

from __future__ import annotations

import os

import pytest
from checking import ORACLE, QUERIES, connect, differences
from conftest import DATA_ROOT

FOLDER = f"{DATA_ROOT}/sf0.001"


@pytest.fixture(scope="module")
def connection():
    if not os.path.isdir(FOLDER):
        pytest.skip("no test data")
    return connect(FOLDER)


def test_every_query_has_checking_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    count, only_spark, only_sql = differences(spark, connection, FOLDER, name)
    assert (only_spark, only_sql) == ([], [])
    assert count > 0
