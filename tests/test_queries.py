"""Every registered query against its oracle SQL, at the smallest scale."""

import os

import pytest
from oracle import connect, differences

from arborsync.catalog import full_catalog

FOLDER = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")
CATALOG = full_catalog()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(CATALOG.queries))
def test_query(spark, duck, name):
    result = CATALOG.queries[name](spark, FOLDER)
    sql = CATALOG.oracles.get(name)
    if sql is None:
        assert result.count() >= 0
    else:
        assert differences(duck, sql, result) is None
