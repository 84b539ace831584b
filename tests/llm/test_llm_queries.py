"""Every registered query of the package, against its SQL where there is one."""

import os

import pytest
from oracle import connect, differences

from arborsync.llm.catalog import CATALOG

FOLDER = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(CATALOG.queries))
def test_query(spark, duck, name):
    result = CATALOG.queries[name](spark, FOLDER)
    if name in CATALOG.oracles:
        assert differences(duck, CATALOG.oracles[name], result) is None
    else:
        table = "documents"
        assert result.count() == duck.execute(f"select count(*) from {table}").fetchone()[0]
