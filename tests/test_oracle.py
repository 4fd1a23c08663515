"""Every query against its SQL."""

import pytest

import __spark_entry__  # noqa: F401  registers the queries
from tests.compare import differences, duck
from tidemark.checks.registry import ORACLES as SQL
from tidemark.checks.registry import QUERIES


@pytest.fixture(scope="module")
def con(request):
    import os

    return duck(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    assert name in SQL
    assert differences(QUERIES[name](spark, sf_dir), SQL[name], con) == []
