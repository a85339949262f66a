import os

import pytest
from compare import compare

from weirframe.plans.oracle import SQL
from weirframe.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, name):
    assert compare(spark, SF_DIR, QUERIES[name], SQL[name]) > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
