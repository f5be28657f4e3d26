"""Every registered query against its SQL twin, on whole tables."""

import os

import compare
import pytest

from evalspark.workload.oracle import ORACLE
from evalspark.workload.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def con():
    return compare.duck(SF_DIR)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    found = compare.spark_rows(QUERIES[name](spark, SF_DIR))
    assert sum(found[1].values()) > 0
    if name in ORACLE:
        assert found == compare.duck_rows(con, ORACLE[name])
