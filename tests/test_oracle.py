"""Every registered query against its SQL twin on the smallest data set."""

import pytest

import __spark_entry__ as registered
from firmlake.workload import QUERIES
from tests.harness import compare

SF_DIR = "/root/testdata/sf0.001"
ORACLE = registered.oracle_sql()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, name):
    assert name in ORACLE
    assert compare(registered.queries()[name](spark, SF_DIR), SF_DIR, ORACLE[name]) is None


def test_entry_has_rows(spark):
    assert registered.entry(spark).count() > 0
