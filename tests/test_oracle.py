"""Every registered query equals its SQL on the whole tables."""

import pytest
from compare import differences, oracle_connection

import __spark_entry__ as contract
from tallyspark.queries.registry import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF)


def test_every_query_is_offered_with_its_sql():
    assert QUERIES.keys() <= contract.queries().keys()
    assert QUERIES.keys() <= contract.oracle_sql().keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    df = contract.queries()[name](spark, SF)
    assert differences(df, con, contract.oracle_sql()[name]) == []


def test_entry_has_rows(spark):
    assert contract.entry(spark).limit(1).count() == 1
