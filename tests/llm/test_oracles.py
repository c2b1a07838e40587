"""Corpus queries that SQL can express equal their SQL on whole tables."""

import pytest
from compare import differences, oracle_connection

from tallyspark.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), oracle_connection(SF), SQL[name]) == []


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
