"""Registered corpus queries equal their SQL on whole tables."""

from __future__ import annotations

import pytest

from claimlens.llm.oracle import SQL
from claimlens.llm.queries import QUERIES
from verification.harness import connect, differences, oracle_rows, spark_rows


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, small, name):
    assert differences(spark_rows(QUERIES[name](spark, small)), oracle_rows(connect(small), SQL[name])) == []


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
