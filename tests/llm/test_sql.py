"""The queries that SQL can express give the rows that DuckDB gives, at the smallest scale."""

from __future__ import annotations

import os

import oracle
import pytest

from lanewarden.llm import queries

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are absent")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    assert oracle.difference(queries.queries()[name](spark, SF_DIR), oracle.connect(SF_DIR), queries.oracle_sql()[name]) is None
