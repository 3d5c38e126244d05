"""Queries that SQL can express give the rows of their SQL."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import compare  # noqa: E402

from quadrille.llm import queries  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", queries.ORACLES)
def test_query_equals_oracle(spark, name):
    connection = compare.connect(SF_DIR)
    query, sql = queries.QUERIES[name], queries.ORACLES[name]
    assert compare.differences(spark, connection, SF_DIR, query, sql) is None
