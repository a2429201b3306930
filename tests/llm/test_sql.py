"""Queries of this subpackage that have SQL agree with it."""

import os
import sys

import pytest

from slotcast.llm.queries import ORACLES, QUERIES

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from check_catalog import compare, duck  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, name):
    assert compare(QUERIES[name](spark, FOLDER).toPandas(), duck(FOLDER).execute(ORACLES[name]).fetchdf()) == []
