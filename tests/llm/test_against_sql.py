"""Queries with a SQL counterpart, over the whole of the smallest data set."""

from __future__ import annotations

import pytest

import __spark_entry__ as registry
from parley.llm.oracles import oracles
from parley.llm.queries import all_queries
from tests.compare import connect, difference
from tests.conftest import SF


@pytest.mark.parametrize("name", list(oracles()))
def test_equals_sql(spark, name):
    assert difference(all_queries()[name](spark, SF), connect(SF), oracles()[name]) is None


def test_all_are_registered():
    assert set(all_queries()) <= set(registry.queries())
    assert {f"op{n}" for n in range(1, 14)} == {name.partition("_")[0] for name in all_queries()}
    assert "pipeline" in registry.queries()
