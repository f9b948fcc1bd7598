"""Every registered query against its SQL counterpart, and plan rules that hold for all."""

from __future__ import annotations

import pytest

import __spark_entry__ as registry
from catalog.oracles import oracles
from catalog.queries import all_queries
from tests.compare import connect, difference
from tests.conftest import SF
from tests.helpers import plan_of


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_sql():
    assert set(all_queries()) == set(oracles())
    assert set(all_queries()) <= set(registry.queries())


@pytest.mark.parametrize("name", list(all_queries()))
def test_equals_sql(spark, duck, name):
    df = all_queries()[name](spark, SF)
    plan = plan_of(df)
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert difference(df, duck, oracles()[name]) is None


def test_entry_is_the_unified_table(spark):
    df = registry.entry(spark)
    assert {"resolution_tier", "session_quality_score", "year", "month", "day"} <= set(df.columns)
    assert df.count() > 0
