"""Every registered query against its SQL, on data where window edges are hit."""

import pytest

from tests.helpers import plan
from tidegauge.sources.workspace import Scratch
from verification.compare import differences
from verification.oracle import ORACLE
from verification.queries import QUERIES

SLOW_OPERATORS = ("NestedLoopJoin", "CartesianProduct", "EvalPython", "InPandas", "InArrow")


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.fixture
def written(monkeypatch):
    """The plans of all intermediate tables, as they are written."""
    plans, write = [], Scratch.table

    def table(self, df, label):
        plans.append(plan(df))
        return write(self, df, label)

    monkeypatch.setattr(Scratch, "table", table)
    return plans


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, medium, written, name):
    frame = QUERIES[name](spark, medium)
    for text in (*written, plan(frame)):
        assert [operator for operator in SLOW_OPERATORS if operator in text] == []
    assert differences(frame, name, medium) == []
